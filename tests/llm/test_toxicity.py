"""Toxicity: every labelled document counts; cuts as one sorted list gives them; averaging."""

import random

import numpy as np
import pytest

from curate.llm import averaging, toxicity


def test_words_of_every_labelled_document_count(spark, monkeypatch):
    """A toxic document has a word that one other has on average: a sample of the labels misses most of them."""
    monkeypatch.setattr(toxicity, "GROUP", 500, raising=False)
    rng = random.Random(3)
    n = 24_000
    rows = []
    for i in range(n):
        own = [f"w{rng.randrange(300)}" for _ in range(6)]
        if i % 2:
            own[rng.randrange(6)] = f"{rng.choice('bcdfgh')}{i % 997:03}vile"
        rows.append((i, " ".join(own), "en"))
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(4)
    model = toxicity.fit(df, df.selectExpr("doc_id", "cast(doc_id % 2 as int) as toxic"))
    seen = [model.embed[toxicity.word_ids(np.frombuffer(w.encode(), np.uint8), np.array([0, len(w)]))[0][0, 0], 0] for w in {x for r in rows for x in r[1].split() if x.endswith("vile")}]
    # about a fifth of these words are in three or more of the documents trained on; of 3,000 toxic documents, next to none
    assert np.mean(np.array(seen) > .5) > .1
    got = toxicity.score(spark, df.limit(2000), model).collect()
    assert np.mean([(r.score >= toxicity.CUT) == r.doc_id % 2 for r in got]) > .95


def test_cuts_equal_those_of_one_sorted_list(spark):
    rng = np.random.default_rng(4)
    rows = [(g, float(np.round(rng.normal(y, 1), 2)), y, i) for i, (g, y) in enumerate((str(rng.integers(3)), int(rng.integers(2))) for _ in range(3000))]
    want = {}
    for g in "012":
        own = sorted((r for r in rows if r[0] == g), key=lambda r: (-r[1], r[3]))
        hits, total = np.cumsum([r[2] for r in own]), sum(r[2] for r in own)
        k = int(np.argmax(2 * hits / (np.arange(1, len(own) + 1) + total)))
        want[g] = (own[k][1] + own[min(k + 1, len(own) - 1)][1]) / 2
    got = toxicity._best_cuts(spark.createDataFrame(rows, "g string, s double, toxic int, h bigint").repartition(5))
    assert got.keys() == want.keys() and all(got[g] == pytest.approx(want[g]) for g in want)


def test_average_over_partitions(spark):
    """Each partition adds its numbers to a row of the array; the mean is weighted by rows."""
    data = spark.range(0, 1000, 1, 4).selectExpr("id")

    def learn(own, batches, number):
        n = 0
        for b in batches:
            x = np.asarray(b.column("id"))
            own["a"][x[0] // 250] += np.float32(number + 1)
            own["step"] += 1
            n += len(x)
        return n

    got = averaging.train(data, {"a": np.zeros((300, 2), np.float32), "step": np.zeros(1)}, 2, learn)
    assert np.allclose(got["a"][:4], .75) and not got["a"][4:].any() and got["step"][0] == 2
    assert averaging.train(data.limit(0), {"a": np.ones((3, 2))}, 1, learn)["a"].all()


def test_copies_follow_the_rows_not_the_files(spark):
    """A copy's changes are sent whatever its rows, so partitions of few rows are trained as one."""
    data, cores = spark.range(0, 100_000, 1, 60), spark.sparkContext.defaultParallelism
    copies = lambda rows: averaging.dealt(data, rows, 4096).rdd.getNumPartitions()
    assert copies(100_000) == max(cores, 100_000 // averaging.ROWS) and copies(4000) == copies(0) == 1
    assert copies(50 * averaging.ROWS) == 50 and averaging.dealt(data, 100_000, 4096).count() == 100_000
