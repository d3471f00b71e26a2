"""What a pair of near duplicates' candidates costs: bounds of large sets, and sets that travel once a block."""

import numpy as np
import pyarrow as pa

import corpus_pipeline
from curate.llm import jaccard
from curate.llm.textbytes import setting


def sketch(texts):
    (out,) = jaccard._sketch(iter([pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": texts})]), 5)
    return out


def text(rng, n):
    return [f"w{x}" for x in rng.integers(0, 10 ** 9, n)]


def test_unlike_large_sets_are_no_candidates():
    rng = np.random.default_rng(1)
    own = text(rng, 6000)
    texts = [own, text(rng, 6000), own[:5500] + text(rng, 100), own[300:]]
    rows = sketch([" ".join(t) for t in texts])
    pairs = [(a, b) for a in range(4) for b in range(a)]
    of = lambda c, k: [rows.column(c)[p[k]].as_py() for p in pairs]
    batch = pa.RecordBatch.from_pydict({"a": of("doc_id", 0), "b": of("doc_id", 1), **{f"{c}_{x}": of(c, k) for c in ("n", "hist") for k, x in enumerate("ab")}})
    got = {(r["a"], r["b"]) for out in jaccard._bounded(iter([batch]), 80, 100) for r in out.to_pylist()}
    assert got == {(2, 0), (3, 0), (3, 2)}


def test_histograms_bound_every_pair():
    rng = np.random.default_rng(2)
    sets = []
    for n in (0, 1, 40, 255, 300, 3000, 9000):
        own = rng.integers(0, 1 << 62, n, dtype=np.uint64) << np.uint64(int(rng.integers(0, 2)) * 9)  # some fill one bucket
        sets += [own[:int(len(own) * share)] for share in (1, .9, .7)]
    sets = [np.unique(s) for s in sets]
    hists = jaccard.histograms(np.concatenate(sets), np.array([len(s) for s in sets]))
    assert [len(h) for h in hists][-3:] == [2048, 1024, 1024] and len(hists[0]) == jaccard.BUCKETS
    pairs = [(a, b) for a in range(len(sets)) for b in range(len(sets))]
    total = np.array([len(sets[a]) + len(sets[b]) for a, b in pairs])
    kept = jaccard.within([hists[a] for a, _ in pairs], [hists[b] for _, b in pairs], total, 80, 100)
    for (a, b), one in zip(pairs, kept):
        both = len(np.intersect1d(sets[a], sets[b]))
        assert one or 180 * both < 80 * (len(sets[a]) + len(sets[b]))
    rough = jaccard.coarse(hists)
    assert all(r.sum() == len(s) or 65535 in r for r, s in zip(rough.astype(int), sets))


def test_a_family_is_compared_by_blocks(spark):
    """Pairs of a family link as in brute force, and each set comes once to a block, not once a pair."""
    rng = np.random.default_rng(3)
    order = jaccard.Order([])
    base, texts = text(rng, 400), []
    for k in range(60):
        own = list(base)
        for at in rng.integers(0, 400, int(rng.integers(0, 16))):
            own[at] = f"x{k}-{at}"
        texts.append(" ".join(own))
    (sets,) = jaccard._sets(iter([pa.RecordBatch.from_pydict({"text": texts})]), 5, order)
    keys = {r["entity"]: np.frombuffer(r["keys"], np.uint64) for r in sets.to_pylist()}
    ids = sorted(keys)
    pairs = [(7, i % 2, a, b) for i, a in enumerate(ids) for b in ids if a < b]
    passed = []
    real = jaccard._verify_family

    def seen(batches, num, den):
        own = list(batches)
        passed.append(sum(b.num_rows for b in own))
        return real(iter(own), num, den)

    frame = spark.createDataFrame(pairs, "lead bigint, block bigint, a bigint, b bigint")
    join = object.__new__(jaccard._Join)
    join.num, join.den = 80, 100
    got = {(r.a, r.b) for r in join.family_links(frame, spark.createDataFrame([(e, bytearray(k.tobytes())) for e, k in keys.items()], "entity bigint, keys binary")).collect()}
    want = {(a, b) for _, _, a, b in pairs if 180 * len(np.intersect1d(keys[a], keys[b])) >= 80 * (len(keys[a]) + len(keys[b]))}
    assert {tuple(sorted(p)) for p in got} == want and 0 < len(want) < len(pairs)
    rows = [(7, block, 0, e, keys[e].tobytes(), None) for block in (0, 1) for e in ids[block::2]]
    rows += [(7, block, 1, e, keys[e].tobytes(), [a for a in ids[block::2] if a < e]) for block in (0, 1) for e in ids if any(a < e for a in ids[block::2])]
    rows.sort(key=lambda r: r[:3])
    batch = pa.RecordBatch.from_pydict(dict(zip(("lead", "block", "role", "entity", "keys", "among"), map(list, zip(*rows)))))
    found = {(min(r["a"], r["b"]), max(r["a"], r["b"])) for out in seen([batch], 80, 100) for r in out.to_pylist()}
    assert found == want and passed[0] <= 3 * len(ids) < len(pairs)


def test_near_dedup_leaves_the_texts_where_they_are(spark, monkeypatch):
    rng = np.random.default_rng(4)
    base = [text(rng, 60) for _ in range(12)]
    rows = [(k, " ".join(own), "en", "a", 1) for k, own in enumerate(base)]
    rows += [(100 + k, " ".join(own[:57] + ["other"]), "en", "a", 1) for k, own in enumerate(base[:5])] + [(None, " ".join(base[0]), "en", "a", 1), (3, "an odd one", "en", "a", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars int").repartition(3)
    for few in (jaccard.BROADCAST_IDS, 0):
        monkeypatch.setattr(jaccard, "BROADCAST_IDS", few)
        with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
            out = corpus_pipeline.near_dedup(spark, docs, "")
            plan = out._jdf.queryExecution().sparkPlan().toString()
            assert sorted((r.doc_id, r.text) for r in out.collect()) == sorted([(r[0], r[1]) for r in rows[:12]] + [(3, "an odd one")])
        assert ("BroadcastHashJoin" in plan, "SortMergeJoin" in plan) == (few > 0, few == 0)
