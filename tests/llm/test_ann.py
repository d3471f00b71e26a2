"""Nearest neighbours against brute force: recall, scores, ties, copies and rows that take no part."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from curate.llm import ann

from conftest import SF_SMALL

DDL = "vec_id bigint, embedding array<float>, label int"


def brute(rows, k, asks=lambda i: i % 20 == 0):
    """{query: [(vec_id, score)]} over rows (id, vector)."""
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], np.float32).astype(np.float64)
    out = {}
    for i in np.flatnonzero([asks(v) for v in ids]):
        score = x @ x[i]
        other = ids != ids[i]
        order = np.lexsort((ids[other], -score[other]))[:k]
        out[int(ids[i])] = list(zip(ids[other][order].tolist(), score[other][order].tolist()))
    return out


def answers(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert len(out[r.query_id]) == r["rank"]
    return out


def recall(got, want):
    assert got.keys() == want.keys()
    return np.mean([len({v for v, _ in got[q]} & {v for v, _ in want[q]}) / max(1, len(want[q])) for q in want])


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], 1) for i, v in rows], DDL)


def vectors(kind, n, d=16, seed=4):
    rng = np.random.default_rng(seed)
    if kind == "clusters":
        x = rng.normal(size=(12, d))[rng.integers(12, size=n)] + rng.normal(size=(n, d)) * .15
    else:
        x = rng.normal(size=(n, d))
    if kind == "norms":
        x *= rng.lognormal(0, .5, (n, 1))
    return [(i, v.astype(np.float32)) for i, v in enumerate(x)]


@pytest.mark.parametrize("kind", ["clusters", "uniform", "norms"])
def test_recall_over_many_lists(spark, monkeypatch, kind):
    monkeypatch.setattr(ann, "PART", 40)                     # several parts and shares a list
    monkeypatch.setattr(ann, "SHARE", 10)
    rows = vectors(kind, 3000)
    got, want = answers(ann.nearest(table(spark, rows), F.col("vec_id") % 20 == 0, list_size=60)), brute(rows, 20)
    assert recall(got, want) >= 0.9
    x = {i: v.astype(np.float64) for i, v in rows}
    for q, hits in got.items():
        assert len(hits) == 20 and q not in {v for v, _ in hits}
        assert hits == sorted(hits, key=lambda h: (-h[1], h[0]))
        for v, score in hits:
            assert score == pytest.approx(float(x[q] @ x[v]), rel=1e-12, abs=1e-12)


def test_lists_are_balanced_and_walked():
    x = np.array([v for _, v in vectors("clusters", 4000)], np.float32)
    lists = ann.Lists.fit(x, 64, float(np.linalg.norm(x, axis=1).max()))
    lifted = ann.lifted(x, lists.radius, False)
    held, n = lists.posted(lifted)
    assert np.bincount(held[:, 0], minlength=64).max() <= 4 * 4000 / 64 and (n >= 1).all() and n.max() > 1
    truth = ann._squares(lifted, lists.centroids).argmin(1)
    assert (held[:, 0] == truth).mean() > 0.98


def test_a_third_are_copies(spark):
    rows = vectors("uniform", 600)
    rows += [(1000 + i, rows[7][1]) for i in range(400)]                # twenty of them are queries
    got, want = answers(ann.nearest(table(spark, rows), F.col("vec_id") % 20 == 0, list_size=50)), brute(rows, 20)
    assert recall(got, want) >= 0.9
    for q in range(1000, 1400, 20):
        assert [v for v, _ in got[q]] == [v for v, _ in want[q]]


def test_ties_and_few_candidates(spark):
    rows = [(i, v) for i, v in enumerate([(1, 0), (0, 1), (1, 1), (2, 0), (0, -1), (1, 0), (-3, 0)])]
    assert answers(ann.nearest(table(spark, rows), F.col("vec_id") % 2 == 0, k=3)) == brute(rows, 3, lambda i: i % 2 == 0)
    assert answers(ann.nearest(table(spark, rows), F.col("vec_id") % 2 == 0, list_size=1)) == brute(rows, 20, lambda i: i % 2 == 0)
    assert answers(ann.nearest(table(spark, rows[:1]), F.col("vec_id") == 0)) == {}


def test_rows_that_take_no_part(spark):
    good = [(20, (1, 2)), (1, (3, 1)), (40, (-1, 1))]
    bad = [(60, None), (80, (0, 0)), (100, (None, 1)), (2, (float("nan"), 1)), (3, (float("inf"), 1)), (120, ()), (140, (1, 2, 3)), (None, (1, 1))]
    df = table(spark, good + bad + good[:2]).withColumn("score", F.lit("x")).withColumn("id", F.lit(5)).withColumn("rank", F.lit(1))
    assert answers(ann.nearest(df, F.col("vec_id") % 20 == 0)) == brute(good, 20)
    shared = table(spark, [*good, (1, (9, 9))])                          # an id with two vectors: the nearer one counts
    assert answers(ann.nearest(shared, F.col("vec_id") % 20 == 0))[20] == [(1, 27.0), (40, 1.0)]


def test_empty_table(spark):
    empty = ann.nearest(spark.createDataFrame([], DDL), F.col("vec_id") % 20 == 0)
    assert empty.count() == 0 and empty.columns == ["query_id", "rank", "vec_id", "score"]
    assert ann.nearest(table(spark, [(20, None)]), F.col("vec_id") % 20 == 0).count() == 0


def test_query_recall(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()]
    got = answers(ann.op11_nearest_neighbours(spark, SF_SMALL))
    assert recall(got, brute(rows, 20)) >= 0.9
