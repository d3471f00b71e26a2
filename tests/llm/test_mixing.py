"""Mixing: the last budget is fitted exactly at every size, and many sources meet in no one task."""

import itertools
import random

import numpy as np
from pyspark.sql import functions as F

from curate.llm import mixing


def reachable(lengths, counts):
    sums = {0}
    for n, c in zip(lengths, counts):
        sums = {s + n * k for s in sums for k in range(c + 1)}
    return sums


def test_nearest_sum_on_either_side():
    rng = random.Random(6)
    for _ in range(80):
        lengths, counts = [rng.randint(1, 30) for _ in range(5)], [rng.randint(0, 4) for _ in range(5)]
        budget = rng.randint(1, 150)
        taken = mixing.knapsack(np.array(lengths), np.array(counts), budget, above=True)
        assert (0 <= taken).all() and (taken <= counts).all()
        assert abs(int((taken * lengths).sum()) - budget) == min(abs(s - budget) for s in reachable(lengths, counts))


def test_fit_leaves_less_than_the_longest_document():
    rng = random.Random(7)
    for most in (40, 3_000, 400_000):
        lengths = np.array(sorted({rng.randint(1, most) for _ in range(60)}))
        counts = np.array([rng.randint(1, 50) for _ in lengths])
        total = int((lengths * counts).sum())
        for share in (0.001, 0.37, 0.9):
            budget = int(total * share)
            taken = mixing.fit(lengths, counts, budget)
            assert (0 <= taken).all() and (taken <= counts).all()
            assert abs(int((taken * lengths).sum()) - budget) <= lengths[0]


def test_fit_of_awkward_lengths():
    assert mixing.fit(np.array([0, 5]), np.array([9, 2]), 10).tolist() == [9, 2]
    assert mixing.fit(np.array([0, 5]), np.array([9, 2]), 6).tolist() == [0, 1]
    assert mixing.fit(np.array([0]), np.array([9]), 0).tolist() == [9]
    assert mixing.fit(np.array([100]), np.array([3]), 140).tolist() == [1]
    assert mixing.fit(np.array([100]), np.array([3]), 60).tolist() == [1]          # the nearest sum lies above


def test_running_sums_over_many_ranges(spark):
    rng = random.Random(8)
    rows = [(k, rng.randint(0, 9)) for k in range(500)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "k int, v int").repartition(6)
    got = {r.k: (r.v, r.past) for r in mixing.running(df, [F.col("k").asc()], {"past": "v"}).collect()}
    past = dict(zip(range(500), itertools.accumulate([0] + [v for _, v in sorted(rows)])))
    assert got == {k: (v, past[k]) for k, v in rows}


def test_targets_of_many_sources(spark):
    rng = random.Random(9)
    names = [f"s{k:03}" for k in range(90)] + ["é", "Z", None]
    sizes = {n: rng.choice([0, 1, 5, 1_000, 90_000]) for n in names}
    got = {r.source: r.target for r in mixing.targets(spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")).collect()}
    order = sorted((n for n in names if n is not None), key=lambda n: n.encode()) + [None]
    weight = {n: (1, 2, 3)[k % 3] for k, n in enumerate(order)}
    free, left, want = set(names), float(sum(sizes.values())), {}
    while free:
        unit = left / sum(weight[n] for n in free)
        over = {n for n in free if unit * weight[n] > 3 * sizes[n]}
        want.update({n: 3.0 * sizes[n] for n in over} if over else {n: unit * weight[n] for n in free})
        left -= sum(want[n] for n in over)
        free = free - over if over else set()
    assert set(got) == set(want) and all(abs(got[n] - want[n]) <= 1e-6 * max(1, want[n]) for n in want)


def test_sources_joined_by_a_shuffle(spark, monkeypatch):
    rows = [(k, "w " * (1 + k % 7), "abc"[k % 3]) for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    first = sorted(tuple(r) for r in mixing.mix_sources(docs).collect())
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 0)
    assert sorted(tuple(r) for r in mixing.mix_sources(docs).collect()) == first
