"""De-duplication that compares only the rows of repeated keys."""

import random

import pytest

from curate.operators import dedupe
from curate.operators.dedupe import dedupe_grouped, repeated_keys

DDL = "k bigint, s string, d double, v string"


def table(spark, n=3000, repeats=60, seed=3):
    rng = random.Random(seed)
    rows = [(i, f"k{i}", float(i), rng.choice("abc")) for i in range(n)]
    rows += [(i, f"k{i}", float(i), rng.choice(["a", "b", None])) for i in rng.choices(range(n), k=repeats)]
    rows += [(None, None, None, x) for x in ("z", "y", None)]
    return spark.createDataFrame(rows, DDL).repartition(5)


@pytest.mark.parametrize("keys", [["k"], ["k", "s"], ["s", "d"]])
def test_equals_comparing_every_row(spark, keys):
    df = table(spark)
    want = sorted(map(repr, dedupe_grouped(df, keys).drop("_dup_n").collect()))
    got = dedupe(df, keys)
    assert sorted(map(repr, got.collect())) == want and got.columns == df.columns
    assert sorted(map(repr, dedupe(df, keys, broadcast_max_bytes=0).collect())) == want
    assert sorted(map(repr, dedupe(df, keys, max_share=0.0).collect())) == want


def test_what_is_observed(spark):
    df = spark.createDataFrame([(1, "a", 1.0, "x"), (1, "a", 2.0, "x"), (2, "b", 1.0, "x"), (None, None, None, None), (None, None, None, None)], DDL)
    seen = repeated_keys(df, ["k"])
    assert (seen.n_keys, seen.n_rows, seen.total_rows) == (2, 4, 5) and seen.n_bytes == 2 * 24
    assert sorted(r._k0 is None for r in seen.keys.collect()) == [False, True]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plan_compares_only_repeated_keys(spark):
    df = table(spark)
    plan = plan_of(dedupe(df, ["k"]))
    assert "LeftAnti" in plan and "LeftSemi" in plan and "SortMergeJoin" not in plan
    none = dedupe(df.where("k >= 0").limit(100), ["d"])
    assert "min(struct" not in plan_of(dedupe(spark.range(50).toDF("k"), ["k"]))       # nothing repeats: the rows as they are
    assert none.count() <= 100


def test_hot_key_and_empty_table(spark):
    df = spark.createDataFrame([(7, "a", 1.0, str(i % 5)) for i in range(3000)] + [(i, "b", 2.0, "x") for i in range(100, 6000)], DDL)
    assert dedupe(df, ["k"], max_share=1.0).where("k = 7").collect()[0].v == "0"
    assert dedupe(df, ["k"]).count() == 5901
    assert dedupe(spark.createDataFrame([], DDL), ["k"]).count() == 0
