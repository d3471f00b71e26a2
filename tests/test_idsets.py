"""Id sets as bitmaps against plain sets."""

import random

import pytest
from pyspark.sql import functions as F

from curate.operators.idsets import (bit_of, bit_set, bucket_of, distinct_counts, distinct_partials, fk_check_bitmaps, id_bitmaps,
                                     bitmap_sizes, merge_partials, orphans_bitmaps)

IDS = [0, 1, 7, 8, 32767, 32768, 32769, 65536, 65537, 2**31, 2**40, 2**62, -1, -8, -32767, -32768, -32769, -2**40]


def ints(spark, values, name="id"):
    return spark.createDataFrame([(v,) for v in values], f"{name} bigint")


def test_membership_at_the_edges(spark):
    maps = id_bitmaps(ints(spark, IDS[::2] + [None, 0]), "id")
    asked = ints(spark, IDS + [None, 5, -5])
    joined = asked.join(maps, bucket_of(F.col("id")) == F.col("_bucket"), "left")
    got = {r.id: r.hit for r in joined.select("id", bit_set(F.col("_bits"), bit_of(F.col("id"))).alias("hit")).collect()}
    assert {k for k, v in got.items() if v} == set(IDS[::2])
    assert bitmap_sizes({"a": maps, "b": maps.where("false")})["a"][0] == len(set(IDS[::2]))


@pytest.mark.parametrize("max_bytes", [1 << 28, 0])
def test_orphans_equal_plain_sets(spark, max_bytes):
    rng = random.Random(1)
    rows = [(rng.choice([rng.randrange(-40, 200_000), 5, 5, None]), rng.choice([1, 2, 3, None])) for _ in range(3000)]
    fact = spark.createDataFrame(rows, "a bigint, b int")
    a, b = [i for i in range(0, 200_000, 2)] + [None], [1, 1, None]
    fks = [("a", ints(spark, a), "id"), ("b", ints(spark, b).selectExpr("cast(id as int) AS id"), "id")]
    got = {r.fk: (r.valid_dim_values, r.orphaned_fact_rows) for r in fk_check_bitmaps(fact, fks, max_bytes).collect()}
    want = {k: (len({x for x in ids if x is not None}), sum(r[i] is not None and r[i] not in set(ids) for r in rows)) for i, (k, ids) in enumerate((("a", a), ("b", b)))}
    assert got == want
    left = orphans_bitmaps(fact, "a", fks[0][1], "id", max_bytes)
    assert left.count() == want["a"][1] and left.columns == ["a", "b"]


def test_empty_dimension_and_fact(spark):
    fact = spark.createDataFrame([(1,), (None,), (3,)], "fk int")
    none = ints(spark, [])
    assert [tuple(r) for r in fk_check_bitmaps(fact, [("fk", none, "id")]).collect()] == [("fk", 0, 2)]
    assert [tuple(r) for r in fk_check_bitmaps(fact.where("false"), [("fk", ints(spark, [1]), "id")]).collect()] == [("fk", 1, 0)]


def test_distinct_counts_merge_over_runs(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["x", "y", None]), rng.choice([None, rng.randrange(50_000), 7])) for _ in range(2000)]
    df = spark.createDataFrame(rows, "g string, id bigint")
    one, two = df.where("id % 2 = 0 OR id IS NULL"), df.where("id % 2 = 1").unionAll(df.where("id = 8"))
    whole = df.unionAll(df.where("id = 8"))
    got = {r.g: (r.encounter_count, r.unique_patients) for r in distinct_counts(merge_partials([distinct_partials(x, ["g"], "id") for x in (one, two)], ["g"]), ["g"]).collect()}
    assert got == {r.g: (r.n, r.d) for r in whole.groupBy("g").agg(F.count("*").alias("n"), F.count_distinct("id").alias("d")).collect()}


def test_large_dimension_in_the_single_pass(spark):
    from curate.operators.integrity import flag_fks
    fact, persisted, large = ints(spark, [1, 2, 3, None], "fk"), [], []
    flagged, hits, sizes = flag_fks(fact, [("fk", ints(spark, [1, 3, 3]), "id")], 0, persisted, large)
    assert hits == [("fk", "_fk_hit_0")] and sizes == {"fk": 2} and not large
    assert sorted(map(tuple, flagged.collect()), key=repr) == [(1, True), (2, None), (3, True), (None, None)]
    _, hits, _ = flag_fks(fact, [("fk", ints(spark, [1, 3, 3]), "id")], 0, persisted, large, bitmap_max_bytes=0)
    assert not hits and len(large) == 1
    for df in persisted:
        df.unpersist()
