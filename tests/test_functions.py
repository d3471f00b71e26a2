"""Column functions: the casting trap and the standardisation quirks."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curate.functions import (LOWER, basename, bucket, canonical, cast_failed, csv_fields,
                              interval_bounds, lenient_cast, ordinal, pct, strip_chars)
from curate.plans import oracle as O

CORPUS = [" 12 ", "12.7", "-3.9", ".5", ".", " -.5", "abc", "1e3", "99999999999", "+7", "7.",
          "  ", " 1 2", "\t5\t", "0x1A", "5L", "2147483647", "2147483648", "-2147483648",
          "007", "", "1.", "-0", "12.7.1", "NaN", "١٢", None]


def test_lenient_cast_matches_non_ansi_cast(spark):
    df = spark.createDataFrame([(v,) for v in CORPUS], "v string")
    prev = spark.conf.get("spark.sql.ansi.enabled")
    try:
        spark.conf.set("spark.sql.ansi.enabled", "false")
        legacy = {t: [r[0] for r in df.select(F.col("v").cast(t)).collect()]
                  for t in ("int", "bigint")}
    finally:
        spark.conf.set("spark.sql.ansi.enabled", prev)
    for t, dt in (("int", T.IntegerType()), ("bigint", T.LongType())):
        ours = [r[0] for r in df.select(lenient_cast("v", dt)).collect()]
        assert ours == legacy[t], t


def test_lenient_cast_oracle_sql_agrees(spark, duck_small):
    ascii_corpus = [v for v in CORPUS if v is None or (v.isascii() and "\t" not in v)]
    df = spark.createDataFrame([(v,) for v in ascii_corpus], "v string")
    ours = [r[0] for r in df.select(lenient_cast("v", T.IntegerType())).collect()]
    values = ", ".join(f"({i}, {O.lit(v)})" for i, v in enumerate(ascii_corpus))
    sql = (f"SELECT {O.lenient_cast_sql('v', T.IntegerType())} FROM (VALUES {values}) t(i, v) "
           "ORDER BY i")
    assert [r[0] for r in duck_small.sql(sql).fetchall()] == ours


def test_cast_failed_ignores_nulls(spark):
    df = spark.createDataFrame([(None,), ("x",), ("3",)], "v string")
    assert [r[0] for r in df.select(cast_failed("v", "int")).collect()] == [False, True, False]


def test_initcap_trim_and_canonical(spark):
    df = spark.createDataFrame([("AfricanAmerican", "\tmale ", " FEMALE ", "CH ")],
                               "race string, g1 string, g2 string, ch string")
    r = df.select(F.initcap("race"), F.trim("g1"), canonical(F.trim("g2"), {"male": "Male",
                  "female": "Female"}), canonical(F.trim("g1"), {"male": "Male"}),
                  canonical(F.trim("ch"), {"ch": "change", "no": "no change"}, LOWER),
                  canonical(F.lit("Maybe"), {"ch": "change"}, LOWER)).first()
    assert r[0] == "Africanamerican"          # initcap lower-cases the rest of the word
    assert r[1] == "\tmale"                   # trim removes spaces only
    assert r[2] == "Female"
    assert r[3] is None                       # tab survives trim -> no match -> null
    assert r[4] == "change" and r[5] == "maybe"


def test_bucket_null_goes_to_otherwise_and_ordinal(spark):
    df = spark.createDataFrame([(None, "NO"), (10, ">30"), (40, "<30"), (70, "x")],
                               "a int, r string")
    rows = df.select(bucket("a", [(18, "pediatric"), (65, "adult")], "senior"),
                     ordinal("r", {"NO": 0, ">30": 1, "<30": 2})).collect()
    assert [tuple(r) for r in rows] == [("senior", 0), ("pediatric", 1), ("adult", 2),
                                        ("senior", None)]


def test_interval_bounds_strip_basename_pct(spark):
    df = spark.createDataFrame([("[60-70)", "250.01", "a/b/c.csv")], "age string, d string, p string")
    lo, hi = interval_bounds("age")
    r = df.select(lo, hi, strip_chars("d", "."), basename("p"),
                  pct(F.lit(1), F.lit(200000)), pct(F.lit(1), F.lit(0))).first()
    assert tuple(r) == (60, 70, "25001", "c.csv", 0.0, None)
    bad = spark.createDataFrame([("unknown",), (None,)], "age string")
    assert [tuple(x) for x in bad.select(*interval_bounds("age")).collect()] == [(None, None),
                                                                                 (None, None)]


@pytest.mark.parametrize("line,expected", [
    ('1,"Home, self care"', ["1", "Home, self care"]),
    (",no id", [None, "no id"]),
    ('a,"x, y",', ["a", "x, y", None]),
    ("x", ["x"]),
])
def test_csv_fields(spark, line, expected):
    df = spark.createDataFrame([(line,)], "line string")
    assert df.select(csv_fields("line")).first()[0] == expected


def test_half_up_rounding_is_exact(spark):
    rows = [(n, t) for t in (7, 40, 200, 400, 20000) for n in range(0, min(t, 120) + 1)]
    df = spark.createDataFrame(rows, "n long, t long")
    got = [r[0] for r in df.select(pct("n", "t")).collect()]
    want = [((20000 * n + t) // (2 * t)) / 100 for n, t in rows]
    assert got == want


from hypothesis import given, settings, HealthCheck
from hypothesis import strategies as st

_ALPHABET = st.sampled_from(list("0123456789") * 3 + [" ", ".", "-", "+", "e", "x", "\t", ","])


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(_ALPHABET, min_size=0, max_size=12), min_size=50, max_size=200))
def test_lenient_cast_property(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    prev = spark.conf.get("spark.sql.ansi.enabled")
    try:
        spark.conf.set("spark.sql.ansi.enabled", "false")
        legacy = [(r[0], r[1]) for r in df.select(F.col("v").cast("int"),
                                                  F.col("v").cast("bigint")).collect()]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", prev)
    ours = [(r[0], r[1]) for r in df.select(lenient_cast("v", T.IntegerType()),
                                            lenient_cast("v", T.LongType())).collect()]
    assert ours == legacy


_FIELD = st.one_of(
    st.text(st.sampled_from(list("ab1 -_")), max_size=5),                    # plain (maybe empty)
    st.text(st.sampled_from(list("ab, ")), min_size=0, max_size=5).map(
        lambda t: '"' + t + '"'))                                              # quoted, with commas


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(_FIELD, min_size=1, max_size=5), min_size=1, max_size=40))
def test_csv_fields_matches_spark_csv_parser_on_header_like_lines(spark, rows):
    lines = [",".join(r) for r in rows]
    width = max(len(r) for r in rows)
    schema = ", ".join(f"c{i} string" for i in range(width))
    df = spark.createDataFrame([(ln, len(r)) for ln, r in zip(lines, rows)], "line string, n int")
    out = df.select("n", csv_fields("line").alias("ours"),
                    F.from_csv("line", schema).alias("spark")).collect()
    for r in out:
        theirs = [r.spark[f"c{i}"] for i in range(r.n)]
        assert r.ours == theirs, (r.ours, theirs)
