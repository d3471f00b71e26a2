"""Test inputs derived by Spark from the given tables.

The driver's tables are clean, so ``encounters_raw`` derives a dirty,
all-string encounter extract from ``orders`` in one scan: every order becomes
one row (orders whose key is a multiple of 50 yield a second, identical row),
and key/customer arithmetic injects sentinels, bad numbers, decimal text,
case and space variants, bad ages, orphan keys and rule violations.  The
work grows with ``orders``.

``mapping_lines`` derives the lines of a sectioned mapping file -- three
known dimension sections, one unknown section, stray separators -- from
``orders``, ``nation``, ``region`` and ``customer``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curate.plans.oracle import FURTHER_EXPRS, RAW_COLUMNS, RAW_EXPRS
from curate.sources.literal import literal_rows
from curate.sources.tables import load
from curate.spec import ENCOUNTER_COLUMNS, ENCOUNTERS, FactSpec


def encounters_raw(spark: SparkSession, sf_dir: str,
                   columns: Sequence[str] = RAW_COLUMNS) -> DataFrame:
    """All-string encounter rows derived from ``orders`` (15,300 rows at sf0.01)."""
    # One scan: every order yields one row, and a second identical row when its
    # key is a multiple of 50 (the injected exact duplicates).
    rows = load(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "o_custkey", "o_orderpriority",
        "explode(sequence(0, CASE WHEN o_orderkey % 50 = 0 THEN 1 ELSE 0 END)) AS _copy")
    exprs = {**RAW_EXPRS, **FURTHER_EXPRS}
    return rows.selectExpr(*[f"{exprs[c]} AS `{c}`" for c in columns])


def encounters_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The extract with all 50 columns."""
    return encounters_raw(spark, sf_dir, ENCOUNTER_COLUMNS)


def encounters_spec(raw: DataFrame, spec: FactSpec = ENCOUNTERS) -> FactSpec:
    """The encounter spec narrowed to the columns ``raw`` actually has."""
    return spec.restrict(raw.columns)


# Structural lines of the mapping file: (block, idx, line).  Data lines are
# placed in the header's block with idx >= 1, so they follow the header.
_STRUCTURE = [
    (0, 0, "admission_type_id,description"),
    (1, 0, ","),
    (2, 0, "discharge_disposition_id,description"),
    (3, 0, " ,"),
    (4, 0, "admission_source_id,description"),
    (5, 0, ","),
    (5, 1, "\t,  "),
    (6, 0, ""),
    (6, 1, "payer_code,description"),
    (7, 0, ","),
]

MAPPING_FILE = "mapping.csv"


def mapping_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``file, block, idx, line`` of a sectioned mapping file derived from the tables."""
    fixed = literal_rows(spark, _STRUCTURE, "block long, idx long, line string")
    orders = load(spark, sf_dir, "orders")
    p, st = F.col("o_orderpriority"), F.col("o_orderstatus")
    types = orders.select(p, st).distinct().select(
        F.lit(0).cast("long").alias("block"),
        (F.lit(1) + F.ascii(p) * 1000 + F.ascii(st)).cast("long").alias("idx"),
        F.concat(F.substring(p, 1, 1), F.lit(","), F.expr("substring(o_orderpriority, 3)"),
                 F.lit(" "), st).alias("line"))
    nation = load(spark, sf_dir, "nation").select(
        F.lit(2).cast("long").alias("block"),
        (F.col("n_nationkey") + 1).cast("long").alias("idx"),
        F.concat(F.col("n_nationkey").cast("string"), F.lit(',"'), F.col("n_name"),
                 F.lit(", region "), F.col("n_regionkey").cast("string"), F.lit('"')).alias("line"))
    region = load(spark, sf_dir, "region")
    sources = region.select(
        F.lit(4).cast("long").alias("block"),
        (F.col("r_regionkey") * 2 + 1).cast("long").alias("idx"),
        F.concat(F.col("r_regionkey").cast("string"), F.lit(","), F.col("r_name")).alias("line"),
    ).unionAll(region.select(
        F.lit(4).cast("long").alias("block"),
        (F.col("r_regionkey") * 2 + 2).cast("long").alias("idx"),
        F.concat(F.lit(","), F.lower(F.col("r_name"))).alias("line")))
    segments = load(spark, sf_dir, "customer").select("c_mktsegment").distinct().select(
        F.lit(6).cast("long").alias("block"),
        (F.lit(2) + F.ascii("c_mktsegment")).cast("long").alias("idx"),
        F.concat(F.substring("c_mktsegment", 1, 2), F.lit(","), F.col("c_mktsegment")).alias("line"))
    return (fixed.unionAll(types).unionAll(nation).unionAll(sources).unionAll(segments)
            .select(F.lit(MAPPING_FILE).alias("file"), "block", "idx", "line"))
