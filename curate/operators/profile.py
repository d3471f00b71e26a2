"""Ingestion, key and missing-value profiles (AGG1, AGG2, AGG5, SRT3)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curate.functions.numeric import pct
from curate.operators.cleaning import q
from curate.operators.metrics import counts_long

CORRUPT = "_corrupt_record"


def ingest_metrics(df: DataFrame, corrupt_col: str = CORRUPT) -> DataFrame:
    """One row ``rows, cols, corrupt_rows``; ``cols`` excludes the corrupt-record column.

    Without a corrupt-record column the count is 0.
    """
    data_cols = [c for c in df.columns if c != corrupt_col]
    if corrupt_col not in df.columns:
        return df.agg(F.count(F.lit(1)).alias("rows")).select(
            "rows", F.lit(len(data_cols)).alias("cols"), F.lit(0).cast("long").alias("corrupt_rows"))
    # File sources refuse scans that read only the corrupt-record column, so a
    # data column is read too; the output references it so it is not pruned.
    probe = q(data_cols[0]) if data_cols else F.lit(1)
    agg = df.agg(F.count(F.lit(1)).alias("rows"),
                 F.count_if(q(corrupt_col).isNotNull()).alias("_corrupt"),
                 F.count(probe).alias("_probe"))
    return agg.select("rows", F.lit(len(data_cols)).alias("cols"),
                      F.when(F.col("_probe") >= 0, F.col("_corrupt")).alias("corrupt_rows"))


def key_stats(df: DataFrame, key: str) -> DataFrame:
    """One row ``rows, distinct_ids, duplicates`` (null ids are not counted as distinct)."""
    return df.agg(F.count(F.lit(1)).alias("rows"),
                  F.count_distinct(q(key)).alias("distinct_ids")).select(
        "rows", "distinct_ids", (F.col("rows") - F.col("distinct_ids")).alias("duplicates"))


def null_profile(df: DataFrame, only_nulls: bool = True, with_ordinal: bool = False) -> DataFrame:
    """Per column ``column, null_count, null_pct`` from one aggregation.

    ``with_ordinal`` adds the column's schema position (stable tie-break).
    """
    long = counts_long(df, [(c, q(c).isNull()) for c in df.columns], "column", "null_count",
                       ordinal_col="ordinal")
    cols = ["column", "null_count", pct(F.col("null_count"), F.col("total")).alias("null_pct")]
    if with_ordinal:
        cols.append("ordinal")
    out = long.select(*cols)
    return out.where(F.col("null_count") > 0) if only_nulls else out


def top_null_columns(df: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` columns with the highest null share; ties keep schema order."""
    prof = null_profile(df, with_ordinal=True)
    return (prof.orderBy(F.col("null_pct").desc(), F.col("ordinal").asc())
            .limit(n).select("column", "null_count", "null_pct"))
