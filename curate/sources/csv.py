"""Permissive all-string CSV ingestion with corrupt-record capture (SRC6, SRC7, SNK7)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


def header_names(spark: SparkSession, path: str, **options: str) -> list[str]:
    """Column names from the CSV header (Spark reads only the first line)."""
    return spark.read.options(header=True, inferSchema=False, **options).csv(path).columns


def read_permissive_csv(spark: SparkSession, path: str, names: Sequence[str] | None = None,
                        corrupt_col: str = CORRUPT, **options: str) -> DataFrame:
    """Header CSV read as all strings plus a ``corrupt_col`` holding malformed rows' text.

    Malformed rows (too many or too few fields, broken quoting) keep their
    parsed prefix and carry the raw line in ``corrupt_col``.  Parser-level
    column pruning is disabled so the corrupt flag is right however few
    columns a query reads.  With ``names=None`` the (first file's) header gives
    the names, and every file's header is validated against them
    (``enforceSchema=false``): a file with other columns or another column
    order fails the read instead of being loaded shifted.
    """
    if names is None:
        names = header_names(spark, path, **options)
    schema = T.StructType([T.StructField(n, T.StringType(), True) for n in names]
                          + [T.StructField(corrupt_col, T.StringType(), True)])
    return (spark.read.schema(schema)
            .option("header", True)
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", corrupt_col)
            .option("columnPruning", False)
            .option("enforceSchema", False)
            .options(**options)
            .csv(path))


def split_corrupt(df: DataFrame, corrupt_col: str = CORRUPT) -> tuple[DataFrame, DataFrame]:
    """``(good, bad)``: rows without / with a corrupt-record value."""
    c = F.col(corrupt_col)
    return df.where(c.isNull()), df.where(c.isNotNull())


def corrupt_text(df: DataFrame, corrupt_col: str = CORRUPT) -> Column:
    """The corrupt-record column, written so the scan also reads one data column.

    File sources refuse scans whose only column is the corrupt record; the
    always-true condition on a data column keeps that column in the scan.
    """
    data = [c for c in df.columns if c != corrupt_col]
    if not data:
        return F.col(corrupt_col)
    probe = F.length(F.coalesce(F.col(f"`{data[0]}`").cast("string"), F.lit("")))
    return F.when(probe >= 0, F.col(corrupt_col))


#: Where a diverted row came from: its file, and the start of the block it was read in.
ORIGIN = {"_bad_file": "_metadata.file_path", "_bad_block": "_metadata.file_block_start"}


def divert_corrupt(raw: DataFrame, staged: str, bad_records_dir: str, corrupt_col: str = CORRUPT,
                   from_files: bool = True) -> tuple[DataFrame, int]:
    """``(good rows, number of bad rows)``, reading ``raw`` once.

    One write parts the rows by a flag into ``staged`` (Parquet); the raw text of the bad
    ones, with their origin, goes from there to ``bad_records_dir`` (a line each) and
    ``{bad_records_dir}_origin`` (Parquet: file, block, record).  Later steps read the good part,
    which is columnar and typed, instead of parsing the input again.
    """
    data = [c for c in raw.columns if c != corrupt_col]
    origin = [F.col(src).alias(name) for name, src in ORIGIN.items()] if from_files else [
        F.lit(None).cast(t).alias(name) for name, t in zip(ORIGIN, ("string", "long"))]
    seen = Observation()
    flagged = raw.select("*", *origin).withColumn("_bad", F.col(corrupt_col).isNotNull())
    flagged.observe(seen, F.count_if("_bad").alias("n")).write.partitionBy("_bad").parquet(staged)
    spark, schema = raw.sparkSession, T.StructType([*flagged.schema.fields])
    parts = spark.read.schema(schema).parquet(staged)
    good = parts.where("NOT _bad").select(*[F.col(f"`{c}`") for c in data], F.col(corrupt_col))
    bad = parts.where("_bad")
    bad.select(corrupt_col).write.mode("overwrite").text(bad_records_dir)
    (bad.select(F.col("_bad_file").alias("file"), F.col("_bad_block").alias("block"), F.col(corrupt_col).alias("record"))
     .write.mode("overwrite").parquet(f"{bad_records_dir}_origin"))
    return good, int(seen.get["n"] or 0)


def write_bad_records(bad: DataFrame, path: str, corrupt_col: str = CORRUPT) -> None:
    """Write the raw text of malformed rows, one per line."""
    bad.select(corrupt_text(bad, corrupt_col).alias(corrupt_col)).write.mode("overwrite").text(path)
