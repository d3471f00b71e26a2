"""A corpus pipeline over ``documents``: language ID, exact deduplication, near-duplicate
removal, benchmark decontamination, and mixing of sources.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as
Parquet and read again as the next stage's documents.  All but the last return the
columns of ``documents``, and any further ones as they came.  Empty texts have no letter and go
with the first stage; the others keep them as they keep any text.  An empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curate.llm import decontaminate, exactdedup, jaccard, langid, mixing
from curate.llm.textbytes import materialise


#: The columns of ``documents``.
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def own_columns(stage: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """A stage that meets further columns under names that no operator uses, so that none is
    overwritten or clashes; they come out under their own names and with their own values.
    Of the last stage's columns its own stay where an input column has the same name."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        further = {c: f"_further_{k}" for k, c in enumerate(docs.columns) if c not in COLUMNS}
        out = stage(spark, docs.withColumnsRenamed(further), sf_dir)
        made = {c.lower() for c in out.columns if c not in further.values()}
        lost = [name for c, name in further.items() if c.lower() in made]
        return out.drop(*lost).withColumnsRenamed({name: c for c, name in further.items()})

    return run


@own_columns
def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told; those without a letter, and long ones with a narrow margin, go.
    Where no document has a language there is none to tell: then only those without a letter go."""
    known = langid.learn(docs)
    if not known:
        return docs.filter(F.trim(langid.letters(F.col("text"))) != "")
    found = langid.identify(spark, docs, known)
    return found.filter(~langid.rejected()).select(*docs.columns)


@own_columns
def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the smallest doc_id."""
    return exactdedup.keep_one(docs)


def keyed(docs: DataFrame) -> DataFrame:
    """The rows with a key of their own (``_row``), written once: ids may be null or repeated."""
    return materialise(docs.withColumn("_row", F.monotonically_increasing_id()), "rows")


@own_columns
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, Jaccard 0.8): the smallest doc_id,
    a null one only if there is no other.  Rows that share an id are documents of their own."""
    rows = keyed(docs)
    groups = jaccard.components(rows, size=5, threshold=(80, 100), id_col="_row").select(F.col("doc_id").alias("_row"), "component_id")
    kept = (rows.select("_row", "doc_id").join(groups, "_row").groupBy("component_id")
            .agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_row"))["_row"].alias("_row")))
    # few rows go, and where their numbers fit in a broadcast the texts stay where they are
    gone = materialise(groups.select("_row").join(kept, "_row", "left_anti"), "gone")
    return rows.join(F.broadcast(gone) if gone.count() <= jaccard.BROADCAST_IDS else gone, "_row", "left_anti").select(*docs.columns)


@own_columns
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of the benchmark; those that consist of them go."""
    found = decontaminate.find_phrases(spark, docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    clean = decontaminate.remove_spans(found.filter((F.col("n_hit") == 0) | (F.col("n_hit") < F.col("n_words"))))
    n_chars = F.when(F.col("n_hit") > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return clean.withColumn("n_chars", n_chars).select(*docs.columns)


@own_columns
def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: each document as often as it is taken (copy 1 to 3), with its size and its source's target.
    Rows with a null id, and rows that share one, are documents of their own."""
    rows = keyed(docs)
    mix = mixing.mix_sources(rows, carry=("_row",)).filter("copies > 0").select("_row", "size", "target", "copies")
    return (rows.join(mix, "_row")
            .select(*docs.columns, "size", "target", F.explode(F.sequence(F.lit(1), "copies")).alias("copy")))


STAGES = [("language_id", language_id), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup),
          ("decontamination", decontamination), ("mixing", mixing_sources)]

#: The first and the last stage can't be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialise(docs, f"stage-{name}")
    return docs
