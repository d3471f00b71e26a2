"""Catalog and file sinks (SNK1, SNK2, SNK3, SNK5)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def ensure_db(spark: SparkSession, db: str, location: str | None = None) -> None:
    """``CREATE DATABASE IF NOT EXISTS`` (optionally at an explicit shared location)."""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{db}`{loc}")


def save_table(df: DataFrame, name: str, fmt: str = "parquet", path: str | None = None,
               observation: Observation | None = None) -> dict:
    """Overwrite table ``name``; rows are counted by the write job itself.

    Returns ``{table, rows_saved, columns_saved, format}``.
    """
    obs = observation or Observation(f"save_{name.replace('.', '_')}")
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows_saved"))
    writer = observed.write.format(fmt).mode("overwrite")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return {"table": name, "rows_saved": int(obs.get["rows_saved"]),
            "columns_saved": len(df.columns), "format": fmt}


# Table properties that name the folder a published table reads, and the one before it.
CURRENT, PREVIOUS = "curate.current", "curate.previous"


def table_versions(spark: SparkSession, name: str) -> tuple[str | None, str | None]:
    """(current, previous) folder of a published table; nulls for a table that is not there."""
    if not spark.catalog.tableExists(name):
        return None, None
    props = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    return props.get(CURRENT), props.get(PREVIOUS)


def _point(spark: SparkSession, name: str, fmt: str, schema: T.StructType, current: str,
           previous: str | None) -> None:
    """Let ``name`` read ``current``: a catalogue change, no data moves."""
    props = f"'{CURRENT}' = '{current}'" + (f", '{PREVIOUS}' = '{previous}'" if previous else "")
    if spark.catalog.tableExists(name):
        old = spark.table(name).schema
        if [(f.name, f.dataType) for f in old.fields] == [(f.name, f.dataType) for f in schema.fields]:
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{current}'")
            spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({props})")
            spark.catalog.refreshTable(name)
            return
        spark.sql(f"DROP TABLE {name}")            # other columns: only the entry goes, its files stay
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE {name} ({cols}) USING {fmt} LOCATION '{current}' TBLPROPERTIES ({props})")


def publish_table(df: DataFrame, name: str, root: str, fmt: str = "parquet",
                  observation: Observation | None = None) -> dict:
    """Overwrite table ``name`` so that readers see the old rows or the new ones, never neither.

    The rows are written to a folder of their own under ``root``; only when that job has
    committed does the table point to it.  A job that fails or is killed leaves the
    table as it was.  The version before stays readable (:func:`roll_back`); ``df`` may read
    ``name`` itself.  Returns what :func:`save_table` does.
    """
    spark = df.sparkSession
    obs = observation or Observation(f"publish_{name.replace('.', '_')}")
    target = f"{root}/version-{uuid.uuid4().hex}"
    df.observe(obs, F.count(F.lit(1)).alias("rows_saved")).write.format(fmt).save(target)
    _point(spark, name, fmt, df.schema, target, table_versions(spark, name)[0])
    return {"table": name, "rows_saved": int(obs.get["rows_saved"]), "columns_saved": len(df.columns),
            "format": fmt}


def roll_back(spark: SparkSession, name: str, fmt: str = "parquet") -> str:
    """Let ``name`` read its previous version again; returns that folder."""
    current, previous = table_versions(spark, name)
    if previous is None:
        raise ValueError(f"{name} has no previous version")
    _point(spark, name, fmt, spark.read.format(fmt).load(previous).schema, previous, current)
    return previous


def write_report(df: DataFrame, path: str) -> None:
    """Overwrite a (one-row) report as JSON."""
    df.coalesce(1).write.mode("overwrite").json(path)
