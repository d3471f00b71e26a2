"""Step-log scan (SRC9).

Log records are JSON lines ``{seq, step, status, timestamp_utc, payload}``
under ``run_id=<id>/`` folders, ``payload`` being a JSON object read back as
its raw JSON text so any payload shape fits one schema.  Selecting a run is
a partition filter: other runs' files are not read.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOG_SCHEMA = ("seq long, step string, status string, timestamp_utc string, payload string, "
              "run_id string")


def compacted_runs(spark: SparkSession, compacted: str) -> list[str]:
    """Runs that the compacted log holds (its folders' names; one small job)."""
    try:
        return sorted(r["run_id"] for r in read_compacted(spark, compacted).select("run_id").distinct().collect())
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return []


def read_compacted(spark: SparkSession, compacted: str) -> DataFrame:
    return spark.read.schema(LOG_SCHEMA).parquet(compacted)


def read_step_log(spark: SparkSession, path: str, run_id: str | None = None,
                  require: bool = False, compacted: str | None = None) -> DataFrame:
    """Parse the log's non-blank lines; optionally keep one run.

    With ``compacted``, runs that were folded into that folder come from there and
    all others from ``path``, so a run is read once whether or not its files were
    compacted meanwhile.

    ``require`` raises ``ValueError`` when no record remains (a small
    ``isEmpty`` job), as a report from an empty log is meaningless.
    """
    log = spark.read.schema(LOG_SCHEMA).json(path).where(F.col("step").isNotNull())
    if compacted is not None:
        folded = compacted_runs(spark, compacted)
        if folded:
            log = log.where(~F.col("run_id").isin(folded)).unionByName(read_compacted(spark, compacted))
    if run_id is not None:
        log = log.where(F.col("run_id") == run_id)
    if require and log.isEmpty():
        raise ValueError(f"No valid log entries found in {path}" +
                         (f" for run {run_id}" if run_id else ""))
    return log
