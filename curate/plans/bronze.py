"""Bronze layer (SRC1 + SNK4 + PIPE4/PIPE5): archives -> extracted members.

Archives are expanded in parallel and every expected member's text is
streamed (decoded in bounded chunks) to ``<run's folder>/file_name=<name>/``,
so members of the same name from many archives land together and are read
back as one input, and no member is ever held whole in memory.  Every call
extracts into a folder of its own, so what an earlier run or attempt left is
never read as this run's data.  The same job writes a member manifest (path,
member, size, type, target) as a table; the log records counts, the manifest's
path and the missing expected names.
"""

from __future__ import annotations

import logging
import uuid
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from curate.operators.integrity import missing_expected
from curate.plans.report import BRONZE_METRICS, build_report, report_document
from curate.plans.sinks import write_report
from curate.plans.steplog import StepLog
from curate.sources.archive import expand_archives, extract_members, list_archives
from curate.sources.steplog import read_step_log

_log = logging.getLogger("curate.bronze")

# The bronze step name and the expected archive members.
STEP_EXTRACT = "diabetes_zip_extract"
EXPECTED_FILES = ("diabetic_data.csv", "IDS_mapping.csv")


@dataclass(frozen=True)
class BronzeConfig:
    base_dir: str
    archive_path: str
    expected: tuple[str, ...] = EXPECTED_FILES
    pipeline_name: str = "Bronze Layer ETL"
    # True: tasks open archives and write members through pyarrow.fs (bounded memory).
    # False: archive bytes and member text go through Spark (binaryFile, text writer) --
    # for file systems pyarrow cannot open; a member must then fit one Spark value (2 GB).
    stream: bool = True

    @property
    def extract_root(self) -> str:
        return f"{self.base_dir}/raw_extracted"

    @property
    def manifest_root(self) -> str:
        return f"{self.base_dir}/_manifest"

    @property
    def log_dir(self) -> str:
        return f"{self.base_dir}/_logs"

    @property
    def report_path(self) -> str:
        return f"{self.base_dir}/data_quality_report"


def member_dir(extract_dir: str, file_name: str) -> str:
    """The folder with all members of one name that a run extracted."""
    return f"{extract_dir}/file_name={file_name}"


def run_bronze(spark: SparkSession, cfg: BronzeConfig, run_id: str | None = None) -> dict:
    """Extract the expected members of every archive under ``cfg.archive_path``.

    ``extract_dir`` of the result is this call's folder; read it with :func:`member_dir`.
    """
    log = StepLog(spark, cfg.log_dir, run_id)
    # a re-used run id is another attempt, with a folder of its own
    attempt = f"run_id={log.run_id}/attempt={uuid.uuid4().hex[:8]}"
    extract_dir, manifest_dir = f"{cfg.extract_root}/{attempt}", f"{cfg.manifest_root}/{attempt}"
    with log.step(STEP_EXTRACT, zip_path=cfg.archive_path, extract_dir=extract_dir) as payload:
        # One job: tasks stream each expected member to its file and emit a
        # manifest row, which is written as the manifest table.
        obs = Observation("extract")
        cached: list[DataFrame] = []
        if cfg.stream:
            manifest = extract_members(spark, cfg.archive_path, extract_dir, cfg.expected)
        else:
            manifest = _extract_through_spark(spark, cfg, extract_dir, cached)
        (manifest.observe(obs, F.coalesce(F.sum("size_bytes"), F.lit(0)).alias("bytes"))
         .write.mode("overwrite").parquet(manifest_dir))
        for df in cached:
            df.unpersist()
        saved = spark.read.parquet(manifest_dir)
        is_csv = F.lower("file_name").endswith(".csv")
        counts = saved.agg(F.count(F.lit(1)).alias("n"), F.count_if(is_csv).alias("csv"),
                           F.count_distinct("path").alias("archives")).first()
        missing = [r[0] for r in missing_expected(spark, saved, cfg.expected).collect()]
        zip_bytes = list_archives(spark, cfg.archive_path).agg(F.sum("length")).first()[0] or 0
        csv_dirs = [member_dir(extract_dir, n) for n in cfg.expected
                    if n.lower().endswith(".csv") and n not in missing]
        payload.update(zip_path=cfg.archive_path, extract_dir=extract_dir,
                       archives=int(counts["archives"]), exported_files_count=int(counts["n"]),
                       exported_files=manifest_dir,     # the list is a table: it has no bound
                       zip_size_mb=round(zip_bytes / (1 << 20), 2), csv_files_found=int(counts["csv"]),
                       total_rows=_data_rows(spark, csv_dirs),
                       extracted_bytes=int(obs.get["bytes"]), manifest=manifest_dir,
                       expected_missing=missing)
        if missing:
            _log.warning("missing expected files: %s", missing)
    report = bronze_report_or_none(spark, cfg, log.run_id)
    if report is not None:
        write_report(report_document(report, BRONZE_METRICS), cfg.report_path)
    return {"run_id": log.run_id, "log": log, "report": report, "manifest": saved,
            "missing": missing, "extract_dir": extract_dir}


def _data_rows(spark: SparkSession, dirs: list[str]) -> int:
    """Non-blank lines of the extracted files, without the first of each (its header)."""
    if not dirs:
        return 0
    lines = spark.read.text(dirs).where(F.trim("value") != "")
    per_file = lines.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("n"))
    return int(per_file.agg(F.sum(F.col("n") - 1)).first()[0] or 0)


def _extract_through_spark(spark: SparkSession, cfg: BronzeConfig, extract_dir: str,
                           cached: list[DataFrame]) -> DataFrame:
    """Members via ``binaryFile`` content, text written by Spark partitioned by name.

    The expanded members are persisted for the two writes (text, manifest) and
    appended to ``cached`` for release afterwards.
    """
    members = expand_archives(spark, cfg.archive_path, cfg.expected, stream=False).persist(
        StorageLevel.MEMORY_AND_DISK)
    cached.append(members)
    # one member a file: each begins with its own header line
    (members.select("file_name", "text").write.mode("overwrite").option("maxRecordsPerFile", 1)
     .partitionBy("file_name").text(extract_dir))
    target = F.concat(F.lit(f"{extract_dir}/file_name="), F.col("file_name"))
    return members.select("path", "member_path", "file_name", "size_bytes", "type",
                          target.alias("target_path"))


def bronze_report_or_none(spark: SparkSession, cfg: BronzeConfig, run_id: str) -> DataFrame | None:
    """The bronze report; a failure is printed and skipped (the silver one is not)."""
    try:
        return build_report(read_step_log(spark, cfg.log_dir, run_id, require=True),
                            cfg.pipeline_name, "bronze", BRONZE_METRICS, score=False)
    except Exception as e:  # report generation for bronze is best effort
        _log.error("bronze report generation failed: %s", e)
        return None
