"""Append-only step log (SNK4, SNK6).

One JSON line per step: ``{seq, step, status, timestamp_utc, payload}``,
stored under ``<log_dir>/run_id=<id>/``.  A failing step logs ``FAILED`` with
the error and re-raises.  History is kept: a run is selected by ``run_id``
(partition pruning) instead of deleting old logs.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from contextlib import contextmanager
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from curate.sources.literal import literal_rows
from curate.sources.steplog import read_step_log

SUCCESS, FAILED = "SUCCESS", "FAILED"
# Payload field that ties a committed step to the input it was run on.
FINGERPRINT = "input_fingerprint"


def utc_iso() -> str:
    return datetime.now(timezone.utc).replace(tzinfo=None).isoformat() + "Z"


def compact_log(spark: SparkSession, log_dir: str, compacted: str, final_steps: Sequence[str]) -> list[str]:
    """Fold finished runs into one columnar file each under ``compacted``; returns their ids.

    A run is finished when the last record of one of ``final_steps`` is a success.  Folding
    replaces whole runs (dynamic partition overwrite), so a repeated or interrupted
    compaction, and a run that went on after it was folded, give the same table.
    """
    log = read_step_log(spark, log_dir)
    last = log.where(F.col("step").isin(list(final_steps))).groupBy("run_id", "step").agg(F.max_by("status", "seq").alias("status"))
    done = last.where(F.col("status") == SUCCESS).select("run_id").distinct()
    rows = log.join(F.broadcast(done), "run_id", "left_semi")          # one short id for each run
    (rows.repartition("run_id").sortWithinPartitions("run_id", "seq").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(compacted))
    return sorted(r["run_id"] for r in done.collect())


class StepLog:
    """Writes step records under ``log_dir`` (one small text part file per record)."""

    def __init__(self, spark: SparkSession, log_dir: str, run_id: str | None = None):
        self.spark = spark
        self.log_dir = log_dir
        self.run_id = run_id or uuid.uuid4().hex
        # a run id used before goes on counting, so its last record stays the last
        self.seq = self._stored_seq() if run_id else 0
        self.records: list[dict] = []

    def _stored_seq(self) -> int:
        try:
            log = read_step_log(self.spark, self.log_dir, self.run_id)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return 0
        return int(log.agg(F.max("seq")).first()[0] or 0)

    def committed(self, step: str, fingerprint: str) -> dict | None:
        """The payload of the step's last record in this run, if it succeeded on the same input."""
        try:
            log = read_step_log(self.spark, self.log_dir, self.run_id)
            last = log.where(F.col("step") == step).orderBy(F.desc("seq")).first()
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        if last is None or last["status"] != SUCCESS:
            return None
        found = json.loads(last["payload"])
        return found if found.get(FINGERPRINT) == fingerprint else None

    def write(self, step: str, status: str, payload: dict) -> dict:
        return self.write_many([(step, status, payload)])[0]

    def write_many(self, entries: list[tuple[str, str, dict]]) -> list[dict]:
        """Append several records with one small write (one part file)."""
        records = []
        for step, status, payload in entries:
            self.seq += 1
            records.append({"run_id": self.run_id, "seq": self.seq, "step": step,
                            "status": status, "timestamp_utc": utc_iso(), "payload": payload})
        # The run id is the folder (``run_id=<id>``), so reading one run prunes the rest.
        lines = [(json.dumps({k: v for k, v in r.items() if k != "run_id"},
                             default=_json_default),) for r in records]
        (literal_rows(self.spark, lines, "value string").write.mode("append")
         .text(f"{self.log_dir}/run_id={self.run_id}"))
        self.records.extend(records)
        return records

    @contextmanager
    def step(self, name: str, **on_failure):
        """``with log.step(name) as payload: ...`` -- fill ``payload``; logged on exit."""
        payload: dict = {}
        try:
            yield payload
        except Exception as e:
            self.write(name, FAILED, {**on_failure, "error": str(e)})
            raise
        self.write(name, SUCCESS, payload)


def _json_default(v):
    if hasattr(v, "item"):
        return v.item()
    return str(v)
