"""Incremental silver curation with Structured Streaming.

New raw CSV files landing in a directory are curated micro-batch by
micro-batch with the same Column expressions as the batch flow: corrupt-row
capture, sentinel -> null, lenient hard-schema cast, standardisation and
derived columns.  Each batch's quality metrics (rows, corrupt rows, cast
failures, nulls, rule violations) are collected by an ``Observation`` on the
batch write and stored as that epoch's log record.

Exactly-once output: ``foreachBatch`` may replay an epoch after a failure, so
each epoch's rows and its metrics record are written with ``overwrite`` to
their own ``epoch=<id>`` folders -- a replay replaces, never duplicates.  Progress lives in the checkpoint
folder (shared storage), so a restarted query resumes where it stopped.

De-duplication is not applied across batches here: the deterministic choice
of the kept row needs the whole key group, which is a batch step over the
accumulated table (``curate.operators.dedupe``).  ``dedupe="first"`` opts
into Spark's stateful ``dropDuplicates`` (first arrival wins; state holds one
entry per key).
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from curate.functions.casting import lenient_cast
from curate.operators.cleaning import cast_failure_predicates, nullify, q
from curate.operators.standardise import curate
from curate.plans.steplog import SUCCESS, utc_iso
from curate.sources.literal import literal_rows
from curate.spec import FactSpec

STEP_BATCH = "silver_stream__micro_batch"


def raw_stream(spark: SparkSession, source_dir: str, names: list[str],
               corrupt_col: str = "_corrupt_record", max_files_per_trigger: int | None = None
               ) -> DataFrame:
    """All-string permissive CSV stream with a corrupt-record column."""
    schema = T.StructType([T.StructField(n, T.StringType(), True) for n in names]
                          + [T.StructField(corrupt_col, T.StringType(), True)])
    reader = (spark.readStream.schema(schema).option("header", True)
              .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", corrupt_col)
              .option("columnPruning", False).option("enforceSchema", False))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.csv(source_dir)


def curated_stream(raw: DataFrame, spec: FactSpec, corrupt_col: str = "_corrupt_record",
                   dedupe: str | None = None) -> DataFrame:
    """Typed + standardised rows with per-row metric flags ``_corrupt``/``_cf<i>``."""
    # the corrupt column stays as it is: a malformed line may read like the sentinel
    nulled = nullify(raw, spec.sentinel, [c for c in raw.columns if c != corrupt_col])
    fails = cast_failure_predicates(spec.schema)
    typed = nulled.select(
        *[lenient_cast(q(f.name), f.dataType).alias(f.name) for f in spec.schema.fields],
        *[p.alias(f"_cf{i}") for i, (_, p) in enumerate(fails)],
        q(corrupt_col).isNotNull().alias("_corrupt"))
    if dedupe == "first":
        typed = typed.dropDuplicates(list(spec.key))
    return curate(typed, spec)        # flag columns pass through untouched


def batch_writer(spec: FactSpec, out_dir: str, log_dir: str, fmt: str = "parquet"):
    """``foreachBatch`` function: observe metrics, write the epoch and its log record.

    Both go to ``epoch=<id>`` folders with ``overwrite``: a replayed epoch
    replaces its rows and its metrics record instead of adding to them.
    """
    fails = cast_failure_predicates(spec.schema)

    def write(batch: DataFrame, epoch_id: int) -> None:
        obs = Observation(f"epoch_{epoch_id}")
        aggs = [F.count(F.lit(1)).alias("rows"), F.count_if("_corrupt").alias("corrupt_rows")]
        aggs += [F.count_if(f"_cf{i}").alias(f"cf{i}") for i in range(len(fails))]
        aggs += [F.count_if(q(c).isNull()).alias(f"null{i}") for i, c in enumerate(spec.columns)]
        aggs += [F.count_if(r.violated()).alias(f"r{i}") for i, r in enumerate(spec.rules)]
        (batch.observe(obs, *aggs).select(*[q(c) for c in spec.curated_columns()])
         .write.mode("overwrite").format(fmt).save(f"{out_dir}/epoch={epoch_id}"))
        m = obs.get
        record = {"seq": int(epoch_id), "step": STEP_BATCH, "status": SUCCESS,
                  "timestamp_utc": utc_iso(), "payload": {
            "epoch": epoch_id, "rows": int(m["rows"]), "corrupt_rows": int(m["corrupt_rows"]),
            "casting_failures_by_column": {f.name: int(m[f"cf{i}"])
                                           for i, (f, _) in enumerate(fails) if m[f"cf{i}"]},
            "missing_values": {c: int(m[f"null{i}"]) for i, c in enumerate(spec.columns)
                               if m[f"null{i}"]},
            "violations_by_constraint": {r.name: int(m[f"r{i}"]) for i, r in enumerate(spec.rules)
                                         if r.report_zero or m[f"r{i}"]},
        }}
        (literal_rows(batch.sparkSession, [(json.dumps(record),)], "value string")
         .write.mode("overwrite").text(f"{log_dir}/epoch={epoch_id}"))
    return write


def start_curation(spark: SparkSession, source_dir: str, spec: FactSpec, out_dir: str,
                   checkpoint_dir: str, log_dir: str, names: list[str] | None = None,
                   available_now: bool = True, dedupe: str | None = None,
                   max_files_per_trigger: int | None = None) -> tuple[StreamingQuery, str]:
    """Start the incremental curation query (``availableNow`` drains what is there, then stops).

    Returns the query and the folder of its per-epoch metric records
    (read them with :func:`read_batch_log`).
    """
    raw = raw_stream(spark, source_dir, names or spec.columns,
                     max_files_per_trigger=max_files_per_trigger)
    stream = curated_stream(raw, spec, dedupe=dedupe)
    writer = (stream.writeStream.foreachBatch(batch_writer(spec, out_dir, log_dir))
              .option("checkpointLocation", checkpoint_dir))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime="30 seconds")
    return writer.start(), log_dir


def read_batch_log(spark: SparkSession, log_dir: str) -> DataFrame:
    """One metrics record per committed or replayed epoch (``epoch`` is the folder)."""
    return (spark.read.schema("seq long, step string, status string, timestamp_utc string, "
                              "payload string, epoch long").json(log_dir)
            .where(F.col("step").isNotNull()))


def read_curated(spark: SparkSession, out_dir: str) -> DataFrame:
    """All curated epochs written so far (the ``epoch`` folder is a partition column)."""
    return spark.read.parquet(out_dir)
