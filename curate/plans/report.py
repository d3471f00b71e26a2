"""Quality report folded from the step log (AGG10, AGG11, AGG12).

The log is aggregated twice: per step (last status, last record, each
metric's latest value) and then over the few step rows.  Everything stays in
one Spark query; nothing is collected.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curate.functions.jsonfmt import format_metric, parsed, payload, utc_now_iso, variant_field


@dataclass(frozen=True)
class Metric:
    name: str
    step: str
    path: str
    data_type: str = "bigint"
    default: object = 0


# Report metric names and the step payload fields they come from.
SILVER_METRICS = (
    Metric("input_rows", "silver_fact_ingest__load_csv", "rows"),
    Metric("corrupt_rows", "silver_fact_ingest__load_csv", "corrupt_rows"),
    Metric("casting_failures", "silver_fact_ingest__hard_schema_exact", "casting_failures_total"),
    Metric("duplicates_removed", "silver_validation__duplicates", "duplicates_removed"),
    Metric("columns_with_nulls", "silver_validation__missing_values", "columns_with_nulls"),
    Metric("missing_values_details", "silver_validation__missing_values", "missing_values",
           "string", "{}"),
    Metric("orphaned_fk_rows", "silver_validation__referential_integrity", "total_orphaned_rows"),
    Metric("constraint_violations", "silver_validation__business_constraints", "total_violations"),
    Metric("violations_by_constraint", "silver_validation__business_constraints",
           "violations_by_constraint", "string", "{}"),
    Metric("output_rows", "silver_fact_save", "rows_saved"),
    Metric("output_table", "silver_fact_save", "table", "string", ""),
)

BRONZE_METRICS = (
    Metric("archives_read", "diabetes_zip_extract", "archives"),
    Metric("files_extracted", "diabetes_zip_extract", "exported_files_count"),
    Metric("extraction_path", "diabetes_zip_extract", "extract_dir", "string", ""),
    Metric("expected_missing", "diabetes_zip_extract", "expected_missing", "string", "[]"),
    Metric("zip_size_mb", "diabetes_zip_extract", "zip_size_mb", "double"),
    Metric("csv_files_found", "diabetes_zip_extract", "csv_files_found"),
    Metric("total_rows", "diabetes_zip_extract", "total_rows"),
)

# Issues summed by the quality score (each a metric name above).
SCORE_ISSUES = ("corrupt_rows", "casting_failures", "duplicates_removed", "orphaned_fk_rows",
                "constraint_violations")


def quality_score(input_rows: Column, issues: Sequence[Column]) -> Column:
    """``round(100 * (1 - sum(issues) / input_rows), 2)``; may be negative; null on 0 rows."""
    total = issues[0]
    for c in issues[1:]:
        total = total + c
    return F.round(F.try_divide(F.lit(100) * (input_rows - total), input_rows), 2)


def build_report(log: DataFrame, pipeline: str, layer: str,
                 metrics: Sequence[Metric] = SILVER_METRICS, score: bool = True) -> DataFrame:
    """One-row report: ``pipeline, layer, execution_timestamp, total_steps, step_count,
    success_steps, steps_status, <metrics...>[, quality_score_pct]``.
    """
    # only the last record of a step counts: its payload is parsed, once
    per_step = log.groupBy("step").agg(
        F.count(F.lit(1)).alias("_records"),
        F.max("seq").alias("_last_seq"),
        F.max_by("status", "seq").alias("_status"),
        F.max_by("timestamp_utc", "seq").alias("_ts"),
        F.max_by("payload", "seq").alias("_payload"),
    ).select("*", parsed("_payload").alias("_fields"))
    per_step = per_step.select("step", "_records", "_last_seq", "_status", "_ts", *[
        F.when(F.col("step") == m.step, variant_field("_fields", m.path, m.data_type)).alias(f"_m{i}")
        for i, m in enumerate(metrics)])
    values = [F.coalesce(F.max(f"_m{i}"), F.lit(m.default).cast(m.data_type)).alias(m.name)
              for i, m in enumerate(metrics)]
    report = per_step.agg(
        F.sum("_records").cast("long").alias("total_steps"),
        F.count(F.lit(1)).alias("step_count"),
        F.count_if(F.col("_status") == "SUCCESS").alias("success_steps"),
        F.max_by("_ts", "_last_seq").alias("execution_timestamp"),
        F.map_from_entries(F.transform(
            F.array_sort(F.collect_list(F.struct("_last_seq", "step", "_status"))),
            lambda s: F.struct(s["step"].alias("k"), s["_status"].alias("v")))).alias("steps_status"),
        *values,
    ).select(F.lit(pipeline).alias("pipeline"), F.lit(layer.upper()).alias("layer"), "*")
    if score:
        names = {m.name for m in metrics}
        if "input_rows" in names and all(n in names for n in SCORE_ISSUES):
            report = report.withColumn("quality_score_pct", quality_score(
                F.col("input_rows"), [F.col(n) for n in SCORE_ISSUES]))
    return report


def log_from_frames(frames: Sequence[tuple[str, DataFrame]], run_id: str) -> DataFrame:
    """Step-log rows built in-plan from one-row metric frames (JSN1, DT1).

    Each frame's columns become the step's JSON payload; nothing is collected.
    """
    parts = []
    for seq, (step, frame) in enumerate(frames, start=1):
        parts.append(frame.select(
            F.lit(run_id).alias("run_id"), F.lit(seq).cast("long").alias("seq"),
            F.lit(step).alias("step"), F.lit("SUCCESS").alias("status"),
            utc_now_iso().alias("timestamp_utc"),
            payload(**{c: F.col(f"`{c}`") for c in frame.columns}).alias("payload")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionAll(p)
    return out


# Report columns shown with thousands separators / two decimals (FMT1).
FORMATTED = (("input_rows", 0), ("output_rows", 0), ("casting_failures", 0),
             ("duplicates_removed", 0), ("orphaned_fk_rows", 0), ("constraint_violations", 0),
             ("quality_score_pct", 2))


def format_report(report: DataFrame, columns: Sequence[tuple[str, int]] = FORMATTED) -> DataFrame:
    """The report's headline numbers as display strings."""
    return report.select(*[format_metric(F.col(c), d).alias(c) for c, d in columns
                           if c in report.columns])


# JSON-valued metrics re-parsed into nested values for the written document.
_NESTED = {
    "missing_values_details": "map<string, struct<null_count: bigint, null_pct: double>>",
    "violations_by_constraint": "map<string, bigint>",
    "expected_missing": "array<string>",
}


def report_document(report: DataFrame, metrics: Sequence[Metric]) -> DataFrame:
    """The report as a document: run fields plus a nested ``data_quality_metrics``."""
    values = []
    for m in metrics:
        c = F.col(m.name)
        if m.name in _NESTED:
            c = F.from_json(c, _NESTED[m.name])
        values.append(c.alias(m.name))
    if "quality_score_pct" in report.columns:
        values.append(F.col("quality_score_pct"))
    return report.select("pipeline", "layer", "execution_timestamp", "total_steps",
                         "steps_status", F.struct(*values).alias("data_quality_metrics"))
