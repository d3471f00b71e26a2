"""Silver curation flow (PIPE1-PIPE4).

``build_dims``    sectioned mapping file -> dimension tables (+ key stats)
``curate_fact``   raw CSV -> curated fact table in ONE pass over the input
``run_summaries`` the three summaries over the saved fact table
``run_silver``    all of the above, step log and quality report

Single-pass fact curation.  Row-level metrics that precede de-duplication
(input rows, corrupt rows, cast failures) are carried through the dedupe
shuffle as per-key sums; null, foreign-key and rule metrics are collected by
``Observation``s attached *after* the last shuffle, so they are computed by
the write job's result tasks, whose metric updates Spark applies once per
partition even when tasks or executors are retried.  A flow that runs one
action per metric needs ~119 passes over the fact; this one reads it once to
write the table, then the summaries read the saved (columnar, pruned) table.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curate.functions.casting import lenient_cast
from curate.operators.cleaning import cast_failure_predicates, nullify, q, schema_matches, with_null
from curate.operators.dedupe import COUNT, dedupe_grouped
from curate.operators.integrity import (DEFAULT_BROADCAST_MAX_IDS, flag_fks,
                                       orphan_count_preaggregated, orphan_predicate)
from curate.operators.profile import key_stats
from curate.operators.standardise import curate
from curate.operators.summary import grouped_mean, share_of_group, summary_counts, top_k
from curate.plans.report import SILVER_METRICS, build_report, report_document
from curate.plans.sinks import ensure_db, publish_table, write_report
from curate.plans.steplog import FAILED, FINGERPRINT, SUCCESS, StepLog
from curate.sources.csv import divert_corrupt, read_permissive_csv
from curate.sources.lines import (header_widths, route_sections, section_headers,
                                  section_to_dim, split_sections)
from curate.sources.steplog import read_step_log
from curate.spec import DIMENSIONS, ENCOUNTERS, DimSpec, FactSpec

# Step names of the silver log.
STEP_DIMS = "silver_dim__create_dimensions"
STEP_LOAD = "silver_fact_ingest__load_csv"
STEP_SCHEMA = "silver_fact_ingest__hard_schema_exact"
STEP_DUPES = "silver_validation__duplicates"
STEP_NULLS = "silver_validation__missing_values"
STEP_FK = "silver_validation__referential_integrity"
STEP_TRANSFORM = "silver_transformation__feature_engineering"
STEP_RULES = "silver_validation__business_constraints"
STEP_SAVE = "silver_fact_save"
STEP_SUMMARY = "silver_analytics__healthcare_summary"


@dataclass(frozen=True)
class SilverConfig:
    base_dir: str
    spec: FactSpec = ENCOUNTERS
    dims: tuple[DimSpec, ...] = DIMENSIONS
    database: str = "silver"
    fmt: str = "parquet"
    on_corrupt: str = "keep"           # "keep" corrupt rows in the flow or "divert" them
    corrupt_col: str = "_corrupt_record"
    broadcast_max_ids: int = DEFAULT_BROADCAST_MAX_IDS
    # Partitions for raw input that can't be split (one gzip file): a shuffle of the raw
    # rows, so only on request.
    repartition_raw: int | None = None
    pipeline_name: str = "Silver Layer ETL"

    @property
    def log_dir(self) -> str:
        return f"{self.base_dir}/_logs"

    @property
    def bad_records_dir(self) -> str:
        return f"{self.base_dir}/_bad_records"

    @property
    def tables_dir(self) -> str:
        return f"{self.base_dir}/tables"

    @property
    def report_path(self) -> str:
        return f"{self.base_dir}/data_quality_report"

    def table(self, name: str) -> str:
        return f"{self.database}.{name}"


def pct_half_up(n: int, total: int) -> float | None:
    """Driver-side twin of :func:`curate.functions.pct` for small log payloads."""
    if not total:
        return None
    return ((20000 * n + total) // (2 * total)) / 100


# --------------------------------------------------------------------------
# PIPE1: dimensions
# --------------------------------------------------------------------------

def build_dims(spark: SparkSession, lines: DataFrame, cfg: SilverConfig,
               log: StepLog, fingerprint: str | None = None) -> dict[str, DataFrame]:
    """Parse, validate and save every dimension section of a mapping file."""
    with log.step(STEP_DIMS) as payload:
        if fingerprint:
            payload[FINGERPRINT] = fingerprint
        ensure_db(spark, cfg.database, f"{cfg.tables_dir}/{cfg.database}.db")
        # Parsed once, reused by every dimension (lost blocks are recomputed).
        sections = split_sections(lines).persist(StorageLevel.MEMORY_AND_DISK)
        routed = route_sections(section_headers(sections), cfg.dims).persist(
            StorageLevel.MEMORY_AND_DISK)
        per_dim = header_widths(routed, cfg.dims)          # at most one row per dimension
        present = {d for d in per_dim if d is not None}
        dims = {}
        for d in cfg.dims:
            if d.table not in present:
                continue
            name = cfg.table(d.table)
            n, width = per_dim[d.table]
            publish_table(section_to_dim(sections, routed, d, n_sections=n, width=width), name,
                          f"{cfg.tables_dir}/{d.table}", cfg.fmt)
            dims[d.table] = spark.table(name)
        validation = dim_key_stats(dims, {d.table: d.id_col for d in cfg.dims})
        payload.update(sections_parsed=sum(n for n, _ in per_dim.values()),
                       validation=validation)
        routed.unpersist()
        sections.unpersist()
    return dims


def dim_key_stats(dims: dict[str, DataFrame], id_cols: dict[str, str]) -> dict[str, dict]:
    """``{table: {rows, distinct_ids, duplicates}}`` for all saved dimensions in one job."""
    if not dims:
        return {}
    parts = [key_stats(df, id_cols[t]).select(F.lit(t).alias("table"), "*")
             for t, df in dims.items()]
    union = parts[0]
    for p in parts[1:]:
        union = union.unionAll(p)
    return {r["table"]: {"rows": int(r["rows"]), "distinct_ids": int(r["distinct_ids"]),
                         "duplicates": int(r["duplicates"])} for r in union.collect()}


# --------------------------------------------------------------------------
# PIPE2: the fact, in one pass
# --------------------------------------------------------------------------

def _sum0(v) -> int:
    return int(v or 0)


def fk_inputs_of(spec: FactSpec, dims: dict[str, DataFrame]) -> list[tuple[str, DataFrame, str]]:
    """``(fk, dimension, id column)`` for the spec's foreign keys; a dimension must exist
    unless the key is optional."""
    missing = [k.dim_table for k in spec.fks if k.dim_table not in dims and not k.optional]
    if missing:
        raise ValueError(f"no dimension table for the foreign keys: {', '.join(missing)}")
    return [(k.fk, dims[k.dim_table], k.dim_id) for k in spec.fks if k.dim_table in dims]


@dataclass
class FactPlan:
    """The single-pass fact query and the handles needed to read its metrics."""

    observed: DataFrame            # curated rows, with both observations attached
    obs_clean: Observation
    obs_rules: Observation
    raw_cols: list[str]
    fails: list
    hits: list[tuple[str, str]]
    sizes: dict[str, int]
    schema_exact: bool
    diverted: int | None
    clean: DataFrame               # typed, de-duplicated rows, not yet standardised
    large_fks: list                # (fk, ids) above the broadcast bound: counted after the write


def fact_plan(spark: SparkSession, source: str | DataFrame, cfg: SilverConfig,
              dims: dict[str, DataFrame], spec: FactSpec,
              persisted: list[DataFrame] | None = None,
              at: Callable[[str], None] = lambda step: None) -> FactPlan:
    """Build (without running) the one-pass query from raw input to curated rows.

    Cached id sets are appended to ``persisted`` for release after the write;
    ``at`` is told each step as its part is built.
    """
    corrupt = cfg.corrupt_col
    at(STEP_LOAD)
    if isinstance(source, str):
        raw = read_permissive_csv(spark, source, corrupt_col=corrupt)
    else:
        raw = with_null(source, corrupt)
    if cfg.repartition_raw and cfg.on_corrupt != "divert":
        raw = raw.repartition(cfg.repartition_raw)
    raw_cols = [c for c in raw.columns if c != corrupt]
    diverted = None
    if cfg.on_corrupt == "divert":
        raw, diverted = divert_corrupt(raw, f"{cfg.bad_records_dir}_staged_{uuid.uuid4().hex[:12]}",
                                       cfg.bad_records_dir, corrupt, isinstance(source, str))
        if cfg.repartition_raw:
            raw = raw.repartition(cfg.repartition_raw)

    # -- typed rows + per-row metric flags ------------------------------------
    # the corrupt column stays as it is: a malformed line may read like the sentinel
    at(STEP_SCHEMA)
    nulled = nullify(raw, spec.sentinel, raw_cols)
    fails = [f for f, _ in cast_failure_predicates(spec.schema)]
    flag_cols = [f"_cf{i}" for i in range(len(fails))] + ["_corrupt_n"]
    # two projections: a cast value is computed once and read by its failure flag
    cast = nulled.select(
        *[lenient_cast(q(f.name), f.dataType).alias(f.name) for f in spec.schema.fields],
        *[q(f.name).isNotNull().alias(f"_given{i}") for i, f in enumerate(fails)],
        q(corrupt).isNotNull().cast("long").alias("_corrupt_n"))
    typed = cast.select(
        *[q(c) for c in spec.columns],
        *[(F.col(f"_given{i}") & q(f.name).isNull()).cast("long").alias(f"_cf{i}")
          for i, f in enumerate(fails)],
        "_corrupt_n")
    schema_exact = schema_matches(typed.select(*[q(c) for c in spec.columns]), spec.schema)

    # -- dedupe (the only fact shuffle) carrying the flags --------------------
    at(STEP_DUPES)
    deduped = dedupe_grouped(typed, spec.key, carry=flag_cols)

    # -- foreign keys: size-checked broadcast joins, same stage ---------------
    at(STEP_FK)
    fk_inputs = fk_inputs_of(spec, dims)
    large: list[tuple[str, DataFrame]] = []
    flagged, hits, sizes = flag_fks(deduped, fk_inputs, cfg.broadcast_max_ids, persisted, large)

    # -- observed metrics on the clean (deduped, typed) rows ------------------
    at(STEP_NULLS)
    obs_clean = Observation("clean")
    clean_aggs = [F.count(F.lit(1)).alias("rows_after"), F.sum(COUNT).alias("rows_before"),
                  F.sum("_corrupt_n").alias("corrupt_rows")]
    clean_aggs += [F.sum(f"_cf{i}").alias(f"cf{i}") for i in range(len(fails))]
    clean_aggs += [F.count_if(q(c).isNull()).alias(f"null{i}") for i, c in enumerate(spec.columns)]
    clean_aggs += [F.count_if(orphan_predicate(fk, hit)).alias(f"fk{i}")
                   for i, (fk, hit) in enumerate(hits)]
    clean = flagged.observe(obs_clean, *clean_aggs).select(*[q(c) for c in spec.columns])

    # -- standardise + observed rule violations -------------------------------
    at(STEP_TRANSFORM)
    curated = curate(clean, spec)
    at(STEP_RULES)
    obs_rules = Observation("rules")
    rule_aggs = [F.count_if(r.violated()).alias(f"r{i}") for i, r in enumerate(spec.rules)]
    observed = curated.observe(obs_rules, F.count(F.lit(1)).alias("rows"), *rule_aggs)
    return FactPlan(observed, obs_clean, obs_rules, raw_cols, fails, hits, sizes, schema_exact,
                    diverted, deduped, large)


def _rewritten(spec: FactSpec) -> set[str]:
    """Columns whose saved value may differ from the typed one (strings are trimmed)."""
    return ({f.name for f in spec.schema.fields if isinstance(f.dataType, T.StringType)}
            | {s.column for s in spec.standardise} | {d.name for d in spec.derived})


def curate_fact(spark: SparkSession, source: str | DataFrame, cfg: SilverConfig,
                log: StepLog, dims: dict[str, DataFrame],
                spec: FactSpec | None = None,
                fingerprint: str | None = None) -> tuple[DataFrame, dict]:
    """Load, profile, type, dedupe, check, standardise and save the fact.

    Returns ``(saved table, metrics)``; every step gets one log record.  A
    failure is logged under the step that was being built; one of the single
    job that runs them all, under the save step.
    """
    spec = spec or cfg.spec
    input_desc = source if isinstance(source, str) else "<dataframe>"
    steps, persisted = [STEP_LOAD], []
    try:
        return _curate_fact(spark, source, cfg, log, dims, spec, input_desc, persisted, steps.append,
                            fingerprint)
    except Exception as e:
        log.write(steps[-1], FAILED, {"input_csv": input_desc,
                                      "bad_records_dir": cfg.bad_records_dir, "error": str(e)})
        raise
    finally:
        for cached in persisted:
            cached.unpersist()


def _curate_fact(spark: SparkSession, source: str | DataFrame, cfg: SilverConfig, log: StepLog,
                 dims: dict[str, DataFrame], spec: FactSpec, input_desc: str,
                 persisted: list[DataFrame], at: Callable[[str], None],
                 fingerprint: str | None = None) -> tuple[DataFrame, dict]:
    corrupt = cfg.corrupt_col
    plan = fact_plan(spark, source, cfg, dims, spec, persisted, at)
    at(STEP_SAVE)
    table = cfg.table(spec.name)
    ensure_db(spark, cfg.database, f"{cfg.tables_dir}/{cfg.database}.db")
    saved_info = publish_table(plan.observed, table, f"{cfg.tables_dir}/{spec.name}", cfg.fmt)
    m1, m2 = plan.obs_clean.get, plan.obs_rules.get
    # Keys whose dimension is too large to broadcast are counted pre-aggregated per key
    # value: on the saved (columnar) table, or on the typed rows where saving changes the key.
    at(STEP_FK)
    rewritten = _rewritten(spec)
    large_orphans = {
        fk: int(orphan_count_preaggregated(plan.clean if fk in rewritten else spark.table(table),
                                           fk, ids).first()["orphaned_fact_rows"])
        for fk, ids in plan.large_fks}
    at(STEP_SAVE)
    raw_cols, fails, hits, sizes = plan.raw_cols, plan.fails, plan.hits, plan.sizes
    schema_exact, diverted = plan.schema_exact, plan.diverted

    # -- one log record per logical step, from the observed metrics ----------
    entries: list[tuple[str, str, dict]] = []
    rows_before, rows_after = _sum0(m1["rows_before"]), _sum0(m1["rows_after"])
    corrupt_rows = _sum0(m1["corrupt_rows"]) + (diverted or 0)
    input_rows = rows_before + (diverted or 0)
    entries.append((STEP_LOAD, SUCCESS, {
        "input_csv": input_desc, "rows": input_rows, "cols": len(raw_cols),
        "corrupt_rows": corrupt_rows, "bad_records_dir": cfg.bad_records_dir,
        "columns": raw_cols + [corrupt]}))

    failures = {}
    for i, f in enumerate(fails):
        n = _sum0(m1[f"cf{i}"])
        if n > 0:
            failures[f.name] = {"failed_rows": n, "target_type": f.dataType.simpleString(),
                                "failure_rate_pct": pct_half_up(n, rows_before)}
    cast_total = sum(v["failed_rows"] for v in failures.values())
    entries.append((STEP_SCHEMA, SUCCESS, {
        "total_rows": rows_before, "columns": len(spec.columns), "schema_exact_match": schema_exact,
        "casting_failures_total": cast_total, "casting_failures_by_column": failures,
        "columns_with_failures": len(failures)}))

    entries.append((STEP_DUPES, SUCCESS, {
        "rows_before": rows_before, "rows_after": rows_after,
        "duplicates_removed": rows_before - rows_after}))

    missing = {}
    for i, c in enumerate(spec.columns):
        n = _sum0(m1[f"null{i}"])
        if n > 0:
            missing[c] = {"null_count": n, "null_pct": pct_half_up(n, rows_after)}
    entries.append((STEP_NULLS, SUCCESS, {
        "total_rows": rows_after, "columns_with_nulls": len(missing),
        "missing_values": missing}))

    orphan_rows = {fk: _sum0(m1[f"fk{i}"]) for i, (fk, _) in enumerate(hits)}
    orphan_rows.update(large_orphans)
    fk_validation = {fk: {"valid_dim_values": sizes[fk], "orphaned_fact_rows": orphan_rows[fk]}
                     for fk, _, _ in fk_inputs_of(spec, dims)}
    entries.append((STEP_FK, SUCCESS, {
        "total_orphaned_rows": sum(v["orphaned_fact_rows"] for v in fk_validation.values()),
        "fk_validation": fk_validation}))

    string_cols = [f.name for f in spec.schema.fields if isinstance(f.dataType, T.StringType)]
    entries.append((STEP_TRANSFORM, SUCCESS, {
        "rows": _sum0(m2["rows"]), "string_cols_trimmed": len(string_cols),
        "categorical_cols_standardized": len([s for s in spec.standardise if s.kind != "strip"]),
        "new_columns": [d.name for d in spec.derived],
        "standardized_columns": [s.column for s in spec.standardise if s.kind == "strip"]}))

    violations = {}
    for i, r in enumerate(spec.rules):
        n = _sum0(m2[f"r{i}"])
        if r.report_zero or n > 0:
            violations[r.name] = n
    entries.append((STEP_RULES, SUCCESS, {
        "total_violations": sum(violations.values()),
        "violations_by_constraint": violations}))

    entries.append((STEP_SAVE, SUCCESS, saved_info | ({FINGERPRINT: fingerprint} if fingerprint else {})))
    log.write_many(entries)
    metrics = {"input_rows": input_rows, "corrupt_rows": corrupt_rows, "rows_after": rows_after,
               "casting_failures": failures, "missing_values": missing,
               "fk_validation": fk_validation, "violations": violations, "saved": saved_info}
    return spark.table(table), metrics


# --------------------------------------------------------------------------
# PIPE3: summaries
# --------------------------------------------------------------------------

def group_summary(curated: DataFrame, spec: FactSpec) -> dict[str, DataFrame]:
    """The three summaries; one whose columns the table lacks is left out."""
    s, have = spec.summary, set(curated.columns)
    out = {}
    if {s.share_group, s.share_by} <= have:
        out["readmission_by_age_count"] = share_of_group(curated, s.share_group, s.share_by)
    if {s.top_key, s.top_distinct} <= have:
        out["top_diagnoses_count"] = top_k(curated, s.top_key, s.top_distinct, s.top_k)
    if set(s.mean_by) | {s.mean_value, s.mean_distinct} <= have:
        out["demographic_groups"] = grouped_mean(curated, list(s.mean_by), s.mean_value,
                                                 s.mean_distinct)
    return out


def run_summaries(curated: DataFrame, spec: FactSpec, log: StepLog) -> dict[str, DataFrame]:
    with log.step(STEP_SUMMARY) as payload:
        summaries = group_summary(curated, spec)
        if summaries:
            counts = summary_counts(summaries).collect()   # three small numbers
            payload.update({r["summary"]: int(r["row_count"]) for r in counts})
    return summaries


# --------------------------------------------------------------------------
# PIPE4 + driver
# --------------------------------------------------------------------------

def silver_report(spark: SparkSession, cfg: SilverConfig, run_id: str) -> DataFrame:
    log = read_step_log(spark, cfg.log_dir, run_id, require=True)
    return build_report(log, cfg.pipeline_name, "silver")


def input_fingerprint(spark: SparkSession, source: str | DataFrame) -> str:
    """A digest of the files behind an input: their names, sizes and times (their bytes are not read).

    A frame that reads no files is told by its plan.
    """
    paths = [source] if isinstance(source, str) else source.inputFiles()
    if not paths:
        return f"plan-{source.semanticHash()}"
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths)
             .select(F.xxhash64("path", "length", "modificationTime").alias("h"), "length"))
    r = files.agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("bytes"), F.bit_xor("h").alias("h")).first()
    return f"files-{r['n']}-{r['bytes'] or 0}-{r['h'] or 0}"


def run_silver(spark: SparkSession, cfg: SilverConfig, fact_source: str | DataFrame,
               mapping_lines: DataFrame, spec: FactSpec | None = None,
               run_id: str | None = None, write: bool = True, resume: bool = False) -> dict:
    """Dimensions, fact, summaries, report.  Returns the produced frames and metrics.

    With ``resume``, steps of ``run_id`` that were committed on the same input are not run again:
    their tables are read as they were saved, and their records stay in the log, so the
    report of a run that failed half-way and was resumed has the metrics of one that did not fail.
    Steps whose input has changed since, and all steps after a failed one, run.
    """
    log = StepLog(spark, cfg.log_dir, run_id)
    spec = spec or cfg.spec
    marks = ({k: input_fingerprint(spark, x) for k, x in ((STEP_DIMS, mapping_lines), (STEP_SAVE, fact_source))}
             if resume else {})
    skipped = []
    dims = None
    if resume and log.committed(STEP_DIMS, marks[STEP_DIMS]):
        dims = {d.table: spark.table(cfg.table(d.table)) for d in cfg.dims
                if spark.catalog.tableExists(cfg.table(d.table))}
        skipped.append(STEP_DIMS)
    else:
        dims = build_dims(spark, mapping_lines, cfg, log, marks.get(STEP_DIMS))
    saved = log.committed(STEP_SAVE, marks[STEP_SAVE]) if resume and skipped else None
    if saved and spark.catalog.tableExists(cfg.table(spec.name)):
        fact, metrics = spark.table(cfg.table(spec.name)), {"saved": saved}
        skipped.append(STEP_SAVE)
    else:
        fact, metrics = curate_fact(spark, fact_source, cfg, log, dims, spec, marks.get(STEP_SAVE))
    summaries = run_summaries(fact, spec, log)
    report = silver_report(spark, cfg, log.run_id)
    if write:
        write_report(report_document(report, SILVER_METRICS), cfg.report_path)
    return {"run_id": log.run_id, "dims": dims, "fact": fact, "metrics": metrics,
            "summaries": summaries, "report": report, "log": log, "skipped": skipped}
