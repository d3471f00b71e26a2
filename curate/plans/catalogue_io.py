"""Catalogue entries that write and read files: CSV ingestion, archives, saved
tables and the full silver flow (step log -> report -> quality score).

Files go to a fresh folder under the session's shared checkpoint folder.
"""

from __future__ import annotations

import io
import uuid
import zipfile
from dataclasses import replace

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curate.functions.text import basename
from curate.operators.profile import ingest_metrics
from curate.operators.standardise import curate
from curate.operators.dedupe import dedupe
from curate.operators.cleaning import apply_schema, nullify, with_null
from curate.plans import oracle as O
from curate.plans.catalogue import CTES, _SPEC, register
from curate.plans.fixtures import encounters_raw, encounters_spec, mapping_lines
from curate.plans.silver import SilverConfig, run_silver
from curate.plans.sinks import ensure_db, publish_table, roll_back, save_table, table_versions
from curate.session import shared_dir
from curate.sources.archive import expand_archives
from curate.sources.archive_lines import read_archive_lines
from curate.sources.archive_lines import register as register_archive_lines
from curate.sources.csv import divert_corrupt, read_permissive_csv
from curate.sources.tables import load

_ID = O.ident


def write_csv(df: DataFrame, path: str, quote: bool = True) -> None:
    """Header CSV preserving surrounding spaces; ``quote=False`` writes fields verbatim."""
    w = (df.write.option("header", True).option("ignoreLeadingWhiteSpace", False)
         .option("ignoreTrailingWhiteSpace", False))
    if not quote:
        w = w.option("quote", "").option("escapeQuotes", False)
    w.csv(path)


# --------------------------------------------------------------------------
# Permissive CSV with corrupt rows
# --------------------------------------------------------------------------

@register("csv_corrupt_rows", f"""{CTES}
SELECT CAST(count(*) AS BIGINT) AS rows, CAST({len(O.RAW_COLUMNS)} AS INTEGER) AS cols,
       CAST(count_if(encounter_id LIKE '%13') AS BIGINT) AS corrupt_rows FROM raw""")
def csv_corrupt_rows(spark, sf_dir):
    raw = encounters_raw(spark, sf_dir)
    # Rows whose id ends in 13 get a field with an unquoted comma: one field too many.
    dirty = raw.withColumn("race", F.when(F.col("encounter_id").endswith("13"),
                                          F.concat(F.col("race"), F.lit(", extra")))
                           .otherwise(F.col("race")))
    path = shared_dir(spark, "csv")
    write_csv(dirty, path, quote=False)
    return ingest_metrics(read_permissive_csv(spark, path, raw.columns))


# --------------------------------------------------------------------------
# Archives
# --------------------------------------------------------------------------

PAGES_PER_ARCHIVE = 100


def _zip_writer(out_dir: str):
    def write(pdf: pd.DataFrame) -> pd.DataFrame:
        from pyarrow import fs as pafs
        bucket = int(pdf["bucket"].iloc[0])
        buf = io.BytesIO()
        with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as zf:
            zf.writestr("pages/", b"")
            for pid, html in zip(pdf["page_id"], pdf["html"]):
                zf.writestr(f"pages/{int(pid)}.html", (html or "").encode("utf-8"))
        target = f"{out_dir}/pages-{bucket}.zip"
        filesystem, p = pafs.FileSystem.from_uri(target if "://" in target else f"file://{target}")
        filesystem.create_dir(p.rsplit("/", 1)[0], recursive=True)
        with filesystem.open_output_stream(p) as f:
            f.write(buf.getvalue())
        return pd.DataFrame({"bucket": [bucket], "members": [len(pdf)]})
    return write


def write_page_archives(spark: SparkSession, sf_dir: str, out_dir: str) -> int:
    """Write ``pages`` as ZIP archives of at most PAGES_PER_ARCHIVE pages each."""
    pages = load(spark, sf_dir, "pages").select(
        "page_id", "html", F.floor(F.col("page_id") / PAGES_PER_ARCHIVE).cast("long").alias("bucket"))
    done = pages.groupBy("bucket").applyInPandas(_zip_writer(out_dir), "bucket long, members long")
    return done.count()


@register("archive_expand", f"""
SELECT 'pages-' || CAST(page_id // {PAGES_PER_ARCHIVE} AS VARCHAR) || '.zip' AS archive,
       'pages/' || CAST(page_id AS VARCHAR) || '.html' AS member_path,
       CAST(page_id AS VARCHAR) || '.html' AS file_name,
       CAST(strlen(html) AS BIGINT) AS size_bytes, 'text/html' AS type,
       replace(replace(html, chr(13) || chr(10), chr(10)), chr(13), chr(10)) AS text
FROM pages""")
def archive_expand(spark, sf_dir):
    out = shared_dir(spark, "archives")
    write_page_archives(spark, sf_dir, out)
    members = expand_archives(spark, out)
    return members.select(basename("path").alias("archive"), "member_path", "file_name",
                          "size_bytes", "type", "text")


def _page_member_writer(out_dir: str):
    """One archive ``pages.zip`` a folder, every member named ``page.html``."""
    def write(pdf: pd.DataFrame) -> pd.DataFrame:
        from pyarrow import fs as pafs
        bucket = int(pdf["bucket"].iloc[0])
        buf = io.BytesIO()
        with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as zf:
            for pid, html in zip(pdf["page_id"], pdf["html"]):
                zf.writestr(f"pages/{int(pid)}/page.html", (html or "").encode("utf-8"))
        _put(f"{out_dir}/day{bucket}", "pages.zip", buf.getvalue(), pafs)
        return pd.DataFrame({"bucket": [bucket], "members": [len(pdf)]})
    return write


@register("bronze_members", """
SELECT page_id, replace(replace(coalesce(html, ''), chr(13) || chr(10), chr(10)), chr(13), chr(10)) AS text
FROM pages""")
def bronze_members(spark, sf_dir):
    """Extracted files read back row by row: equal archive and member names in many folders."""
    from curate.plans.bronze import BronzeConfig, member_dir, run_bronze
    base = shared_dir(spark, "bronze")
    pages = load(spark, sf_dir, "pages").select(
        "page_id", "html", F.floor(F.col("page_id") / PAGES_PER_ARCHIVE).cast("long").alias("bucket"))
    pages.groupBy("bucket").applyInPandas(_page_member_writer(f"{base}/zips"), "bucket long, members long").count()
    out = run_bronze(spark, BronzeConfig(base_dir=base, archive_path=f"{base}/zips", expected=("page.html",)))
    files = spark.read.text(member_dir(out["extract_dir"], "page.html"), wholetext=True).select(
        basename(F.col("_metadata.file_path")).alias("file"), F.col("value"))
    members = out["manifest"].select(F.split("member_path", "/")[1].cast("long").alias("page_id"),
                                     basename("target_path").alias("file"))
    # an empty file gives no row
    return members.join(files, "file", "left").select("page_id", F.coalesce("value", F.lit("")).alias("text"))


_LINES_SQL = """
SELECT page_id, CAST(i - 1 AS BIGINT) AS line_no, lines[i] AS line FROM (
  SELECT page_id, lines, unnest(range(1, len(lines) + 1)) AS i FROM (
    SELECT page_id, string_split(CASE WHEN t LIKE '%' || chr(10) THEN t[:-2] ELSE t END, chr(10)) AS lines FROM (
      SELECT page_id, replace(replace(coalesce(html, ''), chr(13) || chr(10), chr(10)), chr(13), chr(10)) AS t FROM pages)
    WHERE t <> ''))"""


def _page_zips(spark, sf_dir) -> str:
    base = shared_dir(spark, "lines")
    pages = load(spark, sf_dir, "pages").select(
        "page_id", "html", F.floor(F.col("page_id") / PAGES_PER_ARCHIVE).cast("long").alias("bucket"))
    pages.groupBy("bucket").applyInPandas(_page_member_writer(f"{base}/zips"), "bucket long, members long").count()
    return f"{base}/zips"


def _page_lines(lines: DataFrame) -> DataFrame:
    return lines.select(F.split("member_path", "/")[1].cast("long").alias("page_id"), "line_no", "line")


@register("archive_lines", _LINES_SQL)
def archive_lines(spark, sf_dir):
    """Members of many archives as lines; a member is never one value."""
    return _page_lines(read_archive_lines(spark, _page_zips(spark, sf_dir), ("page.html",)))


@register("archive_lines_source", _LINES_SQL)
def archive_lines_source(spark, sf_dir):
    """The same through the data source, a partition a group of members."""
    register_archive_lines(spark)
    return _page_lines(spark.read.format("archive_lines").option("members", "page.html").load(_page_zips(spark, sf_dir)))


# --------------------------------------------------------------------------
# Saved table round trip
# --------------------------------------------------------------------------

@register("saved_table_roundtrip", f"""{CTES}
SELECT * FROM curated""")
def saved_table_roundtrip(spark, sf_dir):
    raw = encounters_raw(spark, sf_dir)
    spec = encounters_spec(raw)
    typed = apply_schema(nullify(with_null(raw, "_corrupt_record"), spec.sentinel), spec.schema)
    curated = curate(dedupe(typed, spec.key), spec)
    base = shared_dir(spark, "tables")
    db = f"curate_{uuid.uuid4().hex[:10]}"
    ensure_db(spark, db, f"{base}/{db}.db")
    info = save_table(curated, f"{db}.{spec.name}", path=f"{base}/{spec.name}")
    assert info["rows_saved"] >= 0
    return spark.table(f"{db}.{spec.name}")


# --------------------------------------------------------------------------
# Full silver flow: step log -> report -> score
# --------------------------------------------------------------------------

def run_fixture_silver(spark: SparkSession, sf_dir: str) -> dict:
    """Write the encounter extract as CSV, then run the whole silver flow on it."""
    base = shared_dir(spark, "silver")
    raw = encounters_raw(spark, sf_dir)
    csv_dir = f"{base}/raw_extracted/encounters"
    write_csv(raw, csv_dir)
    spec = encounters_spec(raw)
    cfg = SilverConfig(base_dir=base, spec=spec, database=f"curate_{uuid.uuid4().hex[:10]}",
                       pipeline_name="Encounters - Silver Layer ETL")
    return run_silver(spark, cfg, csv_dir, mapping_lines(spark, sf_dir), spec=spec) | {"report_path": cfg.report_path}


REPORT_COLUMNS = ("pipeline", "layer", "total_steps", "step_count", "success_steps", "input_rows",
                  "corrupt_rows", "casting_failures", "duplicates_removed", "columns_with_nulls",
                  "orphaned_fk_rows", "constraint_violations", "output_rows", "quality_score_pct")


def _report_oracle(pipeline: str = "Encounters - Silver Layer ETL", steps: int = 10) -> str:
    ints = [f for f in _SPEC.schema.fields if O.sql_type(f.dataType) in ("INTEGER", "BIGINT")]
    cast_fail = " + ".join(
        f"count_if({_ID(f.name)} IS NOT NULL AND {O.lenient_cast_sql(_ID(f.name), f.dataType)} IS NULL)"
        for f in ints)
    nulls = " + ".join(f"CAST(count_if({_ID(c)} IS NULL) > 0 AS INTEGER)" for c in _SPEC.columns)
    rules = " + ".join(f"count_if({O.rule_sql(r)})" for r in _SPEC.rules)
    return f"""{CTES},
d_type AS (SELECT DISTINCT CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS id FROM orders),
m AS (SELECT
  (SELECT count(*) FROM raw) AS input_rows,
  0 AS corrupt_rows,
  (SELECT {cast_fail} FROM nulled) AS casting_failures,
  (SELECT count(*) FROM typed) - (SELECT count(*) FROM clean) AS duplicates_removed,
  (SELECT {nulls} FROM clean) AS columns_with_nulls,
  (SELECT count_if(admission_type_id IS NOT NULL AND admission_type_id NOT IN (SELECT id FROM d_type))
        + count_if(discharge_disposition_id IS NOT NULL AND discharge_disposition_id NOT IN (SELECT n_nationkey FROM nation))
        + count_if(admission_source_id IS NOT NULL AND admission_source_id NOT IN (SELECT r_regionkey FROM region))
   FROM clean) AS orphaned_fk_rows,
  (SELECT {rules} FROM curated) AS constraint_violations,
  (SELECT count(*) FROM curated) AS output_rows)
SELECT {O.lit(pipeline)} AS pipeline, 'SILVER' AS layer,
       CAST({steps} AS BIGINT) AS total_steps, CAST({steps} AS BIGINT) AS step_count,
       CAST({steps} AS BIGINT) AS success_steps,
       CAST(input_rows AS BIGINT) AS input_rows, CAST(corrupt_rows AS BIGINT) AS corrupt_rows,
       CAST(casting_failures AS BIGINT) AS casting_failures,
       CAST(duplicates_removed AS BIGINT) AS duplicates_removed,
       CAST(columns_with_nulls AS BIGINT) AS columns_with_nulls,
       CAST(orphaned_fk_rows AS BIGINT) AS orphaned_fk_rows,
       CAST(constraint_violations AS BIGINT) AS constraint_violations,
       CAST(output_rows AS BIGINT) AS output_rows,
       {O.half_up_ratio('100 * (input_rows - corrupt_rows - casting_failures - duplicates_removed - orphaned_fk_rows - constraint_violations)', 'input_rows')} AS quality_score_pct
FROM m"""


_REPORT_SQL = _report_oracle()


@register("step_log_report", _REPORT_SQL)
def step_log_report(spark, sf_dir):
    out = run_fixture_silver(spark, sf_dir)
    return out["report"].select(*REPORT_COLUMNS)


@register("quality_score", f"""
SELECT input_rows, corrupt_rows + casting_failures + duplicates_removed + orphaned_fk_rows
       + constraint_violations AS issues, quality_score_pct FROM ({_REPORT_SQL})""")
def quality_score_q(spark, sf_dir):
    report = run_fixture_silver(spark, sf_dir)["report"]
    issues = (F.col("corrupt_rows") + F.col("casting_failures") + F.col("duplicates_removed")
              + F.col("orphaned_fk_rows") + F.col("constraint_violations"))
    return report.select("input_rows", issues.alias("issues"), "quality_score_pct")


# --------------------------------------------------------------------------
# Archives -> bronze -> silver -> report (the whole flow)
# --------------------------------------------------------------------------

ROWS_PER_ARCHIVE = 20_000


def _fact_zip_writer(out_dir: str, columns: list[str], member: str):
    def write(pdf: pd.DataFrame) -> pd.DataFrame:
        from pyarrow import fs as pafs
        bucket = int(pdf["_bucket"].iloc[0])
        text = pdf[columns].to_csv(index=False, lineterminator="\n")
        buf = io.BytesIO()
        with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as zf:
            zf.writestr("extract/", b"")
            zf.writestr(f"extract/{member}", text.encode("utf-8"))
            zf.writestr("extract/notes.txt", b"not an expected member")
        _put(out_dir, f"encounters-{bucket}.zip", buf.getvalue(), pafs)
        return pd.DataFrame({"bucket": [bucket], "rows": [len(pdf)]})
    return write


def _mapping_zip_writer(out_dir: str, member: str):
    def write(pdf: pd.DataFrame) -> pd.DataFrame:
        from pyarrow import fs as pafs
        pdf = pdf.sort_values(["block", "idx"])
        text = "\r\n".join(pdf["line"].tolist()) + "\r\n"
        buf = io.BytesIO()
        with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as zf:
            zf.writestr(f"meta/{member}", text.encode("utf-8"))
        _put(out_dir, "mapping.zip", buf.getvalue(), pafs)
        return pd.DataFrame({"bucket": [-1], "rows": [len(pdf)]})
    return write


def _put(out_dir: str, name: str, data: bytes, pafs) -> None:
    target = f"{out_dir}/{name}"
    filesystem, p = pafs.FileSystem.from_uri(target if "://" in target else f"file://{target}")
    filesystem.create_dir(p.rsplit("/", 1)[0], recursive=True)
    with filesystem.open_output_stream(p) as f:
        f.write(data)


def write_encounter_archives(spark: SparkSession, sf_dir: str, out_dir: str) -> int:
    """Zip the encounter extract (<= ROWS_PER_ARCHIVE rows per archive) and the mapping file."""
    from curate.plans.bronze import EXPECTED_FILES
    raw = encounters_raw(spark, sf_dir)
    n = max(1, -(-raw.count() // ROWS_PER_ARCHIVE))
    cols = raw.columns
    # Salted with a per-row id: identical copies must not all land in one archive.
    bucketed = raw.withColumn("_bucket", F.pmod(
        F.xxhash64(*cols, F.monotonically_increasing_id()), F.lit(n)))
    fact = bucketed.groupBy("_bucket").applyInPandas(
        _fact_zip_writer(out_dir, cols, EXPECTED_FILES[0]), "bucket long, rows long")
    # The mapping file is one file by nature; its size is bounded by the
    # distinct priorities/statuses/segments and the nation and region tables.
    mapping = mapping_lines(spark, sf_dir).groupBy("file").applyInPandas(
        _mapping_zip_writer(out_dir, EXPECTED_FILES[1]), "bucket long, rows long")
    return fact.unionByName(mapping).count()


@register("archive_to_silver", _REPORT_SQL)
def archive_to_silver(spark, sf_dir):
    from curate.plans.run import run_all
    base = shared_dir(spark, "e2e")
    write_encounter_archives(spark, sf_dir, f"{base}/archives")
    raw = encounters_raw(spark, sf_dir)
    out = run_all(spark, base, f"{base}/archives", spec=encounters_spec(raw),
                  database=f"curate_{uuid.uuid4().hex[:10]}", pipeline_prefix="Encounters - ")
    return out["silver"]["report"].select(*REPORT_COLUMNS)


@register("bronze_report", f"""{CTES}
SELECT 'Encounters - Bronze Layer ETL' AS pipeline, 'BRONZE' AS layer, CAST(1 AS BIGINT) AS success_steps,
       CAST(ceil(count(*) / {ROWS_PER_ARCHIVE}.0) AS BIGINT) AS files_extracted,
       CAST(ceil(count(*) / {ROWS_PER_ARCHIVE}.0) AS BIGINT) AS csv_files_found,
       CAST(count(*) AS BIGINT) AS total_rows, '[]' AS expected_missing FROM raw""")
def bronze_report(spark, sf_dir):
    from curate.plans.bronze import EXPECTED_FILES, BronzeConfig, run_bronze
    base = shared_dir(spark, "bronze")
    write_encounter_archives(spark, sf_dir, f"{base}/archives")
    out = run_bronze(spark, BronzeConfig(base_dir=base, archive_path=f"{base}/archives", expected=EXPECTED_FILES[:1],
                                         pipeline_name="Encounters - Bronze Layer ETL"))
    return out["report"].select("pipeline", "layer", "success_steps", "files_extracted", "csv_files_found",
                                "total_rows", "expected_missing")


# --------------------------------------------------------------------------
# Bad records (SNK7)
# --------------------------------------------------------------------------

@register("bad_records", f"""{CTES}
SELECT count(*) AS bad_rows, count(DISTINCT encounter_id) AS bad_ids
FROM raw WHERE encounter_id LIKE '%13'""")
def bad_records(spark, sf_dir):
    """The fact flow diverts corrupt lines to the bad-record folder; what it wrote is read back."""
    from curate.plans.silver import fact_plan
    base = shared_dir(spark, "bad")
    raw = encounters_raw(spark, sf_dir)
    dirty = raw.withColumn("race", F.when(F.col("encounter_id").endswith("13"),
                                          F.concat(F.col("race"), F.lit(", extra")))
                           .otherwise(F.col("race")))
    write_csv(dirty, f"{base}/csv", quote=False)
    spec = encounters_spec(raw)
    spec = replace(spec, fks=())
    cfg = SilverConfig(base_dir=base, spec=spec, on_corrupt="divert")
    fact_plan(spark, f"{base}/csv", cfg, {}, spec)        # the sink is written while the plan is built
    first = raw.columns.index("encounter_id")
    return spark.read.text(cfg.bad_records_dir).agg(
        F.count(F.lit(1)).alias("bad_rows"),
        F.count_distinct(F.split("value", ",")[first]).alias("bad_ids"))


@register("bad_records_origin", f"""{CTES}
SELECT CAST(count(*) AS BIGINT) AS input_rows, CAST(count_if(encounter_id LIKE '%13') AS BIGINT) AS bad_rows,
       CAST(count_if(encounter_id LIKE '%13') AS BIGINT) AS with_origin,
       CAST(count_if(encounter_id NOT LIKE '%13') AS BIGINT) AS good_rows FROM raw""")
def bad_records_origin(spark, sf_dir):
    """Good and bad lines parted in one read of the input, the bad ones with file and block."""
    base = shared_dir(spark, "split")
    raw = encounters_raw(spark, sf_dir)
    dirty = raw.withColumn("race", F.when(F.col("encounter_id").endswith("13"), F.concat(F.col("race"), F.lit(", extra")))
                           .otherwise(F.col("race")))
    write_csv(dirty, f"{base}/csv", quote=False)
    good, n_bad = divert_corrupt(read_permissive_csv(spark, f"{base}/csv", raw.columns), f"{base}/staged", f"{base}/bad")
    told = F.col("file").endswith(".csv") & (F.col("block") >= 0) & (F.length("record") > 0)
    rows = good.select(F.lit(0).alias("bad"), F.lit(0).alias("told")).unionAll(
        spark.read.parquet(f"{base}/bad_origin").select(F.lit(1), told.cast("int")))
    return rows.agg(F.count(F.lit(1)).alias("input_rows"), F.lit(n_bad).cast("long").alias("bad_rows"),
                    F.sum("told").alias("with_origin"), F.count_if(F.col("bad") == 0).alias("good_rows"))


# --------------------------------------------------------------------------
# Published tables, the written report, the compacted log, a resumed run
# --------------------------------------------------------------------------

@register("published_versions", """
SELECT 'published' AS state, CAST(count(*) AS BIGINT) AS rows, CAST(sum(c_custkey) AS BIGINT) AS keys FROM customer WHERE c_acctbal > 0
UNION ALL SELECT 'after failure', CAST(count(*) AS BIGINT), CAST(sum(c_custkey) AS BIGINT) FROM customer WHERE c_acctbal > 0
UNION ALL SELECT 'rolled back', CAST(count(*) AS BIGINT), CAST(sum(c_custkey) AS BIGINT) FROM customer""")
def published_versions(spark, sf_dir):
    """A table published twice, a third time by a job that fails on the way, then rolled back."""
    base, db = shared_dir(spark, "publish"), f"curate_{uuid.uuid4().hex[:10]}"
    ensure_db(spark, db, f"{base}/{db}.db")
    name, customers = f"{db}.customer", load(spark, sf_dir, "customer")
    states = []

    def note(state):
        # the files of the moment, as later versions change what the name stands for
        spark.catalog.refreshTable(name)
        states.append(spark.read.parquet(table_versions(spark, name)[0]).agg(F.count(F.lit(1)).alias("rows"), F.sum("c_custkey").alias("keys"))
                      .select(F.lit(state).alias("state"), "rows", "keys"))

    publish_table(customers, name, f"{base}/customer")
    publish_table(customers.where("c_acctbal > 0"), name, f"{base}/customer")
    note("published")
    broken = customers.withColumn("c_custkey", F.when(F.col("c_custkey") % 100 == 7, F.raise_error(F.lit("stop")).cast("long")).otherwise(F.col("c_custkey")))
    try:
        publish_table(broken, name, f"{base}/customer")
    except Exception as e:
        if "stop" not in str(e):
            raise
    note("after failure")
    roll_back(spark, name)
    note("rolled back")
    return states[0].unionAll(states[1]).unionAll(states[2])


_DOCUMENT = ("pipeline", "layer", "total_steps", "input_rows", "duplicates_removed", "columns_with_nulls", "output_rows", "quality_score_pct")


@register("report_document", f"""
WITH r AS ({_REPORT_SQL})
SELECT {", ".join(_DOCUMENT)}, CAST(10 AS BIGINT) AS steps_succeeded, true AS timestamp_is_utc_iso,
       constraint_violations AS violations_of_rules, columns_with_nulls AS columns_in_details FROM r""")
def report_document_q(spark, sf_dir):
    """The report as the run wrote it: status of every step, time stamp, nested metrics."""
    out = run_fixture_silver(spark, sf_dir)
    schema = ("pipeline string, layer string, execution_timestamp string, total_steps long, steps_status map<string, string>, "
              "data_quality_metrics struct<input_rows: long, duplicates_removed: long, columns_with_nulls: long, output_rows: long, quality_score_pct: double, "
              "missing_values_details: map<string, struct<null_count: long, null_pct: double>>, violations_by_constraint: map<string, long>>")
    doc = spark.read.schema(schema).json(out["report_path"]).select("*", "data_quality_metrics.*")
    return doc.select(
        *_DOCUMENT, F.size(F.map_filter("steps_status", lambda k, v: v == "SUCCESS")).cast("long").alias("steps_succeeded"),
        F.col("execution_timestamp").rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d(\.\d+)?Z$").alias("timestamp_is_utc_iso"),
        F.aggregate(F.map_values("violations_by_constraint"), F.lit(0).cast("long"), lambda a, b: a + b).alias("violations_of_rules"),
        F.size("missing_values_details").cast("long").alias("columns_in_details"))


@register("log_compaction_report", _REPORT_SQL)
def log_compaction_report(spark, sf_dir):
    """The report from the compacted log, beside an unfinished run that stays in its text files."""
    from curate.plans import silver as S
    from curate.plans.report import build_report
    from curate.plans.steplog import StepLog, compact_log
    from curate.sources.steplog import read_step_log
    out = run_fixture_silver(spark, sf_dir)
    log_dir, run_id = out["log"].log_dir, out["run_id"]
    StepLog(spark, log_dir).write(S.STEP_DIMS, "SUCCESS", {})
    for _ in range(2):                                                   # again: nothing changes
        assert compact_log(spark, log_dir, f"{log_dir}_compacted", (S.STEP_SUMMARY,)) == [run_id]
    log = read_step_log(spark, log_dir, run_id, compacted=f"{log_dir}_compacted")
    return build_report(log, "Encounters - Silver Layer ETL", "silver").select(*REPORT_COLUMNS)


@register("resumed_run_report", f"""
SELECT * EXCLUDE (total_steps), CAST(1 AS BIGINT) AS steps_skipped, CAST(1 AS BIGINT) AS failed_records FROM ({_REPORT_SQL})""")
def resumed_run_report(spark, sf_dir):
    """A run whose fact step fails, resumed under its id: the dimensions are not built again."""
    from curate.plans import silver as S
    from curate.sources.steplog import read_step_log
    base, raw = shared_dir(spark, "resume"), encounters_raw(spark, sf_dir)
    write_csv(raw, f"{base}/csv")
    spec = encounters_spec(raw)
    mapping_lines(spark, sf_dir).select("file", "block", "idx", "line").write.parquet(f"{base}/mapping")
    lines = spark.read.parquet(f"{base}/mapping")
    cfg = SilverConfig(base_dir=base, spec=spec, database=f"curate_{uuid.uuid4().hex[:10]}", pipeline_name="Encounters - Silver Layer ETL")
    broken = replace(spec, schema=encounters_spec(raw).schema, key=("no_such_column",))
    try:
        run_silver(spark, cfg, f"{base}/csv", lines, spec=broken, run_id="r1", resume=True)
    except Exception as e:
        if "no_such_column" not in str(e):
            raise
    out = run_silver(spark, cfg, f"{base}/csv", lines, spec=spec, run_id="r1", resume=True)
    failed = read_step_log(spark, cfg.log_dir, "r1").where("status = 'FAILED'").count()
    assert out["skipped"] == [S.STEP_DIMS]
    return out["report"].select(*[c for c in REPORT_COLUMNS if c != "total_steps"],
                                F.lit(len(out["skipped"])).cast("long").alias("steps_skipped"), F.lit(failed).cast("long").alias("failed_records"))


# --------------------------------------------------------------------------
# Incremental (streaming) curation
# --------------------------------------------------------------------------

@register("stream_curated_rows", f"""{O.encounter_ctes(_SPEC, dedupe=False)}
SELECT * FROM curated""")
def stream_curated_rows(spark, sf_dir):
    from curate.streaming.incremental import read_curated, start_curation
    base = shared_dir(spark, "stream")
    raw = encounters_raw(spark, sf_dir)
    write_csv(raw, f"{base}/landing")
    spec = encounters_spec(raw)
    query, _ = start_curation(spark, f"{base}/landing", spec, f"{base}/out",
                              f"{base}/_checkpoint", f"{base}/_logs", names=raw.columns,
                              max_files_per_trigger=2)
    query.awaitTermination()
    return read_curated(spark, f"{base}/out").drop("epoch")


# --------------------------------------------------------------------------
# Report from in-plan metric frames (no files, no collect) and its display form
# --------------------------------------------------------------------------

_FRAMES_PIPELINE = "Encounters - metric frames"


def metric_frames_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log rows derived in-plan from the operators' metric frames, folded into a report."""
    from curate.operators.cleaning import cast_profile
    from curate.operators.dedupe import dedupe_stats
    from curate.operators.integrity import fk_check
    from curate.operators.profile import null_profile
    from curate.operators.rules import check_rules
    from curate.plans import silver as S
    from curate.plans.catalogue import _fk_inputs
    from curate.plans.report import build_report, log_from_frames
    raw = encounters_raw(spark, sf_dir)
    spec = encounters_spec(raw)
    nulled = nullify(with_null(raw, "_corrupt_record"), spec.sentinel)
    typed = apply_schema(nulled, spec.schema)
    clean, fks = _fk_inputs(spark, sf_dir)
    curated = curate(clean, spec)
    frames = [
        (S.STEP_LOAD, ingest_metrics(with_null(raw, "_corrupt_record"))),
        (S.STEP_SCHEMA, cast_profile(nulled, spec.schema).agg(
            F.coalesce(F.sum("failed_rows"), F.lit(0)).cast("long").alias("casting_failures_total"),
            F.count(F.lit(1)).alias("columns_with_failures"))),
        (S.STEP_DUPES, dedupe_stats(typed, spec.key)),
        (S.STEP_NULLS, null_profile(clean).agg(F.count(F.lit(1)).alias("columns_with_nulls"))),
        (S.STEP_FK, fk_check(clean, fks).agg(
            F.sum("orphaned_fact_rows").cast("long").alias("total_orphaned_rows"))),
        (S.STEP_RULES, check_rules(curated, spec.rules).agg(
            F.sum("violations").cast("long").alias("total_violations"))),
        (S.STEP_SAVE, curated.agg(F.count(F.lit(1)).alias("rows_saved"))),
    ]
    log = log_from_frames(frames, run_id=uuid.uuid4().hex)
    return build_report(log, _FRAMES_PIPELINE, "silver")


@register("metric_frames_report", _report_oracle(_FRAMES_PIPELINE, 7))
def metric_frames_report_q(spark, sf_dir):
    return metric_frames_report(spark, sf_dir).select(*REPORT_COLUMNS)


@register("formatted_report", f"""
SELECT format('{{:,}}', input_rows) AS input_rows, format('{{:,}}', output_rows) AS output_rows,
       format('{{:,}}', casting_failures) AS casting_failures,
       format('{{:,}}', duplicates_removed) AS duplicates_removed,
       format('{{:,}}', orphaned_fk_rows) AS orphaned_fk_rows,
       format('{{:,}}', constraint_violations) AS constraint_violations,
       format('{{:,.2f}}', quality_score_pct) AS quality_score_pct
FROM ({_report_oracle(_FRAMES_PIPELINE, 7)})""")
def formatted_report(spark, sf_dir):
    from curate.plans.report import format_report
    return format_report(metric_frames_report(spark, sf_dir))
