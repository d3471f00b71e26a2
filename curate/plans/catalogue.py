"""Query catalogue: one Spark query per operator, each with an independent SQL oracle.

Every query reads the driver's tables (or data Spark derives from them) in
full; ``QUERIES[name](spark, sf_dir)`` returns a DataFrame and
``ORACLE[name]`` is the DuckDB SQL expected to return the same rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curate.functions.casting import lenient_cast
from curate.functions.jsonfmt import utc_iso
from curate.functions.text import basename
from curate.operators.cleaning import apply_schema, cast_profile, cols_of, nullify, q, with_null
from curate.operators.dedupe import dedupe, dedupe_stats
from curate.operators.idsets import (distinct_counts, distinct_partials, fk_check_bitmaps, merge_partials,
                                     orphans_bitmaps)
from curate.operators.integrity import fk_check, missing_expected, orphans
from curate.operators.metrics import mask_histogram, patterns
from curate.operators.profile import ingest_metrics, key_stats, null_profile, top_null_columns
from curate.operators.rules import active_violations, check_rules
from curate.operators.standardise import curate
from curate.operators.summary import (grouped_mean, share_of_group, summary_counts, top_k)
from curate.plans import oracle as O
from curate.plans.fixtures import encounters_full, encounters_raw, encounters_spec, mapping_lines
from curate.sources.lines import (header_widths, route_sections, section_headers,
                                  section_to_dim, split_sections)
from curate.sources.tables import load
from curate.spec import DIMENSIONS, ENCOUNTER_COLUMNS, ENCOUNTERS, FactSpec

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# --------------------------------------------------------------------------
# Encounter flow building blocks
# --------------------------------------------------------------------------

def _spec(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, FactSpec]:
    raw = encounters_raw(spark, sf_dir)
    return raw, encounters_spec(raw)


def _nulled(spark, sf_dir):
    raw, spec = _spec(spark, sf_dir)
    return nullify(with_null(raw, "_corrupt_record"), spec.sentinel), spec


def _typed(spark, sf_dir):
    nulled, spec = _nulled(spark, sf_dir)
    return apply_schema(nulled, spec.schema), spec


def _clean(spark, sf_dir, one_pass: bool = False):
    typed, spec = _typed(spark, sf_dir)
    return dedupe(typed, spec.key, one_pass=one_pass), spec


def _curated(spark, sf_dir, one_pass: bool = False):
    clean, spec = _clean(spark, sf_dir, one_pass)
    return curate(clean, spec), spec


def _dims(spark, sf_dir) -> dict[str, DataFrame]:
    sections = split_sections(mapping_lines(spark, sf_dir)).persist(StorageLevel.MEMORY_AND_DISK)
    routed = route_sections(section_headers(sections), DIMENSIONS).persist(
        StorageLevel.MEMORY_AND_DISK)
    widths = header_widths(routed)
    out = {}
    for d in DIMENSIONS:
        n, width = widths.get(d.table, (0, 0))
        out[d.table] = section_to_dim(sections, routed, d, n_sections=n, width=width)
    return out


_SPEC = ENCOUNTERS.restrict(O.RAW_COLUMNS)
CTES = O.encounter_ctes(_SPEC)
_ID = O.ident


# --------------------------------------------------------------------------
# Cleaning and casting
# --------------------------------------------------------------------------

@register("nullify_sentinel", f"""{CTES}
SELECT * FROM nulled""")
def nullify_sentinel(spark, sf_dir):
    raw, spec = _spec(spark, sf_dir)
    return nullify(raw, spec.sentinel)


@register("hard_schema", f"""{CTES}
SELECT * FROM typed""")
def hard_schema(spark, sf_dir):
    return _typed(spark, sf_dir)[0]


@register("lenient_cast_decimal_text", f"""{CTES}
SELECT encounter_id AS encounter_id_text, patient_nbr AS patient_nbr_text,
       {O.lenient_cast_sql('patient_nbr', T.LongType())} AS patient_nbr
FROM raw""")
def lenient_cast_decimal_text(spark, sf_dir):
    raw = encounters_raw(spark, sf_dir)
    return raw.select(F.col("encounter_id").alias("encounter_id_text"),
                      F.col("patient_nbr").alias("patient_nbr_text"),
                      lenient_cast("patient_nbr", T.LongType()).alias("patient_nbr"))


def _cast_profile_sql() -> str:
    ints = [f for f in _SPEC.schema.fields if isinstance(f.dataType, (T.IntegerType, T.LongType))]
    parts = [
        f"SELECT {O.lit(f.name)} AS {_ID('column')}, {O.lit(f.dataType.simpleString())} AS target_type, "
        f"CAST(count_if({_ID(f.name)} IS NOT NULL AND "
        f"{O.lenient_cast_sql(_ID(f.name), f.dataType)} IS NULL) AS BIGINT) AS failed_rows, "
        f"CAST(count(*) AS BIGINT) AS total FROM nulled"
        for f in ints]
    body = "\nUNION ALL\n".join(parts)
    return f"""{CTES}
SELECT {_ID('column')}, target_type, failed_rows, {O.half_up_pct('failed_rows', 'total')} AS failure_rate_pct
FROM ({body}) WHERE failed_rows > 0"""


@register("cast_failure_profile", _cast_profile_sql())
def cast_failure_profile(spark, sf_dir):
    nulled, spec = _nulled(spark, sf_dir)
    return cast_profile(nulled, spec.schema)


@register("schema_column_selection", f"""{CTES}
SELECT {", ".join(_ID(f.name) for f in _SPEC.schema.fields
                  if isinstance(f.dataType, (T.IntegerType, T.LongType)))} FROM typed""")
def schema_column_selection(spark, sf_dir):
    typed, _ = _typed(spark, sf_dir)
    return typed.select([q(c) for c in cols_of(typed, T.IntegerType, T.LongType)])


@register("ingest_metrics", f"""{CTES}
SELECT CAST(count(*) AS BIGINT) AS rows, CAST({len(O.RAW_COLUMNS)} AS INTEGER) AS cols,
       CAST(0 AS BIGINT) AS corrupt_rows FROM raw""")
def ingest_metrics_q(spark, sf_dir):
    raw = encounters_raw(spark, sf_dir)
    return ingest_metrics(with_null(raw, "_corrupt_record"))


# --------------------------------------------------------------------------
# De-duplication
# --------------------------------------------------------------------------

@register("dedupe_stats", f"""{CTES}
SELECT CAST(count(*) AS BIGINT) AS rows_before,
       CAST((SELECT count(*) FROM (SELECT DISTINCT encounter_id FROM typed)) AS BIGINT) AS rows_after,
       CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT encounter_id FROM typed)) AS BIGINT) AS duplicates_removed
FROM typed""")
def dedupe_stats_q(spark, sf_dir):
    typed, spec = _typed(spark, sf_dir)
    return dedupe_stats(typed, spec.key)


@register("dedupe_rows", f"""{CTES}
SELECT * FROM clean""")
def dedupe_rows(spark, sf_dir):
    return _clean(spark, sf_dir)[0]


_LINEITEM_KEY = ("l_orderkey", "l_linenumber")
_LINEITEM_REST = ("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
                  "l_returnflag", "l_linestatus", "l_shipdate")


@register("dedupe_stats_lineitem", """
SELECT CAST(count(*) AS BIGINT) AS rows_before,
       CAST((SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS BIGINT) AS rows_after,
       CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS BIGINT) AS duplicates_removed
FROM lineitem""")
def dedupe_stats_lineitem(spark, sf_dir):
    return dedupe_stats(load(spark, sf_dir, "lineitem"), _LINEITEM_KEY)


@register("dedupe_rows_lineitem", f"""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount,
       l_tax, l_returnflag, l_linestatus, l_shipdate
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY {", ".join(c + " ASC NULLS FIRST" for c in _LINEITEM_REST)}) AS rn FROM lineitem)
WHERE rn = 1""")
def dedupe_rows_lineitem(spark, sf_dir):
    return dedupe(load(spark, sf_dir, "lineitem"), _LINEITEM_KEY)


# --------------------------------------------------------------------------
# Missing values
# --------------------------------------------------------------------------

def _null_union(rel: str) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT {O.lit(c)} AS {_ID('column')}, {i} AS ordinal, "
        f"CAST(count_if({_ID(c)} IS NULL) AS BIGINT) AS null_count, CAST(count(*) AS BIGINT) AS total "
        f"FROM {rel}" for i, c in enumerate(_SPEC.columns))


@register("null_profile", f"""{CTES}
SELECT {_ID('column')}, null_count, {O.half_up_pct('null_count', 'total')} AS null_pct
FROM ({_null_union('clean')}) WHERE null_count > 0""")
def null_profile_q(spark, sf_dir):
    return null_profile(_clean(spark, sf_dir, one_pass=True)[0])


@register("top_null_columns", f"""{CTES}
SELECT {_ID('column')}, null_count, null_pct FROM (
  SELECT {_ID('column')}, ordinal, null_count, {O.half_up_pct('null_count', 'total')} AS null_pct
  FROM ({_null_union('clean')}) WHERE null_count > 0)
ORDER BY null_pct DESC, ordinal ASC LIMIT 5""")
def top_null_columns_q(spark, sf_dir):
    return top_null_columns(_clean(spark, sf_dir, one_pass=True)[0], 5)


# --------------------------------------------------------------------------
# Sectioned mapping file -> dimensions
# --------------------------------------------------------------------------

_DIM_TYPE_SQL = """SELECT CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS admission_type_id,
       substr(o_orderpriority, 3) || ' ' || o_orderstatus AS admission_type_name
FROM orders GROUP BY o_orderpriority, o_orderstatus"""
_DIM_DISCHARGE_SQL = """SELECT n_nationkey AS discharge_disposition_id,
       n_name || ', region ' || CAST(n_regionkey AS VARCHAR) AS discharge_disposition_name
FROM nation"""
_DIM_SOURCE_SQL = """SELECT r_regionkey AS admission_source_id, r_name AS admission_source_name
FROM region"""


@register("dim_build_type", _DIM_TYPE_SQL)
def dim_build_type(spark, sf_dir):
    return _dims(spark, sf_dir)["dim_admission_type"]


@register("dim_build_discharge", _DIM_DISCHARGE_SQL)
def dim_build_discharge(spark, sf_dir):
    return _dims(spark, sf_dir)["dim_discharge_disposition"]


@register("dim_build_source", _DIM_SOURCE_SQL)
def dim_build_source(spark, sf_dir):
    return _dims(spark, sf_dir)["dim_admission_source"]


@register("dim_key_stats", f"""
SELECT 'dim_admission_type' AS table_name, CAST(count(*) AS BIGINT) AS rows,
       CAST(count(DISTINCT admission_type_id) AS BIGINT) AS distinct_ids,
       CAST(count(*) - count(DISTINCT admission_type_id) AS BIGINT) AS duplicates FROM ({_DIM_TYPE_SQL})
UNION ALL
SELECT 'dim_discharge_disposition', CAST(count(*) AS BIGINT), CAST(count(DISTINCT discharge_disposition_id) AS BIGINT),
       CAST(count(*) - count(DISTINCT discharge_disposition_id) AS BIGINT) FROM ({_DIM_DISCHARGE_SQL})
UNION ALL
SELECT 'dim_admission_source', CAST(count(*) AS BIGINT), CAST(count(DISTINCT admission_source_id) AS BIGINT),
       CAST(count(*) - count(DISTINCT admission_source_id) AS BIGINT) FROM ({_DIM_SOURCE_SQL})""")
def dim_key_stats(spark, sf_dir):
    dims = _dims(spark, sf_dir)
    parts = [key_stats(dims[d.table], d.id_col).select(F.lit(d.table).alias("table_name"), "*")
             for d in DIMENSIONS]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionAll(p)
    return out


@register("section_routing", """
SELECT CAST(0 AS INTEGER) AS section_no, 'admission_type_id,description' AS header,
       'dim_admission_type' AS dim,
       CAST(1 + (SELECT count(*) FROM (SELECT DISTINCT o_orderpriority, o_orderstatus FROM orders)) AS BIGINT) AS lines
UNION ALL
SELECT 1, 'discharge_disposition_id,description', 'dim_discharge_disposition',
       CAST(1 + (SELECT count(*) FROM nation) AS BIGINT)
UNION ALL
SELECT 2, 'admission_source_id,description', 'dim_admission_source',
       CAST(1 + 2 * (SELECT count(*) FROM region) AS BIGINT)
UNION ALL
SELECT 3, 'payer_code,description', NULL,
       CAST(2 + (SELECT count(DISTINCT c_mktsegment) FROM customer) AS BIGINT)""")
def section_routing(spark, sf_dir):
    sections = split_sections(mapping_lines(spark, sf_dir))
    routed = route_sections(section_headers(sections), DIMENSIONS)
    return routed.select(F.col("section_no").cast("int").alias("section_no"), "header", "dim", "lines")


# --------------------------------------------------------------------------
# Referential integrity
# --------------------------------------------------------------------------

def _fk_inputs(spark, sf_dir):
    clean, spec = _clean(spark, sf_dir)
    dims = _dims(spark, sf_dir)
    return clean, [(k.fk, dims[k.dim_table], k.dim_id) for k in spec.fks]


_FK_SQL = f"""{CTES},
d_type AS ({_DIM_TYPE_SQL}), d_dis AS ({_DIM_DISCHARGE_SQL}), d_src AS ({_DIM_SOURCE_SQL})
SELECT 'admission_type_id' AS fk, CAST((SELECT count(DISTINCT admission_type_id) FROM d_type) AS BIGINT) AS valid_dim_values,
       CAST(count_if(admission_type_id IS NOT NULL AND admission_type_id NOT IN (SELECT admission_type_id FROM d_type)) AS BIGINT) AS orphaned_fact_rows
FROM clean
UNION ALL
SELECT 'discharge_disposition_id', CAST((SELECT count(DISTINCT discharge_disposition_id) FROM d_dis) AS BIGINT),
       CAST(count_if(discharge_disposition_id IS NOT NULL AND discharge_disposition_id NOT IN (SELECT discharge_disposition_id FROM d_dis)) AS BIGINT)
FROM clean
UNION ALL
SELECT 'admission_source_id', CAST((SELECT count(DISTINCT admission_source_id) FROM d_src) AS BIGINT),
       CAST(count_if(admission_source_id IS NOT NULL AND admission_source_id NOT IN (SELECT admission_source_id FROM d_src)) AS BIGINT)
FROM clean"""


@register("fk_orphan_counts", _FK_SQL)
def fk_orphan_counts(spark, sf_dir):
    clean, fks = _fk_inputs(spark, sf_dir)
    return fk_check(clean, fks)


@register("fk_orphan_rows", f"""{CTES}
SELECT * FROM clean WHERE admission_source_id IS NOT NULL
  AND admission_source_id NOT IN (SELECT r_regionkey FROM region)""")
def fk_orphan_rows(spark, sf_dir):
    clean, _ = _clean(spark, sf_dir)
    dim = _dims(spark, sf_dir)["dim_admission_source"]
    return orphans(clean, "admission_source_id", dim, "admission_source_id")


_LARGE_FKS = (("l_orderkey", "orders", "o_orderkey", "o_orderstatus = 'F'"), ("l_partkey", "part", "p_partkey", "p_size > 10"),
              ("l_suppkey", "supplier", "s_suppkey", "s_acctbal > 0"))


@register("fk_orphan_counts_large", "\nUNION ALL\n".join(f"""
SELECT '{fk}' AS fk, CAST((SELECT count(DISTINCT {key}) FROM {dim} WHERE {cond}) AS BIGINT) AS valid_dim_values,
       CAST(count_if({fk} IS NOT NULL AND {fk} NOT IN (SELECT {key} FROM {dim} WHERE {cond})) AS BIGINT) AS orphaned_fact_rows FROM lineitem"""
    for fk, dim, key, cond in _LARGE_FKS))
def fk_orphan_counts_large(spark, sf_dir):
    """Three keys of the largest table against dimensions of any size, as bitmaps, in one scan."""
    return fk_check_bitmaps(load(spark, sf_dir, "lineitem"), [
        (fk, load(spark, sf_dir, dim).where(cond), key) for fk, dim, key, cond in _LARGE_FKS])


@register("fk_orphan_rows_large", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE o_custkey IS NOT NULL AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)""")
def fk_orphan_rows_large(spark, sf_dir):
    customers = load(spark, sf_dir, "customer").where("c_acctbal > 0")
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return orphans_bitmaps(orders, "o_custkey", customers, "c_custkey")


@register("distinct_merged_parts", """
SELECT l_returnflag, l_linestatus, CAST(count(*) AS BIGINT) AS line_count, CAST(count(DISTINCT l_orderkey) AS BIGINT) AS unique_orders
FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def distinct_merged_parts(spark, sf_dir):
    """Exact distinct counts folded from the bitmaps of four parts of the table (by supplier, so that
    orders are in several of them)."""
    li, by = load(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"]
    parts = [distinct_partials(li.where(F.pmod("l_suppkey", F.lit(4)) == k), by, "l_orderkey") for k in range(4)]
    return distinct_counts(merge_partials(parts, by), by, "line_count", "unique_orders")


@register("fk_empty_dimension", f"""{CTES}
SELECT 'admission_type_id' AS fk, CAST(0 AS BIGINT) AS valid_dim_values,
       CAST(count_if(admission_type_id IS NOT NULL) AS BIGINT) AS orphaned_fact_rows FROM clean""")
def fk_empty_dimension(spark, sf_dir):
    clean, _ = _clean(spark, sf_dir)
    dim = _dims(spark, sf_dir)["dim_admission_type"].where(F.col("admission_type_id") < 0)
    return fk_check(clean, [("admission_type_id", dim, "admission_type_id")])


@register("unlabelled_documents", """
SELECT doc_id, lang, source, n_chars FROM documents d
WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""")
def unlabelled_documents(spark, sf_dir):
    docs = load(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    labels = load(spark, sf_dir, "labels")
    return orphans(docs, "doc_id", labels, "doc_id")


# Fixed expected member names for the expected-files check.
EXPECTED_PAGE_NAMES = ("25#top", "685", "676", "index.html", "robots.txt", "sitemap.xml")


@register("missing_expected_files", f"""
SELECT file_name FROM (VALUES {", ".join(f"({O.lit(n)})" for n in EXPECTED_PAGE_NAMES)}) e(file_name)
WHERE file_name NOT IN (SELECT regexp_extract(url, '[^/]*$') FROM pages)
ORDER BY file_name""")
def missing_expected_files(spark, sf_dir):
    found = load(spark, sf_dir, "pages").select(basename("url").alias("file_name"))
    return missing_expected(spark, found, EXPECTED_PAGE_NAMES)


# --------------------------------------------------------------------------
# Business rules
# --------------------------------------------------------------------------

def _rules_sql(active_only: bool) -> str:
    parts = []
    for r in _SPEC.rules:
        sel = (f"SELECT {O.lit(r.name)} AS {_ID('constraint')}, "
               f"CAST(count_if({O.rule_sql(r)}) AS BIGINT) AS violations FROM curated")
        if not r.report_zero or active_only:
            sel = f"SELECT * FROM ({sel}) WHERE violations > 0"
        parts.append(sel)
    return CTES + "\n" + "\nUNION ALL\n".join(parts)


@register("rule_violations", _rules_sql(False))
def rule_violations(spark, sf_dir):
    curated, spec = _curated(spark, sf_dir, one_pass=True)
    return check_rules(curated, spec.rules)


@register("active_violations", _rules_sql(True))
def active_violations_q(spark, sf_dir):
    curated, spec = _curated(spark, sf_dir, one_pass=True)
    return active_violations(check_rules(curated, spec.rules))


def _pattern_sql(rel: str, named: list[tuple[str, str]]) -> str:
    parts = ", ".join(f"CASE WHEN {cond} THEN {O.lit(n)} END" for n, cond in named)
    return f"""{CTES}
SELECT pattern, CAST(count(*) AS BIGINT) AS rows FROM (SELECT concat_ws(',', {parts}) AS pattern FROM {rel}) GROUP BY pattern"""


@register("rule_patterns", _pattern_sql("curated", [(r.name, O.rule_sql(r)) for r in _SPEC.rules]))
def rule_patterns(spark, sf_dir):
    """Which rules are violated together, and by how many rows."""
    curated, spec = _curated(spark, sf_dir, one_pass=True)
    return patterns(mask_histogram(curated, [(r.name, r.violated()) for r in spec.rules]), [r.name for r in spec.rules])


@register("null_patterns", _pattern_sql("clean", [(c, f"{_ID(c)} IS NULL") for c in _SPEC.columns]))
def null_patterns(spark, sf_dir):
    """Which columns are null together, and in how many rows."""
    clean, spec = _clean(spark, sf_dir, one_pass=True)
    return patterns(mask_histogram(clean, [(c, q(c).isNull()) for c in spec.columns]), spec.columns)


@register("events_utc_iso", "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS ts_utc FROM events")
def events_utc_iso(spark, sf_dir):
    return load(spark, sf_dir, "events").select("event_id", utc_iso("ts").alias("ts_utc"))


# --------------------------------------------------------------------------
# Standardisation and derived features
# --------------------------------------------------------------------------

_STD_COLS = ("encounter_id", "race", "gender", "max_glu_serum", "metformin", "change",
             "diabetesMed", "readmitted")


@register("standardise_categories", f"""{CTES}
SELECT {", ".join(_ID(c) for c in _STD_COLS)} FROM curated""")
def standardise_categories(spark, sf_dir):
    return _curated(spark, sf_dir)[0].select(*[q(c) for c in _STD_COLS])


@register("diagnosis_codes", f"""{CTES}
SELECT encounter_id, diag_1 FROM curated""")
def diagnosis_codes(spark, sf_dir):
    return _curated(spark, sf_dir)[0].select("encounter_id", "diag_1")


@register("age_bounds_group", f"""{CTES}
SELECT encounter_id, age, age_lower, age_upper, age_group FROM curated""")
def age_bounds_group(spark, sf_dir):
    return _curated(spark, sf_dir)[0].select("encounter_id", "age", "age_lower", "age_upper",
                                             "age_group")


@register("readmitted_flag", f"""{CTES}
SELECT encounter_id, readmitted, readmitted_flag FROM curated""")
def readmitted_flag(spark, sf_dir):
    return _curated(spark, sf_dir)[0].select("encounter_id", "readmitted", "readmitted_flag")


@register("curated_fact", f"""{CTES}
SELECT * FROM curated""")
def curated_fact(spark, sf_dir):
    return _curated(spark, sf_dir)[0]


# --------------------------------------------------------------------------
# The full extract: all 50 columns, all 38 rules
# --------------------------------------------------------------------------

def _full_typed(spark, sf_dir):
    raw = with_null(encounters_full(spark, sf_dir), "_corrupt_record")
    return apply_schema(nullify(raw, ENCOUNTERS.sentinel), ENCOUNTERS.schema)


def _full_curated(spark, sf_dir, one_pass: bool = False):
    return curate(dedupe(_full_typed(spark, sf_dir), ENCOUNTERS.key, one_pass=one_pass), ENCOUNTERS)


_FULL = O.full_ctes()


@register("full_curated_fact", f"""{_FULL}
SELECT * FROM curated""")
def full_curated_fact(spark, sf_dir):
    return _full_curated(spark, sf_dir)


@register("full_rule_violations", O.full_rules_sql())
def full_rule_violations(spark, sf_dir):
    return check_rules(_full_curated(spark, sf_dir, one_pass=True), ENCOUNTERS.rules)


@register("full_cast_failures", f"""{_FULL}
SELECT {_ID('column')}, target_type, failed_rows, {O.half_up_pct('failed_rows', 'total')} AS failure_rate_pct FROM (
{chr(10).join(f"{'UNION ALL ' if i else ''}SELECT '{c}' AS {_ID('column')}, '{'bigint' if i < 2 else 'int'}' AS target_type, CAST(count_if(n.{c} IS NOT NULL AND {O.lenient_cast_sql('n.' + c, T.LongType() if i < 2 else T.IntegerType())} IS NULL) AS BIGINT) AS failed_rows, CAST(count(*) AS BIGINT) AS total FROM nulled n"
              for i, c in enumerate(O.WHOLE_NUMBERS))}) WHERE failed_rows > 0""")
def full_cast_failures(spark, sf_dir):
    raw = with_null(encounters_full(spark, sf_dir), "_corrupt_record")
    return cast_profile(nullify(raw, ENCOUNTERS.sentinel), ENCOUNTERS.schema)


@register("full_null_profile", f"""{_FULL}
SELECT {_ID('column')}, null_count, {O.half_up_pct('null_count', 'total')} AS null_pct FROM (
{chr(10).join(f"{'UNION ALL ' if i else ''}SELECT {O.lit(c)} AS {_ID('column')}, CAST(count_if({_ID(c)} IS NULL) AS BIGINT) AS null_count, CAST(count(*) AS BIGINT) AS total FROM clean"
              for i, c in enumerate(ENCOUNTER_COLUMNS))}) WHERE null_count > 0""")
def full_null_profile(spark, sf_dir):
    return null_profile(dedupe(_full_typed(spark, sf_dir), ENCOUNTERS.key, one_pass=True))


# --------------------------------------------------------------------------
# Summaries
# --------------------------------------------------------------------------

_SHARE_SQL = """
SELECT {g}, {b}, "count", total, {pct} AS percentage FROM (
  SELECT {g}, {b}, "count", CAST(sum("count") OVER (PARTITION BY {g}) AS BIGINT) AS total FROM (
    SELECT {g}, {b}, CAST(count(*) AS BIGINT) AS "count" FROM {rel} GROUP BY {g}, {b}))"""


@register("readmission_share", CTES + _SHARE_SQL.format(
    g="age_group", b="readmitted", rel="curated", pct=O.half_up_pct('"count"', "total")))
def readmission_share(spark, sf_dir):
    curated, spec = _curated(spark, sf_dir)
    return share_of_group(curated, spec.summary.share_group, spec.summary.share_by)


@register("top_diagnoses", f"""{CTES}
SELECT diag_1, CAST(count(*) AS BIGINT) AS encounter_count,
       CAST(count(DISTINCT patient_nbr) AS BIGINT) AS unique_patients
FROM curated WHERE diag_1 IS NOT NULL GROUP BY diag_1
ORDER BY encounter_count DESC, diag_1 ASC LIMIT 10""")
def top_diagnoses(spark, sf_dir):
    curated, spec = _curated(spark, sf_dir)
    s = spec.summary
    return top_k(curated, s.top_key, s.top_distinct, s.top_k)


@register("los_by_demographics", f"""{CTES}
SELECT age_group, gender,
       {O.half_up_ratio('sum(time_in_hospital)', 'count(time_in_hospital)')} AS avg_los_days,
       CAST(count(*) AS BIGINT) AS encounter_count,
       CAST(count(DISTINCT patient_nbr) AS BIGINT) AS unique_patients
FROM curated GROUP BY age_group, gender""")
def los_by_demographics(spark, sf_dir):
    curated, spec = _curated(spark, sf_dir)
    s = spec.summary
    return grouped_mean(curated, list(s.mean_by), s.mean_value, s.mean_distinct)


@register("event_share_by_type", _SHARE_SQL.format(
    g="day", b="event_type", pct=O.half_up_pct('"count"', "total"),
    rel="(SELECT strftime(ts, '%Y-%m-%d') AS day, event_type FROM events)"))
def event_share_by_type(spark, sf_dir):
    ev = load(spark, sf_dir, "events").select(
        F.date_format("ts", "yyyy-MM-dd").alias("day"), "event_type")
    return share_of_group(ev, "day", "event_type")


@register("top_parts", """
SELECT l_partkey, CAST(count(*) AS BIGINT) AS line_count,
       CAST(count(DISTINCT l_orderkey) AS BIGINT) AS unique_orders
FROM lineitem WHERE l_partkey IS NOT NULL GROUP BY l_partkey
ORDER BY line_count DESC, l_partkey ASC LIMIT 10""")
def top_parts(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem")
    return top_k(li, "l_partkey", "l_orderkey", 10, count_name="line_count",
                 distinct_name="unique_orders")


@register("avg_qty_by_flag", f"""
SELECT l_returnflag, l_linestatus,
       {O.half_up_ratio('CAST(sum(l_quantity) AS BIGINT)', 'count(l_quantity)')} AS avg_qty,
       CAST(count(*) AS BIGINT) AS line_count,
       CAST(count(DISTINCT l_orderkey) AS BIGINT) AS unique_orders
FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def avg_qty_by_flag(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem")
    return grouped_mean(li, ["l_returnflag", "l_linestatus"], "l_quantity", "l_orderkey",
                        mean_name="avg_qty", count_name="line_count",
                        distinct_name="unique_orders")


@register("summary_counts", f"""{CTES}
SELECT 'readmission_by_age_count' AS summary,
       CAST((SELECT count(*) FROM (SELECT DISTINCT age_group, readmitted FROM curated)) AS BIGINT) AS row_count
UNION ALL
SELECT 'top_diagnoses_count',
       CAST(least(10, (SELECT count(DISTINCT diag_1) FROM curated)) AS BIGINT)
UNION ALL
SELECT 'demographic_groups',
       CAST((SELECT count(*) FROM (SELECT DISTINCT age_group, gender FROM curated)) AS BIGINT)""")
def summary_counts_q(spark, sf_dir):
    curated, spec = _curated(spark, sf_dir)
    s = spec.summary
    return summary_counts({
        "readmission_by_age_count": share_of_group(curated, s.share_group, s.share_by),
        "top_diagnoses_count": top_k(curated, s.top_key, s.top_distinct, s.top_k),
        "demographic_groups": grouped_mean(curated, list(s.mean_by), s.mean_value,
                                           s.mean_distinct),
    })


# File-writing entries register themselves on import.
from curate.plans import catalogue_io  # noqa: E402,F401
