"""Independent ANSI-SQL (DuckDB dialect) statements of the catalogue queries.

They are generated from the same declarative spec as the Spark side, but
each semantic rule is restated here in plain SQL (no shared Column code):
lenient casting via a regex gate, half-up percentages via integer
arithmetic, ``initcap`` via word lists, deterministic dedupe via
``row_number`` over all non-key columns ascending, nulls first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import types as T

from curate.spec import ENCOUNTER_COLUMNS, MEDICATIONS, Derived, FactSpec, Rule, Std


def ident(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def lit(value: object) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    return str(value)


SQL_TYPES = {"int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE",
             "smallint": "SMALLINT", "tinyint": "TINYINT"}


def sql_type(dt: T.DataType | str) -> str:
    name = dt if isinstance(dt, str) else dt.simpleString()
    return SQL_TYPES[name]


def lenient_cast_sql(expr: str, dt: T.DataType) -> str:
    """Non-ANSI string->integral cast: whitespace allowed, fraction truncated, else NULL."""
    t = sql_type(dt)
    if t == "VARCHAR":
        return expr
    return (f"(CASE WHEN regexp_full_match({expr}, '\\s*[+-]?\\d+(\\.\\d*)?\\s*') "
            f"THEN TRY_CAST(regexp_extract({expr}, '^\\s*([+-]?\\d+)', 1) AS {t}) "
            f"WHEN regexp_full_match({expr}, '\\s*[+-]?\\.\\d*\\s*') THEN CAST(0 AS {t}) END)")


def half_up_pct(n: str, total: str) -> str:
    """round(100 * n / total, 2), half-up, for n, total >= 0; NULL when total = 0."""
    return (f"(CAST((20000 * CAST({n} AS HUGEINT) + {total}) // NULLIF(2 * CAST({total} AS HUGEINT), 0) "
            f"AS DOUBLE) / 100)")


def half_up_ratio(num: str, den: str) -> str:
    """round(num / den, 2) half-up (away from zero) for any sign of num, den > 0."""
    return (f"(CAST(sign({num}) * ((200 * abs(CAST({num} AS HUGEINT)) + {den}) "
            f"// NULLIF(2 * CAST({den} AS HUGEINT), 0)) AS DOUBLE) / 100)")


def initcap_sql(expr: str) -> str:
    return (f"array_to_string(list_transform(string_split(lower({expr}), ' '), "
            f"lambda w: upper(w[1]) || w[2:]), ' ')")


# --------------------------------------------------------------------------
# Encounter fixture as CTEs: raw -> nulled -> typed -> clean -> curated
# --------------------------------------------------------------------------

# One expression per raw column over ``orders``; both engines read them, since they only
# make the test input.
RAW_EXPRS = {
    "encounter_id": "CASE WHEN o_orderkey % 997 = 0 THEN concat('E', CAST(o_orderkey AS STRING)) ELSE CAST(o_orderkey AS STRING) END",
    "patient_nbr": "CASE WHEN o_orderkey % 331 = 0 THEN concat(CAST(o_custkey AS STRING), '.7') ELSE CAST(o_custkey AS STRING) END",
    "race": "CASE o_orderkey % 5 WHEN 0 THEN 'AfricanAmerican' WHEN 1 THEN 'Caucasian' WHEN 2 THEN ' asian' WHEN 3 THEN ' ? ' ELSE 'Other' END",
    "gender": "CASE o_orderkey % 7 WHEN 0 THEN 'Unknown/Invalid' WHEN 1 THEN 'male' WHEN 2 THEN ' FEMALE ' WHEN 3 THEN 'Female' ELSE 'Male' END",
    "age": "CASE WHEN o_orderkey % 101 = 0 THEN 'unknown' WHEN o_orderkey % 103 = 0 THEN '?' "
           "ELSE concat('[', CAST(10 * (o_custkey % 10) AS STRING), '-', CAST(10 * (o_custkey % 10) + 10 AS STRING), ')') END",
    "admission_type_id": "CASE WHEN o_orderkey % 211 = 0 THEN '99' WHEN o_orderkey % 223 = 0 THEN '?' ELSE substr(o_orderpriority, 1, 1) END",
    "discharge_disposition_id": "CAST(1 + o_orderkey % 25 AS STRING)",
    "admission_source_id": "CAST(1 + o_orderkey % 5 AS STRING)",
    "time_in_hospital": "CAST(o_orderkey % 15 AS STRING)",
    "num_lab_procedures": "CASE WHEN o_orderkey % 89 = 0 THEN 'n/a' ELSE CAST(o_orderkey % 60 - 1 AS STRING) END",
    "number_diagnoses": "CAST(o_orderkey % 10 AS STRING)",
    "diag_1": "CASE WHEN o_orderkey % 17 = 0 THEN '?' ELSE concat('250.', CAST(o_custkey % 83 AS STRING)) END",
    "max_glu_serum": "CASE WHEN o_orderkey % 307 = 0 THEN 'high' WHEN o_orderkey % 4 = 0 THEN 'None' WHEN o_orderkey % 4 = 1 THEN 'Norm' "
                     "WHEN o_orderkey % 4 = 2 THEN '>200' ELSE '>300' END",
    "metformin": "CASE o_orderkey % 6 WHEN 0 THEN 'No' WHEN 1 THEN 'steady' WHEN 2 THEN ' UP' WHEN 3 THEN 'Down' WHEN 4 THEN 'Maybe' ELSE '?' END",
    "change": "CASE o_orderkey % 4 WHEN 0 THEN 'Ch' WHEN 1 THEN 'No' WHEN 2 THEN 'CH ' ELSE 'Maybe' END",
    "diabetesMed": "CASE o_orderkey % 3 WHEN 0 THEN 'yes' WHEN 1 THEN 'No' ELSE '?' END",
    "readmitted": "CASE o_orderkey % 9 WHEN 0 THEN '>30' WHEN 1 THEN '<30' WHEN 2 THEN 'no' WHEN 3 THEN 'later' ELSE 'NO' END",
}
RAW_COLUMNS = tuple(RAW_EXPRS)


def _medication_expr(i: int) -> str:
    """Values of the i-th further medication; two in five of them sometimes hold a value outside the domain."""
    bad = f"WHEN o_orderkey % {100 + i} = 0 THEN 'Maybe' " if i % 5 in (1, 3) else ""
    return (f"CASE {bad}WHEN (o_orderkey + {i}) % 11 = 0 THEN '?' WHEN (o_custkey + {i}) % 5 = 0 THEN ' steady' "
            f"WHEN (o_custkey + {i}) % 5 = 1 THEN 'UP ' WHEN (o_orderkey + {i}) % 3 = 0 THEN 'Down' ELSE 'no' END")


#: The columns that the narrow extract leaves out.
FURTHER_EXPRS = {
    "weight": "CASE WHEN o_orderkey % 13 = 0 THEN '[75-100)' ELSE '?' END",
    "payer_code": "CASE o_orderkey % 4 WHEN 0 THEN '?' WHEN 1 THEN 'MC' WHEN 2 THEN ' HM' ELSE 'SP ' END",
    "medical_specialty": "CASE WHEN o_orderkey % 3 = 0 THEN ' ?' ELSE concat('Cardiology-', CAST(o_custkey % 7 AS STRING)) END",
    "num_procedures": "CAST(o_orderkey % 8 - 1 AS STRING)",
    "num_medications": "CASE WHEN o_orderkey % 97 = 0 THEN 'x12' WHEN o_orderkey % 83 = 0 THEN '-3' ELSE CAST(o_orderkey % 60 AS STRING) END",
    "number_outpatient": "CASE WHEN o_orderkey % 71 = 0 THEN '-1' ELSE CAST(o_custkey % 4 AS STRING) END",
    "number_emergency": "CASE WHEN o_orderkey % 73 = 0 THEN '2.5' WHEN o_orderkey % 67 = 0 THEN '-1.9' ELSE CAST(o_custkey % 3 AS STRING) END",
    "number_inpatient": "CASE WHEN o_orderkey % 79 = 0 THEN ' -2 ' ELSE CAST(o_orderkey % 5 AS STRING) END",
    "diag_2": "CASE WHEN o_orderkey % 19 = 0 THEN '?' ELSE concat('V', CAST(o_custkey % 90 AS STRING), '.', CAST(o_orderkey % 10 AS STRING)) END",
    "diag_3": "CASE WHEN o_orderkey % 23 = 0 THEN ' ? ' ELSE concat(' E9', CAST(o_custkey % 50 AS STRING), '.8.1') END",
    "A1Cresult": "CASE WHEN o_orderkey % 311 = 0 THEN 'high' WHEN o_custkey % 4 = 0 THEN '>8' WHEN o_custkey % 4 = 1 THEN 'NORM' "
                 "WHEN o_custkey % 4 = 2 THEN 'None ' ELSE '>7' END",
    **{m: _medication_expr(i) for i, m in enumerate(MEDICATIONS) if m not in RAW_EXPRS},
}


def raw_sql(columns: Sequence[str] = RAW_COLUMNS) -> str:
    exprs = {**RAW_EXPRS, **FURTHER_EXPRS}
    cols = ",\n  ".join(f"{exprs[c]} AS {ident(c)}" for c in columns)
    return f"""
SELECT
  {cols}
FROM (SELECT o_orderkey, o_custkey, o_orderpriority FROM orders
      UNION ALL
      SELECT o_orderkey, o_custkey, o_orderpriority FROM orders WHERE o_orderkey % 50 = 0) o
"""


def _std_sql(s: Std, e: str) -> str:
    if s.kind == "lower":
        return f"lower({e})"
    if s.kind == "upper":
        return f"upper({e})"
    if s.kind == "initcap":
        return initcap_sql(e)
    if s.kind == "strip":
        out = e
        for ch in s.chars:
            out = f"replace({out}, {lit(ch)}, '')"
        return out
    if s.kind == "canonical":
        whens = " ".join(f"WHEN lower({e}) = {lit(k.lower())} THEN {lit(v)}" for k, v in s.mapping)
        other = "NULL" if s.other is None else (f"lower({e})" if s.other == "__lower__" else lit(s.other))
        return f"(CASE {whens} ELSE {other} END)"
    raise ValueError(s.kind)


def _derived_sql(d: Derived, src: str) -> str:
    if d.kind == "interval_lower":
        return f"TRY_CAST(NULLIF(regexp_extract({src}, '\\[(\\d+)-', 1), '') AS INTEGER)"
    if d.kind == "interval_upper":
        return f"TRY_CAST(NULLIF(regexp_extract({src}, '-(\\d+)\\)', 1), '') AS INTEGER)"
    if d.kind == "bucket":
        whens = " ".join(f"WHEN {src} < {b} THEN {lit(lbl)}" for b, lbl in d.bounds)
        return f"(CASE {whens} ELSE {lit(d.otherwise)} END)"
    if d.kind == "ordinal":
        whens = " ".join(f"WHEN {src} = {lit(k)} THEN {v}" for k, v in d.codes)
        return f"CAST(CASE {whens} END AS INTEGER)"
    raise ValueError(d.kind)


def rule_sql(r: Rule) -> str:
    c = ident(r.column)
    if r.kind == "positive":
        bad = f"{c} <= 0"
    elif r.kind == "non_negative":
        bad = f"{c} < 0"
    elif r.kind == "in_domain":
        bad = f"{c} NOT IN ({', '.join(lit(v) for v in r.values)})"
    elif r.kind == "interval_valid":
        lo, hi = ident(r.lower), ident(r.upper)
        bad = (f"{lo} IS NULL OR {hi} IS NULL OR {lo} < {r.lo_min} OR {hi} > {r.hi_max} "
               f"OR {lo} >= {hi}")
    elif r.kind == "custom":
        bad = r.sql
    else:
        raise ValueError(r.kind)
    return f"({c} IS NOT NULL AND ({bad}))"


def encounter_ctes(spec: FactSpec, dedupe: bool = True) -> str:
    """``WITH raw, nulled, typed, clean, curated0, curated`` for the restricted spec.

    ``dedupe=False`` makes ``clean`` the typed rows as they are.
    """
    nulled = ",\n  ".join(
        f"CASE WHEN trim({ident(c)}) = '?' THEN NULL ELSE {ident(c)} END AS {ident(c)}"
        for c in RAW_COLUMNS)
    typed = ",\n  ".join(f"{lenient_cast_sql(ident(f.name), f.dataType)} AS {ident(f.name)}"
                         for f in spec.schema.fields)
    keys = [ident(k) for k in spec.key]
    rest = [ident(c) for c in spec.columns if c not in spec.key]
    order = ", ".join(f"{c} ASC NULLS FIRST" for c in rest)
    cols = ", ".join(ident(c) for c in spec.columns)
    # curated0: trim strings + standardise + first-level derived (from standardised inputs)
    std = {s.column: s for s in spec.standardise}
    exprs = {}
    for f in spec.schema.fields:
        e = ident(f.name)
        if isinstance(f.dataType, T.StringType):
            e = f"trim({e})"
            if f.name in std:
                e = _std_sql(std[f.name], e)
        exprs[f.name] = e
    level1 = [d for d in spec.derived if d.source in exprs]
    level2 = [d for d in spec.derived if d.source not in exprs]
    c0 = [f"{exprs[c]} AS {ident(c)}" for c in spec.columns]
    c0 += [f"{_derived_sql(d, exprs[d.source])} AS {ident(d.name)}" for d in level1]
    c1 = [ident(c) for c in spec.columns] + [ident(d.name) for d in level1]
    c1 += [f"{_derived_sql(d, ident(d.source))} AS {ident(d.name)}" for d in level2]
    final = ", ".join(ident(c) for c in spec.curated_columns())
    dedupe_sql = (f"SELECT {cols} FROM (SELECT *, row_number() OVER (PARTITION BY "
                  f"{', '.join(keys)} ORDER BY {order}) AS _rn FROM typed) WHERE _rn = 1"
                  if dedupe else f"SELECT {cols} FROM typed")
    return f"""WITH raw AS ({raw_sql()}),
nulled AS (SELECT
  {nulled}
FROM raw),
typed AS (SELECT
  {typed}
FROM nulled),
clean AS ({dedupe_sql}),
curated0 AS (SELECT {", ".join(c0)} FROM clean),
curated AS (SELECT {final} FROM (SELECT {", ".join(c1)} FROM curated0))
"""


# --------------------------------------------------------------------------
# The full extract.  Everything below is written out rather than taken from the
# spec, so that a wrong type, domain or transform in the spec shows.
# --------------------------------------------------------------------------

_WHOLE = ("admission_type_id", "discharge_disposition_id", "admission_source_id", "time_in_hospital", "num_lab_procedures",
          "num_procedures", "num_medications", "number_outpatient", "number_emergency", "number_inpatient", "number_diagnoses")
WHOLE_NUMBERS = ("encounter_id", "patient_nbr", *_WHOLE)
_FULL_TYPES = {"encounter_id": T.LongType(), "patient_nbr": T.LongType(), **dict.fromkeys(_WHOLE, T.IntegerType())}
_FULL_STD = {
    "gender": "CASE lower({c}) WHEN 'male' THEN 'Male' WHEN 'female' THEN 'Female' END",
    "change": "CASE lower({c}) WHEN 'ch' THEN 'change' WHEN 'no' THEN 'no change' ELSE lower({c}) END",
    "max_glu_serum": "lower({c})", "A1Cresult": "lower({c})", "readmitted": "upper({c})",
    "diag_1": "replace({c}, '.', '')", "diag_2": "replace({c}, '.', '')", "diag_3": "replace({c}, '.', '')",
    **dict.fromkeys(("race", "diabetesMed", *MEDICATIONS), "{initcap}"),
}
_FULL_RULES = (
    ("time_in_hospital_positive", "time_in_hospital <= 0"),
    ("num_lab_procedures_non_negative", "num_lab_procedures < 0"),
    ("num_procedures_non_negative", "num_procedures < 0"),
    ("num_medications_non_negative", "num_medications < 0"),
    ("number_outpatient_non_negative", "number_outpatient < 0"),
    ("number_emergency_non_negative", "number_emergency < 0"),
    ("number_inpatient_non_negative", "number_inpatient < 0"),
    ("number_diagnoses_positive", "number_diagnoses <= 0"),
    ("age_valid_range", "age IS NOT NULL AND (age_lower IS NULL OR age_upper IS NULL OR age_lower < 0 OR age_upper > 120 OR age_lower >= age_upper)"),
    ("gender_valid_values", "gender NOT IN ('Male', 'Female')"),
    ("max_glu_serum_valid_values", "max_glu_serum NOT IN ('>200', '>300', 'norm', 'none')"),
    ("A1Cresult_valid_values", "\"A1Cresult\" NOT IN ('>8', '>7', 'norm', 'none')"),
    ("change_valid_values", "\"change\" NOT IN ('change', 'no change')"),
    ("diabetesMed_valid_values", "\"diabetesMed\" NOT IN ('Yes', 'No')"),
    ("readmitted_valid_values", "readmitted NOT IN ('<30', '>30', 'NO')"),
)


def full_ctes() -> str:
    """``raw, nulled, typed, clean, curated`` over all 50 columns."""
    every = list(ENCOUNTER_COLUMNS)
    nulled = ", ".join(f"CASE WHEN trim({ident(c)}) = '?' THEN NULL ELSE {ident(c)} END AS {ident(c)}" for c in every)
    typed = ", ".join(f"{lenient_cast_sql(ident(c), _FULL_TYPES.get(c, T.StringType()))} AS {ident(c)}" for c in every)
    cols = ", ".join(map(ident, every))
    order = ", ".join(f"{ident(c)} ASC NULLS FIRST" for c in every if c != "encounter_id")

    def shaped(c: str) -> str:
        if c in _FULL_TYPES:
            return ident(c)
        e = f"trim({ident(c)})"
        return f"{_FULL_STD.get(c, '{c}').format(c=e, initcap=initcap_sql(e))} AS {ident(c)}"

    bound = lambda pattern: f"TRY_CAST(NULLIF(regexp_extract(age, '{pattern}', 1), '') AS INTEGER)"
    lower, upper = bound("\\[(\\d+)-"), bound("-(\\d+)\\)")
    return f"""WITH raw AS ({raw_sql(every)}),
nulled AS (SELECT {nulled} FROM raw),
typed AS (SELECT {typed} FROM nulled),
clean AS (SELECT {cols} FROM (SELECT *, row_number() OVER (PARTITION BY encounter_id ORDER BY {order}) AS rn FROM typed) WHERE rn = 1),
shaped AS (SELECT {", ".join(shaped(c) for c in every)} FROM clean),
curated AS (
  SELECT {cols}, {lower} AS age_lower, {upper} AS age_upper,
         CASE WHEN {lower} < 18 THEN 'pediatric' WHEN {lower} < 65 THEN 'adult' ELSE 'senior' END AS age_group,
         CAST(CASE readmitted WHEN 'NO' THEN 0 WHEN '>30' THEN 1 WHEN '<30' THEN 2 END AS INTEGER) AS readmitted_flag
  FROM shaped)
"""


def full_rules_sql() -> str:
    """All 15 rules that are always reported, and those medications that have a value outside the domain."""
    count = lambda name, bad: f"SELECT '{name}' AS {ident('constraint')}, CAST(count_if({bad}) AS BIGINT) AS violations FROM curated"
    fixed = [count(n, bad) for n, bad in _FULL_RULES]
    drugs = [f"SELECT * FROM ({count(f'{m}_valid_values', f'{ident(m)} NOT IN ({chr(39)}Up{chr(39)}, {chr(39)}Down{chr(39)}, {chr(39)}Steady{chr(39)}, {chr(39)}No{chr(39)})')}) WHERE violations > 0"
             for m in MEDICATIONS]
    return full_ctes() + "\nUNION ALL\n".join(fixed + drugs)
