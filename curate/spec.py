"""Declarative table specifications.

A :class:`FactSpec` carries everything the curation flow needs to know about
one fact table -- hard schema, primary key, sentinel, standardisations,
derived columns, business rules, foreign keys and the summary definitions --
as *data*.  Operators take a spec (or pieces of it) and never hard-code
column names.  :data:`ENCOUNTERS` is the hospital-encounter specification;
``FactSpec.restrict`` narrows it to whatever columns an input really has.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curate.functions.conditional import LOWER, bucket, canonical, ordinal
from curate.functions.text import interval_bounds, strip_chars

# --------------------------------------------------------------------------
# Column transforms (standardisation) and derived columns
# --------------------------------------------------------------------------


@dataclass(frozen=True)
class Std:
    """Overwrite ``column`` with ``kind`` applied to its (trimmed) value.

    kinds: ``lower``, ``upper``, ``initcap``, ``canonical`` (params: mapping,
    other), ``strip`` (params: chars).
    """

    column: str
    kind: str
    mapping: tuple[tuple[str, str], ...] = ()
    other: object = None
    chars: str = ""

    def apply(self, c: Column) -> Column:
        if self.kind == "lower":
            return F.lower(c)
        if self.kind == "upper":
            return F.upper(c)
        if self.kind == "initcap":
            return F.initcap(c)
        if self.kind == "canonical":
            return canonical(c, dict(self.mapping), self.other)
        if self.kind == "strip":
            return strip_chars(c, self.chars)
        raise ValueError(f"unknown standardisation kind {self.kind!r}")


@dataclass(frozen=True)
class Derived:
    """New column computed from earlier (standardised or derived) columns.

    kinds: ``interval_lower`` / ``interval_upper`` (source ``"[lo-hi)"``),
    ``bucket`` (bounds, otherwise), ``ordinal`` (codes).
    """

    name: str
    kind: str
    source: str
    data_type: str = "int"
    bounds: tuple[tuple[float, str], ...] = ()
    otherwise: str = ""
    codes: tuple[tuple[str, int], ...] = ()

    def apply(self, exprs: Mapping[str, Column]) -> Column:
        src = exprs[self.source]
        if self.kind == "interval_lower":
            return interval_bounds(src)[0]
        if self.kind == "interval_upper":
            return interval_bounds(src)[1]
        if self.kind == "bucket":
            return bucket(src, self.bounds, self.otherwise)
        if self.kind == "ordinal":
            return ordinal(src, dict(self.codes))
        raise ValueError(f"unknown derived kind {self.kind!r}")


# --------------------------------------------------------------------------
# Business rules
# --------------------------------------------------------------------------


@dataclass(frozen=True)
class Rule:
    """A constraint; :meth:`violated` is true for offending rows.

    A null ``column`` is never a violation.  kinds: ``positive`` (<= 0
    violates), ``non_negative`` (< 0), ``in_domain`` (not in ``values``),
    ``interval_valid`` (``lower``/``upper`` columns must parse and satisfy
    ``lo_min <= lower < upper <= hi_max``), ``custom`` (``sql`` is the
    violation predicate).  ``report_zero=False`` rules are listed only when
    they fire.
    """

    name: str
    kind: str
    column: str
    values: tuple[str, ...] = ()
    lower: str = ""
    upper: str = ""
    lo_min: int = 0
    hi_max: int = 0
    sql: str = ""
    report_zero: bool = True

    def inputs(self) -> set[str]:
        cols = {self.column}
        if self.kind == "interval_valid":
            cols |= {self.lower, self.upper}
        return cols

    def violated(self) -> Column:
        c = F.col(f"`{self.column}`")
        if self.kind == "positive":
            bad = c <= 0
        elif self.kind == "non_negative":
            bad = c < 0
        elif self.kind == "in_domain":
            bad = ~c.isin(list(self.values))
        elif self.kind == "interval_valid":
            lo, hi = F.col(f"`{self.lower}`"), F.col(f"`{self.upper}`")
            bad = (lo.isNull() | hi.isNull() | (lo < self.lo_min) | (hi > self.hi_max) | (lo >= hi))
        elif self.kind == "custom":
            bad = F.expr(self.sql)
        else:
            raise ValueError(f"unknown rule kind {self.kind!r}")
        return c.isNotNull() & bad


def positive(col: str) -> Rule:
    return Rule(f"{col}_positive", "positive", col)


def non_negative(col: str) -> Rule:
    return Rule(f"{col}_non_negative", "non_negative", col)


def in_domain(col: str, values: Iterable[str], report_zero: bool = True) -> Rule:
    return Rule(f"{col}_valid_values", "in_domain", col, values=tuple(values),
                report_zero=report_zero)


# --------------------------------------------------------------------------
# Dimensions, foreign keys, summaries, the fact spec
# --------------------------------------------------------------------------


@dataclass(frozen=True)
class DimSpec:
    """A dimension parsed from a sectioned mapping file.

    The section whose header contains ``keyword`` (case-insensitive) feeds
    table ``table``; ``id_col`` / ``name_col`` are looked up by header name
    and renamed to ``id_col`` / ``out_name``.
    """

    keyword: str
    table: str
    id_col: str
    out_name: str
    name_col: str = "description"


@dataclass(frozen=True)
class FkSpec:
    fk: str
    dim_table: str
    dim_id: str
    optional: bool = False     # checked only where the dimension exists


@dataclass(frozen=True)
class SummarySpec:
    share_group: str = "age_group"
    share_by: str = "readmitted"
    top_key: str = "diag_1"
    top_distinct: str = "patient_nbr"
    top_k: int = 10
    mean_by: tuple[str, ...] = ("age_group", "gender")
    mean_value: str = "time_in_hospital"
    mean_distinct: str = "patient_nbr"


@dataclass(frozen=True)
class FactSpec:
    name: str
    schema: T.StructType
    key: tuple[str, ...]
    sentinel: str = "?"
    standardise: tuple[Std, ...] = ()
    derived: tuple[Derived, ...] = ()
    rules: tuple[Rule, ...] = ()
    fks: tuple[FkSpec, ...] = ()
    summary: SummarySpec = field(default_factory=SummarySpec)

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.schema.fields]

    def integral_fields(self) -> list[T.StructField]:
        return [f for f in self.schema.fields
                if isinstance(f.dataType, (T.IntegerType, T.LongType, T.ShortType, T.ByteType))]

    def curated_columns(self) -> list[str]:
        return self.columns + [d.name for d in self.derived]

    def restrict(self, present: Iterable[str]) -> FactSpec:
        """Keep only schema fields in ``present`` and everything that can still be computed."""
        have = set(present)
        schema = T.StructType([f for f in self.schema.fields if f.name in have])
        cols = {f.name for f in schema.fields}
        std = tuple(s for s in self.standardise if s.column in cols)
        derived = []
        avail = set(cols)
        for d in self.derived:
            if d.source in avail:
                derived.append(d)
                avail.add(d.name)
        rules = tuple(r for r in self.rules if r.inputs() <= avail)
        fks = tuple(k for k in self.fks if k.fk in cols)
        return replace(self, schema=schema, standardise=std, derived=tuple(derived),
                       rules=rules, fks=fks)


# ==========================================================================
# The hospital-encounter specification.  These must equal the
# source project's definitions for results to match; they are data, listed
# in their natural order.
# ==========================================================================

_BIGINT = ("encounter_id", "patient_nbr")
_INT = ("admission_type_id", "discharge_disposition_id", "admission_source_id",
        "time_in_hospital", "num_lab_procedures", "num_procedures", "num_medications",
        "number_outpatient", "number_emergency", "number_inpatient", "number_diagnoses")

MEDICATIONS = (
    "metformin", "repaglinide", "nateglinide", "chlorpropamide", "glimepiride",
    "acetohexamide", "glipizide", "glyburide", "tolbutamide", "pioglitazone",
    "rosiglitazone", "acarbose", "miglitol", "troglitazone", "tolazamide",
    "examide", "citoglipton", "insulin", "glyburide-metformin",
    "glipizide-metformin", "glimepiride-pioglitazone", "metformin-rosiglitazone",
    "metformin-pioglitazone",
)

ENCOUNTER_COLUMNS = (
    "encounter_id", "patient_nbr", "race", "gender", "age", "weight",
    "admission_type_id", "discharge_disposition_id", "admission_source_id", "time_in_hospital",
    "payer_code", "medical_specialty",
    "num_lab_procedures", "num_procedures", "num_medications",
    "number_outpatient", "number_emergency", "number_inpatient",
    "diag_1", "diag_2", "diag_3",
    "number_diagnoses",
    "max_glu_serum", "A1Cresult",
    *MEDICATIONS,
    "change", "diabetesMed", "readmitted",
)

GENDER_MAP = (("male", "Male"), ("female", "Female"))
CHANGE_MAP = (("ch", "change"), ("no", "no change"))
AGE_GROUPS = ((18, "pediatric"), (65, "adult"))
AGE_GROUP_ELSE = "senior"
READMITTED_CODES = (("NO", 0), (">30", 1), ("<30", 2))

GENDER_DOMAIN = ("Male", "Female")
MAX_GLU_SERUM_DOMAIN = (">200", ">300", "norm", "none")
A1C_DOMAIN = (">8", ">7", "norm", "none")
MEDICATION_DOMAIN = ("Up", "Down", "Steady", "No")
CHANGE_DOMAIN = ("change", "no change")
DIABETES_MED_DOMAIN = ("Yes", "No")
READMITTED_DOMAIN = ("<30", ">30", "NO")
AGE_MIN, AGE_MAX = 0, 120

DIMENSIONS = (
    DimSpec("admission_type_id", "dim_admission_type", "admission_type_id", "admission_type_name"),
    DimSpec("discharge_disposition_id", "dim_discharge_disposition", "discharge_disposition_id",
            "discharge_disposition_name"),
    DimSpec("admission_source_id", "dim_admission_source", "admission_source_id",
            "admission_source_name"),
)

# ==========================================================================


def _type_of(col: str) -> T.DataType:
    if col in _BIGINT:
        return T.LongType()
    if col in _INT:
        return T.IntegerType()
    return T.StringType()


ENCOUNTER_SCHEMA = T.StructType([T.StructField(c, _type_of(c), True) for c in ENCOUNTER_COLUMNS])

ENCOUNTER_STANDARDISE = (
    Std("gender", "canonical", mapping=GENDER_MAP, other=None),
    Std("race", "initcap"),
    Std("max_glu_serum", "lower"),
    Std("A1Cresult", "lower"),
    *[Std(m, "initcap") for m in MEDICATIONS],
    Std("change", "canonical", mapping=CHANGE_MAP, other=LOWER),
    Std("diabetesMed", "initcap"),
    Std("readmitted", "upper"),
    Std("diag_1", "strip", chars="."),
    Std("diag_2", "strip", chars="."),
    Std("diag_3", "strip", chars="."),
)

ENCOUNTER_DERIVED = (
    Derived("age_lower", "interval_lower", "age"),
    Derived("age_upper", "interval_upper", "age"),
    Derived("age_group", "bucket", "age_lower", data_type="string",
            bounds=AGE_GROUPS, otherwise=AGE_GROUP_ELSE),
    Derived("readmitted_flag", "ordinal", "readmitted", codes=READMITTED_CODES),
)

ENCOUNTER_RULES = (
    positive("time_in_hospital"),
    non_negative("num_lab_procedures"),
    non_negative("num_procedures"),
    non_negative("num_medications"),
    non_negative("number_outpatient"),
    non_negative("number_emergency"),
    non_negative("number_inpatient"),
    positive("number_diagnoses"),
    Rule("age_valid_range", "interval_valid", "age", lower="age_lower", upper="age_upper",
         lo_min=AGE_MIN, hi_max=AGE_MAX),
    in_domain("gender", GENDER_DOMAIN),
    in_domain("max_glu_serum", MAX_GLU_SERUM_DOMAIN),
    in_domain("A1Cresult", A1C_DOMAIN),
    *[in_domain(m, MEDICATION_DOMAIN, report_zero=False) for m in MEDICATIONS],
    in_domain("change", CHANGE_DOMAIN),
    in_domain("diabetesMed", DIABETES_MED_DOMAIN),
    in_domain("readmitted", READMITTED_DOMAIN),
)

ENCOUNTER_FKS = tuple(FkSpec(d.id_col, d.table, d.id_col) for d in DIMENSIONS)

ENCOUNTERS = FactSpec(
    name="diabetic_encounters",
    schema=ENCOUNTER_SCHEMA,
    key=("encounter_id",),
    sentinel="?",
    standardise=ENCOUNTER_STANDARDISE,
    derived=ENCOUNTER_DERIVED,
    rules=ENCOUNTER_RULES,
    fks=ENCOUNTER_FKS,
)
