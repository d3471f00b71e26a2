"""Sentinel nulling, hard-schema casting and cast-failure profiling.

PRJ1 ``nullify``, PRJ2 ``apply_schema``, PRJ4 ``with_null``, PRJ5
``cols_of``, AGG3 ``cast_profile``.  Each is a single projection or a single
aggregation -- no per-column passes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curate.functions.casting import INTEGRAL_TYPES, cast_failed, lenient_cast_expr
from curate.functions.numeric import pct
from curate.operators.metrics import counts_long


def q(name: str) -> Column:
    """Column by exact name (names may contain ``-`` or ``.``)."""
    return F.col(f"`{name}`")


def quoted(name: str) -> str:
    """An exact column name in SQL text."""
    return "`" + name.replace("`", "``") + "`"


def sql_string(value: str) -> str:
    """A string literal in SQL text."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def nullify(df: DataFrame, sentinel: str = "?", cols: list[str] | None = None) -> DataFrame:
    """Replace values equal to ``sentinel`` after trimming spaces with null, in one projection."""
    string_cols = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    targets = string_cols if cols is None else set(cols) & string_cols
    # as SQL text: one call for all columns (a call per function costs more than the query on wide tables)
    mark = sql_string(sentinel)
    return df.selectExpr(*[
        f"CASE WHEN trim({name}) = {mark} THEN NULL ELSE {name} END AS {name}" if c in targets else name
        for c, name in ((c, quoted(c)) for c in df.columns)
    ])


def with_null(df: DataFrame, name: str, data_type: str = "string") -> DataFrame:
    """Add a constant-null column if it is not already there."""
    if name in df.columns:
        return df
    return df.withColumn(name, F.lit(None).cast(data_type))


def cols_of(df: DataFrame, *types: type) -> list[str]:
    """Column names whose type is an instance of any of ``types``."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, types)]


def apply_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast, order and prune to ``schema``; failed casts become null.

    A column named in ``schema`` but missing from ``df`` is an analysis error.
    """
    return df.selectExpr(*[f"{lenient_cast_expr(quoted(f.name), f.dataType)} AS {quoted(f.name)}"
                           for f in schema.fields])


def schema_matches(df: DataFrame, schema: T.StructType) -> bool:
    """Names, order and types equal (nullability ignored)."""
    a = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    b = [(f.name, f.dataType.simpleString()) for f in schema.fields]
    return a == b


def cast_failure_predicates(schema: T.StructType) -> list[tuple[T.StructField, Column]]:
    """``(field, failed?)`` for every integral field of ``schema``."""
    return [(f, cast_failed(q(f.name), f.dataType))
            for f in schema.fields if isinstance(f.dataType, INTEGRAL_TYPES)]


def cast_profile(df: DataFrame, schema: T.StructType, only_failures: bool = True) -> DataFrame:
    """Per integral column: ``column, target_type, failed_rows, failure_rate_pct``.

    ``df`` is the all-string frame *after* sentinel nulling; a failure is a
    non-null value that does not cast.  One aggregation for all columns.
    """
    preds = cast_failure_predicates(schema)
    types = {f.name: f.dataType.simpleString() for f, _ in preds}
    long = counts_long(df, [(f.name, p) for f, p in preds], "column", "failed_rows")
    type_col = F.lit(None).cast("string")
    for name, t in types.items():
        type_col = F.when(F.col("column") == name, F.lit(t)).otherwise(type_col)
    out = long.select(
        "column",
        type_col.alias("target_type"),
        "failed_rows",
        pct(F.col("failed_rows"), F.col("total")).alias("failure_rate_pct"),
    )
    return out.where(F.col("failed_rows") > 0) if only_failures else out
