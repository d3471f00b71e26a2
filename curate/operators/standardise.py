"""Categorical standardisation and derived features (PRJ6, STD).

The whole transform is one projection: every output column is a composed
Column expression (trim -> standardise -> derive), so Catalyst sees a single
``Project`` instead of ~75 stacked ``withColumn`` nodes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curate.functions.text import string_columns
from curate.operators.cleaning import q
from curate.spec import FactSpec


def standardised_exprs(df: DataFrame, spec: FactSpec) -> dict[str, Column]:
    """Output expression per column of ``df`` plus the spec's derived columns."""
    exprs: dict[str, Column] = {c: q(c) for c in df.columns}
    for c in string_columns(df):
        exprs[c] = F.trim(q(c))
    for s in spec.standardise:
        if s.column in exprs:
            exprs[s.column] = s.apply(exprs[s.column])
    for d in spec.derived:
        if d.source in exprs:
            exprs[d.name] = d.apply(exprs).cast(T._parse_datatype_string(d.data_type))
    return exprs


def curate(df: DataFrame, spec: FactSpec) -> DataFrame:
    """Trim all strings, standardise the spec's columns, append derived columns."""
    exprs = standardised_exprs(df, spec)
    derived = [d.name for d in spec.derived if d.name in exprs and d.name not in df.columns]
    return df.select([exprs[c].alias(c) for c in df.columns + derived])
