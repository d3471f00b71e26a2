"""Value-mapping column functions (CND1-CND4), built as ``CASE WHEN`` chains."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Sentinel for ``canonical(..., other=LOWER)``: fall back to the lower-cased input.
LOWER = "__lower__"


def _as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def canonical(c: Column | str, mapping: Mapping[str, str], other: object = None) -> Column:
    """Map ``lower(c)`` through ``mapping``.

    ``other`` decides unmatched values: ``None`` -> null (CND1),
    :data:`LOWER` -> lower-cased input (CND2), any other literal -> that literal.
    """
    col = _as_col(c)
    key = F.lower(col)
    expr = None
    for k, v in mapping.items():
        expr = (F.when(key == k.lower(), F.lit(v)) if expr is None
                else expr.when(key == k.lower(), F.lit(v)))
    if other is None:
        fallback = F.lit(None).cast("string")
    elif other == LOWER:
        fallback = key
    else:
        fallback = F.lit(other)
    return fallback if expr is None else expr.otherwise(fallback)


def bucket(c: Column | str, bounds: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """First label whose exclusive upper bound exceeds ``c``; else ``otherwise`` (CND3).

    A null input matches no bound and therefore gets ``otherwise``.
    """
    col = _as_col(c)
    expr = None
    for upper, label in bounds:
        expr = (F.when(col < upper, F.lit(label)) if expr is None
                else expr.when(col < upper, F.lit(label)))
    return F.lit(otherwise) if expr is None else expr.otherwise(F.lit(otherwise))


def ordinal(c: Column | str, codes: Mapping[str, int]) -> Column:
    """Exact-match code table; unmatched or null -> null (CND4)."""
    col = _as_col(c)
    expr = None
    for k, v in codes.items():
        expr = (F.when(col == k, F.lit(v)) if expr is None else expr.when(col == k, F.lit(v)))
    return F.lit(None).cast("int") if expr is None else expr.otherwise(F.lit(None).cast("int"))
