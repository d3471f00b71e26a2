"""Numeric helpers (MTH1, MTH2)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def pct(n: Column | str, total: Column | str, scale: int = 2) -> Column:
    """``round(100 * n / total, scale)`` with half-up rounding; ``total = 0`` -> null.

    ``100 * n`` stays integral and the single division is correctly rounded,
    so the half-up step agrees with exact rational rounding.
    """
    return F.round(F.try_divide(F.lit(100) * _as_col(n), _as_col(total)), scale)
