"""Single-pass metric frames.

Profiling questions of the form "how many rows satisfy predicate *p_i*, for
each of k predicates" are answered with **one** aggregation holding k
``count_if`` expressions (partial aggregation on every task, one tiny final
merge), then turned into k rows with ``inline`` -- instead of k filtered
counts, i.e. k scans.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def counts_long(df: DataFrame, named: Sequence[tuple[str, Column]], name_col: str = "name",
                value_col: str = "value", total_col: str | None = "total",
                ordinal_col: str | None = None) -> DataFrame:
    """Rows ``(name, value[, total][, ordinal])``: ``value = count_if(predicate)``.

    ``total`` is ``count(*)`` of ``df``; ``ordinal`` is the predicate's position.
    """
    aggs = [F.count_if(pred).alias(f"_m{i}") for i, (_, pred) in enumerate(named)]
    wide = df.agg(F.count(F.lit(1)).alias("_total"), *aggs)
    return explode_wide(wide, [(n, f"_m{i}") for i, (n, _) in enumerate(named)], name_col,
                        value_col, total_col, ordinal_col)


# --------------------------------------------------------------------------
# Which predicates hold together
# --------------------------------------------------------------------------

BITS_PER_MASK = 62


def mask_histogram(df: DataFrame, named: Sequence[tuple[str, Column]]) -> DataFrame:
    """``_mask0[, _mask1...], _rows``: rows by the set of predicates that hold for them.

    Bit ``i % 62`` of mask ``i // 62`` stands for predicate ``i``.  Rows are folded per
    task before the shuffle; there are as many groups as combinations that occur.
    """
    masks = []
    for lo in range(0, max(len(named), 1), BITS_PER_MASK):
        bits = [F.when(pred, F.lit(1 << i)).otherwise(F.lit(0)).cast("long")
                for i, (_, pred) in enumerate(named[lo:lo + BITS_PER_MASK])]
        mask = F.lit(0).cast("long")
        for b in bits:
            mask = mask.bitwiseOR(b)
        masks.append(mask.alias(f"_mask{len(masks)}"))
    flat = df.select(*masks)
    return flat.groupBy(*flat.columns).agg(F.count(F.lit(1)).alias("_rows"))


def _holds(i: int) -> Column:
    return F.getbit(F.col(f"_mask{i // BITS_PER_MASK}"), F.lit(i % BITS_PER_MASK)) == 1


def counts_from_masks(histogram: DataFrame, names: Sequence[str], name_col: str = "name",
                      value_col: str = "value") -> DataFrame:
    """Per predicate the number of rows for which it holds (as :func:`counts_long` without a total)."""
    wide = histogram.agg(F.lit(0).alias("_total"), *[
        F.coalesce(F.sum(F.when(_holds(i), F.col("_rows"))), F.lit(0)).alias(f"_m{i}") for i in range(len(names))])
    return explode_wide(wide, [(n, f"_m{i}") for i, n in enumerate(names)], name_col, value_col, None)


def patterns(histogram: DataFrame, names: Sequence[str], pattern_col: str = "pattern",
             value_col: str = "rows") -> DataFrame:
    """``pattern, <value_col>``: the names that hold together (in order, comma-joined; ``""``: none)."""
    held = F.array_compact(F.array(*[F.when(_holds(i), F.lit(n)) for i, n in enumerate(names)])) if names else F.array().cast("array<string>")
    return histogram.select(F.array_join(held, ",").alias(pattern_col), F.col("_rows").alias(value_col))


def explode_wide(wide: DataFrame, names: Sequence[tuple[str, str]], name_col: str,
                 value_col: str, total_col: str | None = "total",
                 ordinal_col: str | None = None) -> DataFrame:
    """Turn a one-row frame of metric columns into one row per ``(label, column)``."""
    if not names:
        fields = [F.lit(None).cast("string").alias(name_col), F.lit(None).cast("long").alias(value_col)]
        if ordinal_col:
            fields.append(F.lit(None).cast("int").alias(ordinal_col))
        out = wide.select(F.inline(F.array(F.struct(*fields))), F.col("_total"))
        out = out.where(F.lit(False))
    else:
        structs = []
        for i, (label, col) in enumerate(names):
            fields = [F.lit(label).alias(name_col), F.col(col).cast("long").alias(value_col)]
            if ordinal_col:
                fields.append(F.lit(i).alias(ordinal_col))
            structs.append(F.struct(*fields))
        out = wide.select(F.inline(F.array(*structs)), F.col("_total"))
    if total_col:
        return out.withColumnRenamed("_total", total_col)
    return out.drop("_total")
