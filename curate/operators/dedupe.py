"""Deterministic de-duplication on a key (AGG4).

``dropDuplicates`` keeps an *arbitrary* row per key, so a re-executed stage
may keep a different one than was saved or profiled.  Here the kept row is
the smallest by (order columns, then every other column) ascending with nulls
first.  Null keys form one group, as with ``dropDuplicates``.

Finding the smallest row of *every* key means that all columns of all rows are
shuffled and sorted, though few keys repeat.  :func:`dedupe` therefore looks at
the keys first: one hash aggregation over the key columns alone gives the keys
that occur more than once, which are written to the checkpoint folder with their
number, rows and bytes observed on the way.  If they are few, they are broadcast: rows
of all other keys pass through where they stand (anti join), and only the rows of repeated
keys (semi join) are compared.  If they exceed the byte bound, or their rows are more than
a quarter of all, reading the rows twice no longer pays and every row is compared.

The comparison is a grouped ``min(struct(...))``: it is partial on every map
task, so a hot key holding a third of all rows is folded to one row per task
*before* the shuffle and no task receives the whole group.  It can also carry
per-key sums (rows folded, row-level metric flags) through the shuffle, which
the single-pass silver flow relies on (:func:`dedupe_grouped`).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curate.operators.cleaning import q
from curate.session import checkpoint_dir

# Bytes of repeated keys up to which they are broadcast.
DEFAULT_BROADCAST_MAX_BYTES = 64 << 20
# Share of all rows that rows of repeated keys may have for the two-pass plan.
DEFAULT_MAX_SHARE = 0.25

ROW = "_row"
COUNT = "_dup_n"


def _value_order(df: DataFrame, keys: Sequence[str], order: Sequence[str] | None) -> list[str]:
    rest = [c for c in df.columns if c not in keys]
    if not order:
        return rest
    return list(order) + [c for c in rest if c not in order]


def dedupe_grouped(df: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None,
                   carry: Sequence[str] = ()) -> DataFrame:
    """Deduplicated rows plus ``_dup_n`` (rows folded into each kept row).

    ``carry`` names numeric per-row columns (e.g. metric flags) that are left
    out of the kept row and instead summed over each key group in the same
    aggregation -- row-level metrics survive the shuffle without a second scan.
    """
    keys = list(keys)
    data = df.select(*[q(c) for c in df.columns if c not in carry])
    value_cols = _value_order(data, keys, order)
    aggs = [F.count(F.lit(1)).alias(COUNT)]
    if value_cols:
        aggs.append(F.min(F.struct(*[q(c).alias(c) for c in value_cols])).alias(ROW))
    aggs += [F.sum(q(c).cast("long")).alias(c) for c in carry]
    grouped = df.groupBy(*[q(k) for k in keys]).agg(*aggs)
    out = [q(c) if c in keys else F.col(ROW)[c].alias(c) for c in data.columns]
    return grouped.select(*out, F.col(COUNT), *[q(c) for c in carry])


def _key_bytes(df: DataFrame, keys: Sequence[str]) -> Column:
    """Bytes a key takes in memory: 8 a fixed-width value, the length of any other as text, 16 a row."""
    size = F.lit(16).cast("long")
    for k in keys:
        fixed = isinstance(df.schema[k].dataType, (T.NumericType, T.DateType, T.TimestampType,
                                                   T.TimestampNTZType, T.BooleanType))
        size = size + (F.lit(8) if fixed else F.lit(8) + F.coalesce(
            F.octet_length(q(k).cast("string")), F.lit(0)))
    return size


@dataclass(frozen=True)
class RepeatedKeys:
    """Keys that more than one row has (columns ``_k0, _k1, ...``), and what was observed of them."""

    keys: DataFrame
    n_keys: int
    n_bytes: int
    n_rows: int              # rows of repeated keys
    total_rows: int


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> RepeatedKeys:
    """The repeated keys of ``df``, reading its key columns only.

    They are checkpointed, so they are computed once and survive lost executors.
    """
    checkpoint_dir(df.sparkSession)
    every, seen = Observation(), Observation()
    counts = (df.groupBy(*[q(k) for k in keys]).agg(F.count(F.lit(1)).alias(COUNT))
              .observe(every, F.sum(COUNT).alias("rows")))
    found = (counts.where(F.col(COUNT) > 1)
             .observe(seen, F.count(F.lit(1)).alias("n"), F.sum(COUNT).alias("rows"),
                      F.sum(_key_bytes(df, keys)).alias("bytes"))
             .select(*[q(k).alias(f"_k{i}") for i, k in enumerate(keys)])
             .checkpoint())
    got = seen.get
    return RepeatedKeys(found, int(got["n"] or 0), int(got["bytes"] or 0), int(got["rows"] or 0),
                        int(every.get["rows"] or 0))


def dedupe(df: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None,
           broadcast_max_bytes: int = DEFAULT_BROADCAST_MAX_BYTES,
           max_share: float = DEFAULT_MAX_SHARE, one_pass: bool = False) -> DataFrame:
    """One row per distinct key (nulls are one key), chosen deterministically.

    Runs one job over the key columns when called; ``df`` must give the same rows
    each time it is computed.  ``one_pass`` compares every row instead, so that ``df`` is
    computed once: for aggregates over all columns, whose rows go no further.
    """
    if one_pass:
        return dedupe_grouped(df, keys, order).drop(COUNT)
    repeated = repeated_keys(df, keys)
    if repeated.n_keys == 0:
        return df
    if repeated.n_bytes > broadcast_max_bytes or repeated.n_rows > max_share * repeated.total_rows:
        return dedupe_grouped(df, keys, order).drop(COUNT)
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & q(k).eqNullSafe(F.col(f"_k{i}"))
    side = F.broadcast(repeated.keys)
    once = df.join(side, same, "left_anti")
    folded = dedupe_grouped(df.join(side, same, "left_semi"), keys, order).drop(COUNT)
    return once.unionAll(folded)


def dedupe_stats(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: ``rows_before, rows_after, duplicates_removed``."""
    per_key = df.groupBy(*[q(k) for k in keys]).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("rows_before"),
        F.count(F.lit(1)).alias("rows_after"),
    ).select("rows_before", "rows_after",
             (F.col("rows_before") - F.col("rows_after")).alias("duplicates_removed"))
