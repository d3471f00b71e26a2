"""Id sets as bitmaps: referential integrity and exact distinct counts (JN1, JN2, SET2, AGG2, AGG9).

A set of integral ids is kept as one 4 KB bitmap for each run of 32,768 neighbouring
ids, built by a hash aggregation (partial on every task).  Dense surrogate keys take
one bit each: 10^9 ids are 125 MB, which every task can hold, where a hashed relation
would take tens of GB and a join would shuffle the fact.  Bitmaps of parts of the
data merge into those of the whole with a bitwise or, so distinct counts can be kept
per run and folded later.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curate.operators.cleaning import q
from curate.operators.metrics import counts_long

#: Bytes of a bitmap row, and of a set of them up to which it is broadcast.
ROW_BYTES = 4096 + 32
DEFAULT_BITMAP_MAX_BYTES = 256 << 20

BUCKET, BITS = "_bucket", "_bits"
INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def is_integral(df: DataFrame, col: str) -> bool:
    return isinstance(df.schema[col].dataType, INTEGRAL)


def bucket_of(c: Column) -> Column:
    return F.bitmap_bucket_number(c.cast("bigint"))


def bit_of(c: Column) -> Column:
    return F.bitmap_bit_position(c.cast("bigint"))


def id_bitmaps(df: DataFrame, id_col: str, by: Sequence[str] = ()) -> DataFrame:
    """``[by...,] _bucket, _bits`` of the non-null ids of an integral column."""
    ids = df.where(q(id_col).isNotNull())
    return (ids.groupBy(*[q(b) for b in by], bucket_of(q(id_col)).alias(BUCKET))
            .agg(F.bitmap_construct_agg(bit_of(q(id_col))).alias(BITS)))


def bitmap_sizes(sets: dict[str, DataFrame]) -> dict[str, tuple[int, int]]:
    """``{name: (ids, bytes)}`` of bitmap frames, in one job."""
    if not sets:
        return {}
    parts = [s.select(F.lit(name).alias("_set"), F.bitmap_count(BITS).alias("n")) for name, s in sets.items()]
    rows = reduce(DataFrame.unionAll, parts).groupBy("_set").agg(
        F.sum("n").alias("ids"), F.count(F.lit(1)).alias("rows")).collect()
    out = dict.fromkeys(sets, (0, 0))
    out.update({r["_set"]: (int(r["ids"]), int(r["rows"]) * ROW_BYTES) for r in rows})
    return out


def bit_set(bits: Column, position: Column) -> Column:
    """Is the bit at ``position`` set?  False for a null bitmap."""
    byte = F.conv(F.hex(F.substring(bits, F.floor(position / 8).cast("int") + 1, F.lit(1))), 16, 10)
    return F.coalesce(F.getbit(byte.cast("int"), F.pmod(position, F.lit(8)).cast("int")) == 1, F.lit(False))


def with_membership(fact: DataFrame, fk: str, bitmaps: DataFrame, hit_col: str, broadcast: bool = True) -> DataFrame:
    """Add ``hit_col``: true where ``fact[fk]`` is in the set, else null (also for a null key)."""
    side = bitmaps.select(F.col(BUCKET).alias(f"{hit_col}__b"), F.col(BITS).alias(f"{hit_col}__bits"))
    joined = fact.join(F.broadcast(side) if broadcast else side, bucket_of(q(fk)) == F.col(f"{hit_col}__b"), "left")
    hit = F.when(bit_set(F.col(f"{hit_col}__bits"), bit_of(q(fk))), F.lit(True))
    return joined.withColumn(hit_col, hit).drop(f"{hit_col}__b", f"{hit_col}__bits")


def fk_check_bitmaps(fact: DataFrame, fks: Sequence[tuple[str, DataFrame, str]],
                     max_bytes: int = DEFAULT_BITMAP_MAX_BYTES,
                     persisted: list[DataFrame] | None = None) -> DataFrame:
    """Per foreign key: ``fk, valid_dim_values, orphaned_fact_rows``, for integral keys.

    Sets within ``max_bytes`` are broadcast and all checked in the fact's one scan; for a
    larger one the fact is reduced to its distinct values first, which then meet
    the bitmaps by bucket.  A null key is never an orphan; an empty dimension orphans
    every other.  The bitmaps are persisted: pass ``persisted`` to release them
    after the result was used.
    """
    sets = {fk: id_bitmaps(dim, col).persist(StorageLevel.MEMORY_AND_DISK) for fk, dim, col in fks}
    if persisted is not None:
        persisted.extend(sets.values())
    sizes = bitmap_sizes(sets)
    fact = fact.select(*[q(fk) for fk, _, _ in fks])
    small = [fk for fk in sets if sizes[fk][1] <= max_bytes]
    parts = []
    if small:
        flagged, orphan = fact, []
        for i, fk in enumerate(small):
            flagged = with_membership(flagged, fk, sets[fk], f"_hit{i}")
            orphan.append((fk, q(fk).isNotNull() & F.col(f"_hit{i}").isNull()))
        parts.append(counts_long(flagged, orphan, "fk", "orphaned_fact_rows", total_col=None))
    for fk in sets:
        if fk not in small:
            values = fact.where(q(fk).isNotNull()).groupBy(q(fk)).agg(F.count(F.lit(1)).alias("_rows"))
            missing = with_membership(values, fk, sets[fk], "_hit", broadcast=False).where(F.col("_hit").isNull())
            parts.append(missing.agg(F.coalesce(F.sum("_rows"), F.lit(0)).cast("long").alias("orphaned_fact_rows"))
                         .select(F.lit(fk).alias("fk"), "orphaned_fact_rows"))
    valid = F.lit(None).cast("long")
    for fk, (n, _) in sizes.items():
        valid = F.when(F.col("fk") == fk, F.lit(n).cast("long")).otherwise(valid)
    return reduce(DataFrame.unionByName, parts).select("fk", valid.alias("valid_dim_values"), "orphaned_fact_rows")


def orphans_bitmaps(fact: DataFrame, fk: str, dim: DataFrame, id_col: str,
                    max_bytes: int = DEFAULT_BITMAP_MAX_BYTES,
                    persisted: list[DataFrame] | None = None) -> DataFrame:
    """Fact rows whose non-null integral key is not in ``dim[id_col]``.

    Within ``max_bytes`` the bitmaps are broadcast and the fact is not shuffled; beyond, it
    meets them by bucket.
    """
    bitmaps = id_bitmaps(dim, id_col).persist(StorageLevel.MEMORY_AND_DISK)
    if persisted is not None:
        persisted.append(bitmaps)
    fits = bitmap_sizes({fk: bitmaps})[fk][1] <= max_bytes
    flagged = with_membership(fact.where(q(fk).isNotNull()), fk, bitmaps, "_hit", broadcast=fits)
    return flagged.where(F.col("_hit").isNull()).drop("_hit")


# --------------------------------------------------------------------------
# Exact distinct counts that can be merged
# --------------------------------------------------------------------------

ROWS = "_rows"


def distinct_partials(df: DataFrame, by: Sequence[str], of: str) -> DataFrame:
    """``by..., _bucket, _bits, _rows``: what a part of the data adds to ``count(*)`` and
    ``count(distinct of)`` per group; rows with a null ``of`` stand in a null bucket.

    For ids that lie densely within groups (a group with few, scattered ids takes 4 KB for
    each of them: count those with ``count_distinct``).
    """
    id_ = q(of)
    return df.groupBy(*[q(b) for b in by], bucket_of(id_).alias(BUCKET)).agg(
        F.bitmap_construct_agg(bit_of(id_)).alias(BITS), F.count(F.lit(1)).alias(ROWS))


def merge_partials(parts: Sequence[DataFrame], by: Sequence[str]) -> DataFrame:
    """The partials of all parts together, of the same form."""
    return (reduce(DataFrame.unionByName, parts).groupBy(*[q(b) for b in by], q(BUCKET))
            .agg(F.bitmap_or_agg(BITS).alias(BITS), F.sum(ROWS).alias(ROWS)))


def distinct_counts(partials: DataFrame, by: Sequence[str], count_name: str = "encounter_count",
                    distinct_name: str = "unique_patients") -> DataFrame:
    """Per group the number of rows and of distinct non-null ids."""
    ids = F.when(q(BUCKET).isNotNull(), F.bitmap_count(BITS)).otherwise(F.lit(0))
    return partials.groupBy(*[q(b) for b in by]).agg(F.sum(ROWS).alias(count_name), F.sum(ids).alias(distinct_name))
