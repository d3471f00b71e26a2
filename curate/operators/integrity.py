"""Referential integrity (JN1, JN2) and expected-name checks (JN3).

Dimension id sets are joined to the fact instead of being collected to the
driver.  Every id set is de-duplicated first, so a left join never multiplies
fact rows.  Its size is counted (one small job for all dimensions -- the count
is also the reported ``valid_dim_values``); a set within ``broadcast_max_ids``
is broadcast, so all foreign keys are checked in the fact's single scan stage.
A larger set of integral ids is looked up in bitmaps (:mod:`curate.operators.idsets`).
For any other only the *counts* are computed, against the fact reduced to
one row per distinct key value -- the fact itself is never shuffled for it.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curate.operators.cleaning import q
from curate.operators.idsets import (DEFAULT_BITMAP_MAX_BYTES, bitmap_sizes, id_bitmaps, is_integral,
                                     with_membership)
from curate.operators.metrics import counts_long
from curate.sources.literal import literal_rows

# Bound on distinct dimension ids for broadcasting (a hashed relation of a few
# million integral keys stays well under the driver/executor broadcast limits).
DEFAULT_BROADCAST_MAX_IDS = 2_000_000

ID = "_id"


def distinct_ids(dim: DataFrame, id_col: str) -> DataFrame:
    """Non-null distinct ids of a dimension as one column ``_id``."""
    return dim.select(q(id_col).alias(ID)).where(F.col(ID).isNotNull()).distinct()


def id_set_sizes(id_sets: dict[str, DataFrame]) -> dict[str, int]:
    """Row count of every id set, in one job."""
    if not id_sets:
        return {}
    parts = [s.select(F.lit(name).alias("_set")) for name, s in id_sets.items()]
    rows = reduce(DataFrame.unionAll, parts).groupBy("_set").count().collect()
    sizes = {name: 0 for name in id_sets}
    sizes.update({r["_set"]: int(r["count"]) for r in rows})
    return sizes


def join_ids(fact: DataFrame, fk: str, ids: DataFrame, hit_col: str, size: int,
             broadcast_max_ids: int = DEFAULT_BROADCAST_MAX_IDS) -> DataFrame:
    """Left-join an id set; ``hit_col`` is true where ``fact[fk]`` is a known id, else null."""
    key = f"{hit_col}__id"
    side = ids.select(F.col(ID).alias(key), F.lit(True).alias(hit_col))
    if size <= broadcast_max_ids:
        side = F.broadcast(side)
    return fact.join(side, q(fk) == F.col(key), "left").drop(key)


def orphan_predicate(fk: str, hit_col: str) -> Column:
    """Non-null key with no dimension match."""
    return q(fk).isNotNull() & F.col(hit_col).isNull()


def flag_fks(fact: DataFrame, fks: Sequence[tuple[str, DataFrame, str]],
             broadcast_max_ids: int = DEFAULT_BROADCAST_MAX_IDS,
             persisted: list[DataFrame] | None = None,
             large: list[tuple[str, DataFrame]] | None = None,
             bitmap_max_bytes: int = DEFAULT_BITMAP_MAX_BYTES) -> tuple[DataFrame, list[tuple[str, str]], dict[str, int]]:
    """Add one hit column per foreign key.

    Returns ``(flagged, [(fk, hit_col)], {fk: valid_dim_values})``.  The
    persisted id sets are appended to ``persisted`` so a caller can release
    them once the flagged frame has been consumed.  An integral key whose id set
    exceeds the broadcast bound is looked up in bitmaps, if those are within
    ``bitmap_max_bytes``.  With ``large`` given, keys for which neither holds are
    not joined but appended to it as ``(fk, ids)``, to be counted with
    :func:`orphan_count_preaggregated`.
    """
    # The id sets are small and used twice (size check, then the join): persist
    # them so the dimension side is computed once.  Lost blocks are recomputed.
    id_sets = {fk: distinct_ids(dim, id_col).persist(StorageLevel.MEMORY_AND_DISK)
               for fk, dim, id_col in fks}
    sizes = id_set_sizes(id_sets)
    if persisted is not None:
        persisted.extend(id_sets.values())
    over = {fk for fk, ids in id_sets.items() if sizes[fk] > broadcast_max_ids
            and is_integral(fact, fk) and is_integral(ids, ID)}
    bitmaps = {fk: id_bitmaps(id_sets[fk], ID).persist(StorageLevel.MEMORY_AND_DISK) for fk in over}
    if persisted is not None:
        persisted.extend(bitmaps.values())
    bitmap_bytes = {fk: size for fk, (_, size) in bitmap_sizes(bitmaps).items()}
    hits = []
    for i, (fk, _, _) in enumerate(fks):
        if bitmap_bytes.get(fk, bitmap_max_bytes + 1) <= bitmap_max_bytes:
            fact = with_membership(fact, fk, bitmaps[fk], f"_fk_hit_{i}")
            hits.append((fk, f"_fk_hit_{i}"))
            continue
        if large is not None and sizes[fk] > broadcast_max_ids:
            large.append((fk, id_sets[fk]))
            continue
        hit = f"_fk_hit_{i}"
        fact = join_ids(fact, fk, id_sets[fk], hit, sizes[fk], broadcast_max_ids)
        hits.append((fk, hit))
    return fact, hits, sizes


def orphan_count_preaggregated(fact: DataFrame, fk: str, ids: DataFrame) -> DataFrame:
    """One row ``orphaned_fact_rows`` for a large id set, without shuffling the fact.

    The fact is first reduced to one row per distinct key value with its row
    count (partial aggregation on every task, so hot values are pre-combined);
    only those rows are joined with the id set.
    """
    per_value = (fact.where(q(fk).isNotNull())
                 .groupBy(q(fk).alias("_value")).agg(F.count(F.lit(1)).alias("_rows")))
    known = ids.select(F.col(ID).alias("_known"), F.lit(True).alias("_hit"))
    joined = per_value.join(known, F.col("_value") == F.col("_known"), "left")
    return joined.agg(F.coalesce(F.sum(F.when(F.col("_hit").isNull(), F.col("_rows"))),
                                 F.lit(0)).cast("long").alias("orphaned_fact_rows"))


def fk_check(fact: DataFrame, fks: Sequence[tuple[str, DataFrame, str]],
             broadcast_max_ids: int = DEFAULT_BROADCAST_MAX_IDS) -> DataFrame:
    """Per foreign key: ``fk, valid_dim_values, orphaned_fact_rows``.

    A null key is never an orphan; an empty dimension orphans every non-null key.
    A row counts once per foreign key it violates.  Id sets within the bound are
    broadcast and checked together in one scan; larger ones are checked
    against the fact pre-aggregated per key value.
    """
    fact = fact.select(*[q(fk) for fk, _, _ in fks])
    id_sets = {fk: distinct_ids(dim, id_col).persist(StorageLevel.MEMORY_AND_DISK)
               for fk, dim, id_col in fks}
    sizes = id_set_sizes(id_sets)
    small = [(fk, dim, col) for fk, dim, col in fks if sizes[fk] <= broadcast_max_ids]
    large = [fk for fk, _, _ in fks if sizes[fk] > broadcast_max_ids]
    parts = []
    if small:
        flagged, hits = fact, []
        for i, (fk, _, _) in enumerate(small):
            hit = f"_fk_hit_{i}"
            flagged = join_ids(flagged, fk, id_sets[fk], hit, sizes[fk], broadcast_max_ids)
            hits.append((fk, hit))
        parts.append(counts_long(flagged, [(fk, orphan_predicate(fk, hit)) for fk, hit in hits],
                                 "fk", "orphaned_fact_rows", total_col=None))
    for fk in large:
        parts.append(orphan_count_preaggregated(fact, fk, id_sets[fk])
                     .select(F.lit(fk).alias("fk"), "orphaned_fact_rows"))
    long = parts[0]
    for p in parts[1:]:
        long = long.unionByName(p)
    valid = F.lit(None).cast("long")
    for fk, n in sizes.items():
        valid = F.when(F.col("fk") == fk, F.lit(n).cast("long")).otherwise(valid)
    return long.select("fk", valid.alias("valid_dim_values"), "orphaned_fact_rows")


def orphans(fact: DataFrame, fk: str, dim: DataFrame, id_col: str,
            broadcast_max_ids: int = DEFAULT_BROADCAST_MAX_IDS) -> DataFrame:
    """Fact rows whose non-null ``fk`` has no match in ``dim[id_col]``.

    Within the bound: a broadcast anti join.  Above it, the orphan key *values*
    are found first (the fact's distinct keys, pre-aggregated, anti-joined with
    the ids); if those are few, a broadcast semi join returns the rows, so the
    fact is not shuffled.  Only a huge orphan-value set falls back to a
    shuffle anti join.
    """
    ids = distinct_ids(dim, id_col).persist(StorageLevel.MEMORY_AND_DISK)
    size = id_set_sizes({fk: ids})[fk]
    present = fact.where(q(fk).isNotNull())
    if size <= broadcast_max_ids:
        side = F.broadcast(ids.select(F.col(ID).alias("_orphan_id")))
        return present.join(side, q(fk) == F.col("_orphan_id"), "left_anti")
    values = (present.select(q(fk).alias("_value")).distinct()
              .join(ids, F.col("_value") == F.col(ID), "left_anti")
              .persist(StorageLevel.MEMORY_AND_DISK))
    n_values = id_set_sizes({fk: values})[fk]
    side = values.select(F.col("_value").alias("_orphan_value"))
    if n_values <= broadcast_max_ids:
        return present.join(F.broadcast(side), q(fk) == F.col("_orphan_value"),
                            "left_semi")
    return present.join(side, q(fk) == F.col("_orphan_value"), "left_semi")


def missing_expected(spark: SparkSession, found: DataFrame, expected: Iterable[str],
                     name_col: str = "file_name") -> DataFrame:
    """Expected names absent from ``found[name_col]``, sorted.

    ``expected`` is a literal list (its size is known), so it is the side that
    is broadcast: the large ``found`` side is only semi-joined and never shuffled.
    """
    names = sorted(set(expected))
    exp = literal_rows(spark, [(n,) for n in names], f"`{name_col}` string")
    hits = found.select(q(name_col)).join(F.broadcast(exp), name_col, "left_semi").distinct()
    return exp.join(hits, name_col, "left_anti").orderBy(name_col)
