"""Mixing sources to target weights by subset-sum budget fitting.

Documents are counted by exact length per source.  A source's target is met by
whole passes over all its documents, then by a subset for the remaining budget:
first the same share of every length, what a length leaves over passing on to the next
shorter one, so that less than the longest document remains; then short documents are given
back for as many words again, and a bounded-knapsack dynamic program fits this budget as closely
as the lengths allow, from above or below.  The chosen
number of documents of each length is then dealt to seeded documents.  Only counts by length
meet in one group; neither documents nor sources are gathered.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from curate.llm.textbytes import materialise

SEED = 20240607
WEIGHTS = (1.0, 2.0, 3.0)
MOST = 3
#: Words of short documents that the dynamic program decides anew (the longest document's, if it has more).
ROOM = 20_000
#: A length of one source is dealt in this many parts, or one a million rows, so that copies don't meet in one.
PARTS, PART_ROWS = 64, 1_000_000
#: Sources whose targets are broadcast; with more they are joined by a shuffle, with equal results.
BROADCAST_SOURCES = 100_000


def knapsack(lengths: np.ndarray, counts: np.ndarray, budget: int, above: bool = False) -> np.ndarray:
    """How many of each length to take so that their sum is as near below ``budget`` as can be;
    with ``above``, as near as can be on either side (ties: below).

    Reachable sums (with ``above`` up to twice the budget: beyond it, taking nothing is nearer) are the
    bits of an integer; counts are split into powers of two, and each sum remembers the piece that first
    reached it, so the choice is read back from the nearest sum.
    """
    taken = np.zeros(len(lengths), np.int64)
    most = 2 * budget if above else budget
    mask, reach = (1 << (most + 1)) - 1, 1
    by = np.full(most + 1, -1, np.int32)
    pieces: list[tuple[int, int]] = []
    for k in np.argsort(-lengths, kind="stable"):
        size, left, step = int(lengths[k]), int(counts[k]), 1
        if not 0 < size <= most:
            continue
        left = min(left, most // size)
        while left and not reach >> budget & 1:
            n = min(step, left)
            new = (reach << size * n) & mask & ~reach
            if new:
                pieces.append((int(k), n))
                by[np.flatnonzero(np.unpackbits(np.frombuffer(new.to_bytes(most // 8 + 1, "little"), np.uint8), bitorder="little"))] = len(pieces) - 1
                reach |= new
            left -= n
            step *= 2
    sums = np.append(np.flatnonzero(by >= 0), 0)
    at = int(min(sums, key=lambda s: (abs(int(s) - budget), s)))
    while at:
        k, n = pieces[by[at]]
        taken[k] += n
        at -= int(lengths[k]) * n
    return taken


def fit(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """Documents to take of each length, at most ``counts``, for the sum nearest to ``budget`` words that the last step can reach."""
    total = sum(int(z) * int(n) for z, n in zip(lengths, counts))
    taken = np.zeros(len(counts), np.int64)
    if budget >= total:
        return counts.copy()
    seen = spent = 0
    for k in np.argsort(-lengths, kind="stable"):
        size, n = int(lengths[k]), int(counts[k])
        if not size:
            continue
        seen += size * n
        taken[k] = min(n, (seen * budget // total - spent) // size)
        spent += size * int(taken[k])
    room, most = 0, max(ROOM, int(lengths.max()))
    for k in np.argsort(lengths, kind="stable"):
        size = int(lengths[k])
        if size and room < most:
            back = min(int(taken[k]), -(-(most - room) // size))
            taken[k] -= back
            room += back * size
            spent -= back * size
    return taken + knapsack(lengths, counts - taken, budget - spent, above=True)


def running(df: DataFrame, order: list[Column], sums: dict[str, str]) -> DataFrame:
    """``df`` sorted by ``order`` with, for each ``out: column`` of ``sums``, the sum of the rows before it.

    The rows are sorted by ranges and written, each range's sums are added up, and a window within one
    range adds the rest: no task holds more than its range.
    """
    held = materialise(df.orderBy(*order).withColumn("_range", F.spark_partition_id()), "ranges")
    of_range = held.groupBy("_range").agg(*(F.sum(c).alias(f"_{out}") for out, c in sums.items()))
    past = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)      # one row a range
    offsets = of_range.select(F.col("_range").alias("_r"), *(F.coalesce(F.sum(f"_{out}").over(past), F.lit(0)).alias(f"_{out}") for out in sums))
    before = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (held.join(F.broadcast(offsets), F.col("_range") == F.col("_r"))
            .select(*df.columns, *((F.col(f"_{out}") + F.coalesce(F.sum(c).over(before), F.lit(0))).alias(out) for out, c in sums.items())))


def targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size, target) by water-filling: a target is the smaller of MOST
    times the source's size and its weight's share of what the capped ones leave."""
    by_name = running(sizes.withColumn("one", F.lit(1)), [F.col("source").asc_nulls_last()], {"nth": "one"})
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.pmod("nth", F.lit(len(WEIGHTS))) + 1).cast("int"))
    ranked = materialise(by_name.select("source", "source_size", weight.alias("weight"), (F.lit(MOST) * F.col("source_size")).alias("cap")), "weights")
    all_size, all_weight = ranked.agg(F.sum("source_size"), F.sum("weight")).first()
    ratio = F.col("cap") / F.col("weight")
    poured = running(ranked, [ratio.asc(), F.col("source").asc_nulls_last()], {"capped": "cap", "past_weight": "weight"})
    level = (F.lit(all_size) - F.col("capped")) / (F.lit(all_weight) - F.col("past_weight"))
    levelled = materialise(poured.withColumn("level", level).withColumn("open", F.col("level") * F.col("weight") <= F.col("cap")), "levels")
    # the level falls from the first open source on, so the greatest one is the first's, also among equal ratios
    water = F.lit(levelled.agg(F.max(F.when(F.col("open"), F.col("level")))).first()[0]).cast("double")
    return (levelled
            .select("source", "source_size", F.when(F.col("open"), water * F.col("weight")).otherwise(F.col("cap")).cast("double").alias("target")))


def plan(lengths: DataFrame) -> DataFrame:
    """(source, size, passes, extra) from (source, size, n, target): whole passes over the
    source, and how many documents of the length are taken once more."""

    def choose(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("size", kind="stable").reset_index(drop=True)
        size, n = pdf["size"].to_numpy(np.int64), pdf["n"].to_numpy(np.int64)
        total, target = int((size * n).sum()), float(pdf["target"].iloc[0])
        passes = min(MOST, int(target // total)) if total else 0
        if total and MOST * total - target < 0.5:
            passes = MOST
        rest = 0 if passes == MOST else max(0, int(round(target)) - passes * total)
        extra = fit(size, n, rest) if rest else np.zeros(len(n), np.int64)
        return pdf[["source", "size"]].assign(passes=passes, extra=extra)

    return lengths.groupBy("source").applyInPandas(choose, "source string, size bigint, passes int, extra bigint")


def mix_sources(docs: DataFrame, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, source_size, target, copies, taken, and its ``carry`` columns.

    copies (0 to 3) is how often the mix takes the row, taken = copies * size.  A null text
    has size 0 and so has one without words; such rows are taken by whole passes
    only.  A null source is a source of its own, after all others.  Repeated rows count each
    on its own (equal rows get the same number of copies up to order); an empty table gives
    no rows.
    """
    size = F.coalesce(F.expr(r"regexp_count(_text, '[^\\x20\\x09-\\x0D]+')"), F.lit(0)).cast("bigint")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), F.col(text_col).cast("string").alias("_text"), *carry)
    rows = materialise(rows.select("doc_id", "source", *carry, size.alias("size"), F.xxhash64("doc_id", F.lit(seed)).alias("part")), "sizes")
    rows = rows.withColumn("part", F.pmod("part", F.lit(max(PARTS, rows.count() // PART_ROWS))))
    counts = materialise(rows.groupBy("source", "size", "part").agg(F.count("*").alias("n")), "lengths")
    aims = materialise(targets(counts.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))), "targets")
    aims = aims.withColumnRenamed("source", "_t")
    aims = F.broadcast(aims) if aims.count() <= BROADCAST_SOURCES else aims
    lengths = (counts.groupBy("source", "size").agg(F.sum("n").alias("n"))
               .join(aims.select("_t", "target"), F.col("source").eqNullSafe(F.col("_t"))).drop("_t"))
    chosen = plan(lengths).withColumnsRenamed({"source": "_s", "size": "_z"})
    before = Window.partitionBy("source", "size").orderBy(F.hash("part", F.lit(seed)), "part").rowsBetween(Window.unboundedPreceding, -1)
    dealt = counts.join(chosen, F.col("source").eqNullSafe(F.col("_s")) & (F.col("size") == F.col("_z"))).select(
        F.col("source").alias("_s"), F.col("size").alias("_z"), F.col("part").alias("_p"), "passes",
        F.greatest(F.lit(0), F.least(F.col("n"), F.col("extra") - F.coalesce(F.sum("n").over(before), F.lit(0)))).alias("quota"))
    nth = F.row_number().over(Window.partitionBy("source", "size", "part").orderBy(F.xxhash64("doc_id", F.lit(seed + 1)), "doc_id"))
    copies = F.col("passes") + (F.col("nth") <= F.col("quota")).cast("int")
    out = rows.withColumn("nth", nth).join(
        dealt, F.col("source").eqNullSafe(F.col("_s")) & (F.col("size") == F.col("_z")) & (F.col("part") == F.col("_p")))
    return (out.join(aims, F.col("source").eqNullSafe(F.col("_t")))
            .select("doc_id", "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).cast("bigint").alias("taken"), *carry))


def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    return mix_sources(docs).select("doc_id", "size", "source_size", "target", "taken", "copies", "source")


QUERIES = {"op9_source_mixing": op9_source_mixing}
ORACLE: dict[str, str] = {}
