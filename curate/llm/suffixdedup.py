"""Suffix-array deduplication by a depth-limited most-significant-digit radix sort.

Suffixes need an order only through their first ``depth`` bytes: equal groups of that
order are exactly the repeated strings.  The passes, most significant digit first:

1. The first digit of a suffix is its anchor: the 32-byte gram with the smallest hash
   among those its first ``depth`` bytes hold.  Neighbouring suffixes with one anchor form
   a run, so the pass deals about 3 % as many rows as there are bytes.  A suffix
   whose anchor is unique repeats nowhere and leaves.
2. The second digit is the text of the whole run.  Equal runs are equal in every one of
   their suffixes: all but the first repeat.  A run alone under its anchor leaves.
3. Where an anchor has different runs, the first of each equal group goes on with all of
   its suffixes, ordered through the threshold; each one but the first of its group repeats.

Digits are 64-bit hashes of the bytes, compared only under an equal anchor (so 128 bits
decide).  Copies within a task are folded before the first shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from curate.llm.textbytes import U64, buffer, chunks, materialise, mix, prefix_hash, signed, span_hash

GRAM = 32
CHUNK = 1 << 18
LAST = (1 << 63) - 1


def anchors(buf: np.ndarray, offsets: np.ndarray, depth: int, prefix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, windows, anchor hash) of every run of ``depth``-byte windows that share an anchor."""
    n, span = len(buf), depth - GRAM + 1
    windows = n - depth + 1
    if windows <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, U64)
    at = np.arange(n - GRAM + 1)
    value = span_hash(prefix, at, at + GRAM)
    least, where, width = value, at, 1
    while width < span:  # sliding minimum over ``span`` grams, the leftmost of equal ones
        step = min(width, span - width)
        right, right_at = least[step:], where[step:]
        left, left_at = least[:len(right)], where[:len(right)]
        smaller = right < left
        least, where = np.where(smaller, right, left), np.where(smaller, right_at, left_at)
        width += step
    least, where = least[:windows], where[:windows]
    end = np.repeat(offsets[1:], np.diff(offsets))[:windows]
    valid = np.arange(windows) + depth <= end
    edge = np.ones(windows, bool)
    edge[1:] = (where[1:] != where[:-1]) | (valid[1:] != valid[:-1]) | (end[1:] != end[:-1])
    start = np.flatnonzero(edge)
    size = np.diff(np.append(start, windows))
    keep = valid[start]
    return start[keep], size[keep], least[start[keep]]


def _runs(batches: Iterator[pa.RecordBatch], ids: list[str], depth: int) -> Iterator[pa.RecordBatch]:
    """(anchor, run, *ids, start, windows): negative windows for runs that repeat within the batch."""
    for batch in batches:
        buf, offsets = buffer(batch.column("text"))
        parts = []
        for i, j in chunks(offsets, CHUNK):
            own, at = buf[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
            prefix = prefix_hash(own)
            start, size, anchor = anchors(own, at, depth, prefix)
            run = span_hash(prefix, start, start + size + depth - 1)
            doc = np.searchsorted(at, start, "right") - 1
            parts.append((anchor, run, doc + i, start - at[doc], size))
        if not parts:
            continue
        anchor, run, doc, start, size = (np.concatenate(x) for x in zip(*parts))
        keys = [np.asarray(batch.column(c))[doc] for c in ids]
        order = np.lexsort((start, *reversed(keys), run, anchor))
        again = np.zeros(len(order), bool)
        again[1:] = (anchor[order][1:] == anchor[order][:-1]) & (run[order][1:] == run[order][:-1])
        if len(order) > 1:  # the same place of a repeated row is no repeat
            same = np.ones(len(order) - 1, bool)
            for k in (*keys, start):
                same &= k[order][1:] == k[order][:-1]
            drop = np.concatenate(([False], same))
            order, again = order[~drop], again[~drop]
        anchor, run, start, size = anchor[order], run[order], start[order], np.where(again, -size[order], size[order])
        # what is decided needs no company: it is dealt out by its place
        anchor = np.where(again, mix(keys[0][order].astype(np.int64).view(U64) + mix(start.astype(U64))), anchor)
        yield pa.RecordBatch.from_arrays(
            [pa.array(signed(anchor)), pa.array(signed(run)), *(pa.array(k[order]) for k in keys), pa.array(start.astype(np.int64)), pa.array(size.astype(np.int32))],
            names=["anchor", "run", *ids, "start", "windows"])


def _cut(batches: Iterator[pa.RecordBatch], ids: list[str], depth: int) -> Iterator[pa.RecordBatch]:
    """The bytes of each document's open runs: (anchor, *ids, start, bytes)."""
    for batch in batches:
        buf, offsets = buffer(batch.column("text"))
        raw = buf.tobytes()
        rows: list[tuple] = []
        keys = [batch.column(c).to_pylist() for c in ids]
        for i, runs in enumerate(batch.column("runs").to_pylist()):
            base = int(offsets[i])
            rows += [(r["anchor"], *(k[i] for k in keys), r["start"], raw[base + r["start"]:base + r["start"] + r["windows"] + depth - 1]) for r in runs]
        if rows:
            cols = list(zip(*rows))
            yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in cols[:-1]), pa.array(cols[-1], pa.binary())], names=["anchor", *ids, "start", "bytes"])


def _order(batches: Iterator[pa.RecordBatch], ids: list[str], depth: int) -> Iterator[pa.RecordBatch]:
    """Rows come by (anchor, *ids, start): (*ids, start, end) of every stretch of suffixes that
    stand behind another one of their group."""
    last, seen = None, np.zeros(0, U64)
    for batch in batches:
        if not len(batch):
            continue
        anchor = np.asarray(batch.column("anchor"))
        start = np.asarray(batch.column("start"))
        buf, offsets = buffer(batch.column("bytes"))
        prefix = prefix_hash(buf)
        count = np.diff(offsets) - depth + 1
        row = np.repeat(np.arange(len(batch)), count)
        inside = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        at = offsets[:-1][row] + inside
        digit = span_hash(prefix, at, at + depth)
        first = np.concatenate(([0], np.flatnonzero(np.diff(anchor)) + 1))
        group = np.searchsorted(first, row, "right") - 1
        order = np.lexsort((np.arange(len(row)), digit, group))
        later = np.zeros(len(row), bool)
        equal = (digit[order][1:] == digit[order][:-1]) & (group[order][1:] == group[order][:-1])
        later[order[1:]] = equal
        if last == anchor[0]:  # the group goes on from the batch before
            head = group == 0
            later[head] |= np.isin(digit[head], seen)
        ends = group == group[-1]
        seen = np.unique(np.concatenate((digit[ends], seen))) if last == anchor[-1] else np.unique(digit[ends])
        last = anchor[-1]
        edge = np.ones(len(row), bool)
        edge[1:] = (later[1:] != later[:-1]) | (row[1:] != row[:-1])
        begin = np.flatnonzero(edge)
        size = np.diff(np.append(begin, len(row)))
        begin, size = begin[later[begin]], size[later[begin]]
        owner = row[begin]
        s = start[owner] + inside[begin]
        take = pa.array(owner)
        yield pa.RecordBatch.from_arrays([*(batch.column(c).take(take) for c in ids), pa.array(s), pa.array(s + size + depth - 1)], names=[*ids, "start", "end"])


def _apply(batches: Iterator[pa.RecordBatch], ids: list[str], with_text: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        buf, offsets = buffer(batch.column("text"))
        raw = buf.tobytes()
        removed, spans, digests, kept = [], [], [], []
        for i, cuts in enumerate(batch.column("cuts").to_pylist()):
            own, runs = raw[offsets[i]:offsets[i + 1]], []
            for c in sorted((c["start"], c["end"]) for c in cuts or ()):
                if runs and c[0] <= runs[-1][1]:
                    runs[-1][1] = max(runs[-1][1], c[1])
                else:
                    runs.append(list(c))
            out, at = [], 0
            for a, b in runs:
                out.append(own[at:a])
                at = b
            out.append(own[at:])
            rest = b"".join(out)
            removed.append(len(own) - len(rest)), spans.append([{"start": a, "end": b} for a, b in runs])
            digests.append(hashlib.sha256(rest).hexdigest())
            kept.append(rest)
        more = [pa.array(kept, pa.binary())] if with_text else []
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ids), pa.array(np.diff(offsets)), pa.array(removed, pa.int64()), pa.array(digests),
             pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), *more],
            names=[*ids, "n_bytes", "n_removed", "kept_sha256", "spans", *["kept"] * with_text])


def suffix_dedup(docs: DataFrame, depth: int = 100, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans, and
    with ``with_text`` kept (the bytes that stay; a cut may split a character).

    A byte goes when a ``depth``-byte string over it also starts earlier (smaller id, or same
    document and earlier start).  Null texts are empty; texts shorter than ``depth`` stay.
    Null ids come after all others.  Rows that share an id are documents of their own, ordered
    by a hash of the text; rows equal in id and text are one document and get the same result.
    """
    data = docs.select(F.coalesce(F.col(id_col).cast("bigint"), F.lit(LAST)).alias("_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    ids = ["_id"]
    if not data.groupBy("_id").count().filter("count > 1").isEmpty():
        ids = ["_id", "_tag"]
        data = data.withColumn("_tag", F.xxhash64("text"))
    id_ddl = ", ".join(f"{c} bigint" for c in ids)
    runs = data.mapInArrow(lambda b: _runs(b, ids, depth), f"anchor bigint, run bigint, {id_ddl}, start bigint, windows int").repartition("anchor")
    equal, under = Window.partitionBy("anchor", "run"), Window.partitionBy("anchor")
    nth = F.row_number().over(equal.orderBy(*ids, "start"))
    # rows equal in id and text show one place twice: rank gives both the first place
    place = F.rank().over(equal.orderBy(*ids, "start")) if len(ids) > 1 else nth
    sorted_runs = runs.withColumn("nth", place).withColumn("mixed", F.min("run").over(under) != F.max("run").over(under))
    open_run = (F.col("nth") == 1) & F.col("mixed") & (F.col("windows") > 0)
    left = materialise(sorted_runs.filter((F.col("windows") < 0) | (F.col("nth") > 1) | F.col("mixed"))
                       .select(F.when(open_run, F.col("anchor")).alias("anchor"), *ids, "start", F.abs("windows").alias("windows")), "runs")
    opened = (left.filter("anchor is not null").groupBy(*ids)
              .agg(F.collect_set(F.struct("anchor", "start", F.col("windows").cast("bigint").alias("windows"))).alias("runs")))
    distinct = data if len(ids) == 1 else data.dropDuplicates(ids)
    bytes_of = distinct.join(opened, ids).mapInArrow(lambda b: _cut(b, ids, depth), f"anchor bigint, {id_ddl}, start bigint, bytes binary")
    behind = (bytes_of.repartition("anchor").sortWithinPartitions("anchor", *ids, "start")
              .mapInArrow(lambda b: _order(b, ids, depth), f"{id_ddl}, start bigint, end bigint"))
    whole = left.filter("anchor is null").select(*ids, "start", (F.col("start") + F.col("windows") + F.lit(depth - 1)).alias("end"))
    cuts = whole.unionByName(behind).groupBy(*ids).agg(F.collect_list(F.struct("start", "end")).alias("cuts"))
    ddl = f"{id_ddl}, n_bytes bigint, n_removed bigint, kept_sha256 string, spans array<struct<start:bigint,end:bigint>>" + ", kept binary" * with_text
    out = data.join(cuts, ids, "left").mapInArrow(lambda b: _apply(b, ids, with_text), ddl)
    return out.select(F.when(F.col("_id") != LAST, F.col("_id")).alias("doc_id"), "n_bytes", "n_removed", F.size("spans").cast("bigint").alias("n_spans"), "kept_sha256", "spans", *["kept"] * with_text)


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))


QUERIES = {"op1_suffix_dedup": op1_suffix_dedup}
ORACLE: dict[str, str] = {}
