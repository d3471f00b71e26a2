"""Exact deduplication against immutable snapshots, screened by static binary-fuse filters.

A snapshot is a set of distinct digests kept in exact buckets, with one
binary-fuse filter a bucket, built once and never changed.  A new batch is first
grouped on its own (its duplicates meet there, folded before the shuffle); each
distinct digest then asks its bucket's filter, and only positives join the exact
bucket, where the byte check decides: a group holds one SHA-256 and one byte length
of the normalised text, so a filter's false positive never merges two texts.
Digests are distinct when they reach the buckets, so no bucket is hot; the number of
buckets follows the number of digests.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from curate.llm.textbytes import U64, materialise, mix

BUCKET_DIGESTS = 1 << 20


class FuseFilter:
    """A 3-wise binary-fuse filter with 16-bit fingerprints over distinct 64-bit digests."""

    def __init__(self, digests: np.ndarray | None = None):
        self.seed, self.segment, self.table = 0, 4, np.zeros(0, np.uint16)
        if digests is None:
            return
        keys = np.unique(digests.astype(np.int64)).view(U64)
        n = len(keys)
        self.segment = 1 << max(2, min(18, int(np.floor(np.log(max(n, 2)) / np.log(3.33) + 2.25))))
        size = int(n * max(1.125, 0.875 + 0.25 * np.log(1e6) / np.log(max(n, 2)))) + 1
        self.parts = max(3, -(-size // self.segment) + 2)
        while not self._build(keys):
            self.seed += 1
            if self.seed % 8 == 0:
                self.parts += 1 + self.parts // 8

    def _slots(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The three slots of every key, in neighbouring segments, and its fingerprint."""
        h = mix(keys + U64(self.seed) * U64(0x9E3779B97F4A7C15))
        first = ((h >> U64(32)) * U64(self.parts - 2) >> U64(32)).astype(np.int64)
        inside = U64(self.segment - 1)
        g = mix(h)
        slots = np.stack([first * self.segment + (g & inside).astype(np.int64),
                          (first + 1) * self.segment + ((g >> U64(20)) & inside).astype(np.int64),
                          (first + 2) * self.segment + ((g >> U64(40)) & inside).astype(np.int64)])
        return slots, (h & U64(0xFFFF)).astype(np.uint16)

    def _build(self, keys: np.ndarray) -> bool:
        slots, prints = self._slots(keys)
        size = self.parts * self.segment
        count = np.bincount(slots.ravel(), minlength=size)
        number = np.arange(len(keys))
        xored = np.zeros(size, np.int64)
        for s in slots:
            np.bitwise_xor.at(xored, s, number)
        left, order = len(keys), []
        lone = np.flatnonzero(count == 1)
        while len(lone):
            key, at = np.unique(xored[lone], return_index=True)
            lone = lone[at]
            order.append((key, lone))
            left -= len(key)
            near = slots[:, key].ravel()
            np.subtract.at(count, near, 1)
            np.bitwise_xor.at(xored, near, np.tile(key, 3))
            lone = np.unique(near[count[near] == 1])
        if left:
            return False
        self.table = np.zeros(size, np.uint16)
        for key, slot in reversed(order):
            self.table[slot] = 0
            a, b, c = slots[:, key]
            self.table[slot] = prints[key] ^ self.table[a] ^ self.table[b] ^ self.table[c]
        return True

    def __contains__(self, digest: int) -> bool:
        return bool(self.contains(np.array([digest]))[0])

    def contains(self, digests: np.ndarray) -> np.ndarray:
        """True for every member, and for about 1 of 65,536 others."""
        if not len(self.table):
            return np.zeros(len(digests), bool)
        slots, prints = self._slots(digests.astype(np.int64).view(U64))
        t = self.table
        return (t[slots[0]] ^ t[slots[1]] ^ t[slots[2]]) == prints

    def dump(self) -> dict:
        return {"seed": self.seed, "segment": self.segment, "table": self.table.tobytes()}

    @classmethod
    def load(cls, seed: int, segment: int, table: bytes) -> FuseFilter:
        f = cls()
        f.seed, f.segment, f.table = int(seed), int(segment), np.frombuffer(table, np.uint16)
        f.parts = len(f.table) // f.segment
        return f


@dataclass
class Snapshot:
    """groups: (digest, sha, n_bytes, keep_id, group_size); filters: one row a bucket."""

    groups: DataFrame
    filters: DataFrame
    buckets: int


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), r"[\x20\x09-\x0D]+", " ")


def digest_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, digest, sha, n_bytes) of every row; null texts count as empty."""
    text = normalised(F.col(text_col)).cast("binary")
    return (docs.select(F.col(id_col).alias("doc_id"), text.alias("_t"))
            .select("doc_id", F.xxhash64("_t").alias("digest"), F.unhex(F.sha2("_t", 256)).alias("sha"),
                    F.octet_length("_t").cast("bigint").alias("n_bytes")))


def _bucket(n: int) -> Column:
    return F.pmod(F.xxhash64("digest"), F.lit(n)).alias("bucket")


def group(digests: DataFrame) -> DataFrame:
    """One row per distinct text: smallest id and number of rows (folded map-side)."""
    return digests.groupBy("digest", "sha", "n_bytes").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))


def snapshot(groups: DataFrame, bucket_digests: int = BUCKET_DIGESTS) -> Snapshot:
    """An immutable snapshot over distinct groups (as ``group`` gives them)."""
    groups = materialise(groups, "snapshot")
    n = max(1, -(-groups.count() // bucket_digests))

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([{"bucket": pdf["bucket"].iloc[0], **FuseFilter(pdf["digest"].to_numpy()).dump()}])

    filters = (groups.select("digest", _bucket(n)).groupBy("bucket")
               .applyInPandas(build, "bucket bigint, seed bigint, segment bigint, table binary"))
    return Snapshot(groups, materialise(filters, "filters"), n)


def screen(snap: Snapshot, groups: DataFrame) -> DataFrame:
    """``groups`` plus maybe_known: what the snapshot's filters say of each digest."""

    def probe(key, own: pd.DataFrame, filters: pd.DataFrame) -> Iterator[pd.DataFrame]:
        known = np.zeros(len(own), bool)
        for f in filters.itertuples():
            known |= FuseFilter.load(f.seed, f.segment, f.table).contains(own["digest"].to_numpy())
        return own.drop(columns="bucket").assign(maybe_known=known)

    with_bucket = groups.select("*", _bucket(snap.buckets))
    return (with_bucket.groupBy("bucket").cogroup(snap.filters.groupBy("bucket"))
            .applyInPandas(probe, groups.withColumn("maybe_known", F.lit(True)).schema))


def merge(snap: Snapshot, batch: DataFrame) -> DataFrame:
    """The groups of snapshot and new batch together, as (digest, sha, n_bytes, keep_id, group_size)."""
    key = ["digest", "sha", "n_bytes"]
    asked = materialise(screen(snap, batch), "screened")
    known = asked.filter("maybe_known").select(*key, F.col("keep_id").alias("new_id"), F.col("group_size").alias("new_size"))
    old = (snap.groups.join(known, key, "left")
           .select(*key, F.least("keep_id", "new_id").alias("keep_id"),
                   (F.col("group_size") + F.coalesce("new_size", F.lit(0))).alias("group_size")))
    fresh = asked.join(known.join(snap.groups, key, "left_semi").select(*key), key, "left_anti")
    return old.unionByName(fresh.drop("maybe_known"))


def exact_dedup(docs: DataFrame, batches: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, sha, n_bytes.

    The rows arrive as ``batches`` parts (a hash of the digest's row id): the first becomes a
    snapshot, each later one is grouped, screened and merged into the next snapshot.
    Equal texts (white-space runs as one space, null as empty) keep the row of
    the smallest id; a null id comes after all others, and of rows that share the
    smallest id one stays.  An empty table gives no rows.
    """
    digests = materialise(digest_table(docs, id_col, text_col), "digests")
    part = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(batches))
    snap = snapshot(group(digests.filter(part == 0)))
    for k in range(1, batches):
        merged = merge(snap, group(digests.filter(part == k)))
        groups = merged if k == batches - 1 else None
        if groups is None:
            snap = snapshot(merged)
    if batches == 1:
        groups = snap.groups
    # rows that share id and text: one of them counts as the first (keys are nearly unique, so nothing is hot)
    again = digests.groupBy("doc_id", "digest", "sha", "n_bytes").agg(F.count("*").alias("rows"))
    joined = again.join(groups, ["digest", "sha", "n_bytes"])
    return (joined.select("doc_id", "keep_id", "group_size", "sha", "n_bytes", F.explode(F.sequence(F.lit(1).cast("bigint"), "rows")).alias("nth"))
            .select("doc_id", "keep_id", "group_size",
                    (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("nth") == 1)).alias("kept"), "sha", "n_bytes"))


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows that ``exact_dedup`` drops (columns unchanged)."""
    kept = exact_dedup(docs).filter("kept").select(F.col("doc_id").alias("_keep"), F.hex("sha").alias("_sha"))
    text = F.upper(F.sha2(normalised(F.col("text")).cast("binary"), 256))
    marked = docs.select("*", text.alias("_own")).join(kept, F.col("doc_id").eqNullSafe(F.col("_keep")) & (F.col("_own") == F.col("_sha")))
    first = Window.partitionBy("_keep", "_own").orderBy(F.xxhash64(*docs.columns))
    return marked.withColumn("_nth", F.row_number().over(first)).filter("_nth = 1").select(*docs.columns)


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return exact_dedup(docs).select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256"))


QUERIES = {"op5_exact_dedup": op5_exact_dedup}
ORACLE = {"op5_exact_dedup": r"""
WITH t AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, text_sha256
FROM t WINDOW w AS (PARTITION BY text_sha256)"""}
