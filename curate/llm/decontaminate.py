"""Benchmark decontamination with an FM-index per training shard.

A task turns its documents into shards.  A shard's words become symbols: words of
the test phrases get their number, any other word is a separator, and runs of
symbols too short for the shortest phrase are left out, as nothing can occur in
them.  Over what is left the task builds an FM-index (suffix array by prefix
doubling, Burrows-Wheeler transform in a wavelet matrix, sampled suffix positions),
searches all phrases backwards at once, locates the occurrences by walking to the
next sampled position and merges them to removal spans.  Documents are never
shuffled: the work is one pass over the table.

Phrases reach the tasks by broadcast in blocks of at most ``block`` windows; with
more of them, further passes over the documents add their spans.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curate.llm.textbytes import ALNUM, LOWER, buffer, chunks, lists, prefix_hash, signed, span_hash, words

SHARD_BYTES = 4 << 20
SAMPLE = 8


class FMIndex:
    """FM-index over runs of symbols (1..sigma), each run ended by a separator of its own.

    ``seq`` holds the symbols with 0 as separator and must start and end with one.
    Separators sort before all symbols and among themselves by position, so every
    suffix differs from every other one within its run.
    """

    def __init__(self, seq: np.ndarray, sigma: int, sample: int = SAMPLE):
        n = self.n = len(seq)
        separator = seq == 0
        self.n_sep = int(separator.sum())
        rank = seq.astype(np.int64) + self.n_sep - 1
        rank[separator] = np.arange(self.n_sep)
        width = 1
        while True:  # prefix doubling
            ahead = np.zeros(n, np.int64)
            ahead[:-width or None] = rank[width:] + 1 if width < n else 0
            ahead[rank < self.n_sep] = 0
            key = rank * (n + sigma + 2) + ahead
            sa = np.argsort(key, kind="stable")
            key = key[sa]
            new = np.empty(n, np.int64)
            new[sa] = np.concatenate(([0], np.cumsum(key[1:] != key[:-1])))
            if new[sa[-1]] == n - 1:
                break
            rank, width = new, width * 2
        bwt = seq[sa - 1]  # position 0 is a separator; what stands before it is never asked for
        count = np.bincount(seq, minlength=sigma + 1)
        count[0] = self.n_sep
        self.first = np.concatenate(([0], np.cumsum(count)))
        self.levels: list[tuple[np.ndarray, int]] = []
        rest = bwt
        self.bits = max(1, int(sigma).bit_length())
        for level in range(self.bits - 1, -1, -1):
            one = (rest >> level) & 1 == 1
            zeros = np.zeros(n + 1, np.int32)
            np.cumsum(~one, out=zeros[1:])
            self.levels.append((zeros, int(zeros[-1])))
            rest = np.concatenate((rest[~one], rest[one]))
        at = np.arange(n)
        run_start = np.maximum.accumulate(np.where(separator, at, 0))
        self.mark = (~separator & ((at - run_start - 1) % sample == 0))[sa]
        self.mark_rank = np.cumsum(self.mark) - self.mark
        self.sampled = sa[self.mark]

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol in the first i entries of the transform."""
        start = np.zeros(len(i), np.int64)
        i = i.astype(np.int64)
        for k, (zeros, total) in enumerate(self.levels):
            one = (symbol >> (self.bits - 1 - k)) & 1 == 1
            z, zs = zeros[i], zeros[start]
            i, start = np.where(one, total + i - z, z), np.where(one, total + start - zs, zs)
        return i - start

    def symbols(self, i: np.ndarray) -> np.ndarray:
        """The transform's entries at rows i."""
        out = np.zeros(len(i), np.int64)
        i = i.astype(np.int64)
        for zeros, total in self.levels:
            z = zeros[i]
            one = zeros[i + 1] == z
            out = out * 2 + one
            i = np.where(one, total + i - z, z)
        return out

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Backward search of equally long phrases (one a row): (phrase, first row, end row) of those found."""
        which = np.arange(len(phrases))
        lo, hi = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n, np.int64)
        for j in range(phrases.shape[1] - 1, -1, -1):
            c = phrases[which, j]
            lo, hi = self.first[c] + self.rank(c, lo), self.first[c] + self.rank(c, hi)
            alive = lo < hi
            which, lo, hi = which[alive], lo[alive], hi[alive]
            if not len(which):
                break
        return which, lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions of suffix-array rows, by walking back to the next sampled one."""
        out = np.zeros(len(rows), np.int64)
        todo, row, steps = np.arange(len(rows)), rows.astype(np.int64), 0
        while len(todo):
            hit = self.mark[row]
            out[todo[hit]] = self.sampled[self.mark_rank[row[hit]]] + steps
            todo, row = todo[~hit], row[~hit]
            if len(todo):
                c = self.symbols(row)
                row = self.first[c] + self.rank(c, row)
                steps += 1
        return out


class Phrases:
    """A block of test phrases: hashed words, and the items each phrase comes from."""

    def __init__(self, rows: list[tuple[str | None, list[int]]]):
        grams: dict[tuple[int, ...], set[str | None]] = {}
        for item, gram in rows:
            grams.setdefault(tuple(gram), set()).add(item)
        self.vocabulary = np.unique(np.array([w for g in grams for w in g], np.int64))
        self.groups = []
        for size in sorted({len(g) for g in grams}):
            own = [g for g in grams if len(g) == size]
            ids = np.searchsorted(self.vocabulary, np.array(own, np.int64)) + 1
            self.groups.append((size, ids, [sorted(x for x in grams[g] if x is not None) for g in own]))
        self.shortest = self.groups[0][0] if self.groups else 0

    def occurrences(self, symbol: np.ndarray, document: np.ndarray) -> Iterator[tuple[np.ndarray, int, list[str]]]:
        """(word positions, length, items) of each phrase that occurs in the shard."""
        if not self.groups or not len(symbol):
            return
        known = symbol > 0
        edge = np.ones(len(symbol), bool)
        edge[1:] = (document[1:] != document[:-1]) | (known[1:] != known[:-1])
        begin = np.flatnonzero(edge)
        length = np.diff(np.append(begin, len(symbol)))
        keep = known[begin] & (length >= self.shortest)
        begin, length = begin[keep], length[keep]
        if not len(begin):
            return
        total = int(length.sum())
        place = np.arange(total) + np.repeat(np.arange(len(begin)) + 1, length)
        source = np.arange(total) + np.repeat(begin - (np.cumsum(length) - length), length)
        seq, back = np.zeros(total + len(begin) + 1, np.int64), np.zeros(total + len(begin) + 1, np.int64)
        seq[place], back[place] = symbol[source], source
        index = FMIndex(seq, len(self.vocabulary))
        for size, ids, items in self.groups:
            which, lo, hi = index.search(ids)
            if len(which):
                count = hi - lo
                rows = np.arange(int(count.sum())) + np.repeat(lo - (np.cumsum(count) - count), count)
                at = back[index.locate(rows)]
                for w, part in zip(which, np.split(at, np.cumsum(count)[:-1])):
                    yield part, size, items[w]


def _gram_rows(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        buf, offsets = buffer(batch.column("text"))
        buf = LOWER[buf]
        start, end, doc = words(buf, offsets, ALNUM)
        hashed = signed(span_hash(prefix_hash(buf), start, end))
        at = np.searchsorted(doc, np.arange(len(offsets)))
        ids, grams = [], []
        for k, item in enumerate(batch.column("item_id").to_pylist()):
            own = hashed[at[k]:at[k + 1]]
            for i in range(max(1, len(own) - size + 1) if len(own) else 0):
                ids.append(item)
                grams.append(own[i:i + size].tolist())
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(grams, pa.list_(pa.int64()))], names=["item_id", "gram"])


def phrase_windows(items: DataFrame, size: int, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item_id, gram): the distinct windows of ``size`` words of every item; an item with
    fewer words is one window, one without words gives none."""
    plain = items.select(F.col(item_col).cast("string").alias("item_id"), F.col(text_col).cast("string").alias("text"))
    return plain.mapInArrow(lambda b: _gram_rows(b, size), "item_id string, gram array<bigint>").distinct()


def _scan(batches: Iterator[pa.RecordBatch], phrases: Phrases) -> Iterator[pa.RecordBatch]:
    span = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("words", pa.int64())])
    for batch in batches:
        buf, offsets = buffer(batch.column("_text"))
        for i, j in chunks(offsets, SHARD_BYTES):
            at = offsets[i:j + 1] - offsets[i]
            low = LOWER[buf[offsets[i]:offsets[j]]]
            start, end, doc = words(low, at, ALNUM)
            hashed = signed(span_hash(prefix_hash(low), start, end))
            symbol = np.zeros(len(hashed), np.int64)
            if len(phrases.vocabulary):
                k = np.minimum(np.searchsorted(phrases.vocabulary, hashed), len(phrases.vocabulary) - 1)
                symbol = np.where(phrases.vocabulary[k] == hashed, k + 1, 0)
            cover = np.zeros(len(hashed) + 1, np.int64)
            found: dict[int, set[str]] = {}
            for where, size, items in phrases.occurrences(symbol, doc):
                np.add.at(cover, where, 1)
                np.add.at(cover, where + size, -1)
                for d in np.unique(doc[where]).tolist():
                    found.setdefault(d, set()).update(items)
            hit = np.cumsum(cover[:-1]) > 0
            edge = np.flatnonzero(np.diff(np.concatenate(([0], hit.view(np.int8), [0]))) != 0) if len(hit) else np.zeros(0, np.int64)
            s, e = edge[::2], edge[1::2]
            # a covered run may go on into the next document
            cut = [(a, b) for a, b in zip(s.tolist(), e.tolist())]
            runs = []
            for a, b in cut:
                inner = np.flatnonzero(np.diff(doc[a:b])) + a + 1
                bounds = [a, *inner.tolist(), b]
                runs += list(zip(bounds, bounds[1:]))
            per = np.bincount(doc[[a for a, _ in runs]] if runs else np.zeros(0, np.int64), minlength=j - i)
            base = at[doc[[a for a, _ in runs]]] if runs else np.zeros(0, np.int64)
            a, b = np.array([a for a, _ in runs], np.int64), np.array([b for _, b in runs], np.int64)
            values = pa.StructArray.from_arrays([pa.array(start[a] - base if len(a) else a), pa.array(end[b - 1] - base if len(a) else a), pa.array(b - a)], fields=list(span))
            part = batch.slice(i, j - i)
            old_spans, old_items = part.column("_spans").to_pylist() if "_spans" in part.schema.names else None, None
            new_spans = lists(values, per, span)
            new_items = [sorted(found.get(d, ())) for d in range(j - i)]
            if old_spans is not None:
                old_items = part.column("_items").to_pylist()
                new_items = [sorted({*x, *y}) for x, y in zip(old_items, new_items)]
                new_spans = pa.array([_union(x, y, start, end, at[d], doc, d) for d, (x, y) in enumerate(zip(old_spans, new_spans.to_pylist()))], pa.list_(span))
            kept = [n for n in part.schema.names if n not in ("_n_words", "_spans", "_items")]
            yield pa.RecordBatch.from_arrays(
                [*(part.column(n) for n in kept), pa.array(np.bincount(doc, minlength=j - i)), new_spans, pa.array(new_items, pa.list_(pa.string()))],
                names=[*kept, "_n_words", "_spans", "_items"])


def _union(x: list[dict], y: list[dict], start, end, base, doc, d) -> list[dict]:
    """Two lists of spans of a document as one, with the words of each counted anew."""
    out: list[dict] = []
    for s in sorted(x + y, key=lambda s: s["start"]):
        if out and s["start"] <= out[-1]["end"]:
            out[-1]["end"] = max(out[-1]["end"], s["end"])
        else:
            out.append(dict(s))
    lo, hi = np.searchsorted(doc, [d, d + 1])
    for s in out:
        s["words"] = int(((start[lo:hi] - base >= s["start"]) & (end[lo:hi] - base <= s["end"])).sum())
    return out


def find_phrases(spark: SparkSession, docs: DataFrame, items: DataFrame, size: int = 10, block: int = 200_000) -> DataFrame:
    """Every column of ``docs`` plus n_words, n_hit, spans (start byte, end byte, words) and
    items (sorted item ids) for the test phrases that occur in its ``text``.

    A null or empty text has no words and no hits; repeated rows are judged each on
    its own; an empty ``items`` table hits nothing.  Items without an id mark
    words but are not listed.  Input columns named like an output are replaced.
    """
    windows = phrase_windows(items, size)
    total = windows.count()
    blocks = max(1, -(-total // block))
    clash = [c for c in docs.columns if c.lower() in ("n_words", "n_hit", "spans", "items", "_n_words", "_spans", "_items", "_text")]
    out = docs.drop(*clash).withColumn("_text", F.col("text").cast("string"))
    span = "array<struct<start:bigint,end:bigint,words:bigint>>"
    for k in range(blocks):
        part = windows if blocks == 1 else windows.filter(F.pmod(F.xxhash64("gram"), F.lit(blocks)) == k)
        held = spark.sparkContext.broadcast(Phrases([(r.item_id, r.gram) for r in part.collect()]))
        names = [c for c in out.columns if c not in ("_n_words", "_spans", "_items")]
        schema = out.select(*names).withColumn("_n_words", F.lit(0).cast("bigint")).withColumn("_spans", F.lit(None).cast(span)).withColumn("_items", F.lit(None).cast("array<string>")).schema
        out = out.mapInArrow(lambda b, held=held: _scan(b, held.value), schema)
    return (out.withColumn("n_hit", F.aggregate("_spans", F.lit(0).cast("bigint"), lambda a, s: a + s["words"]))
            .withColumnsRenamed({"_n_words": "n_words", "_spans": "spans", "_items": "items"}).drop("_text"))


def remove_spans(df: DataFrame) -> DataFrame:
    """``text`` without its spans (bytes, which begin and end with words); texts without spans stay as they are."""
    raw, none = F.col("text").cast("binary"), F.array(F.lit(0).cast("bigint"))
    start = F.concat(none, F.transform("spans", lambda s: s["end"]))
    end = F.concat(F.transform("spans", lambda s: s["start"]), F.array(F.octet_length(raw).cast("bigint")))
    kept = F.zip_with(start, end, lambda a, b: F.substring(raw, (a + 1).cast("int"), (b - a).cast("int")).cast("string"))
    return df.withColumn("text", F.when(F.size("spans") > 0, F.array_join(kept, "")).otherwise(F.col("text")))


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = find_phrases(spark, docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


QUERIES = {"op7_benchmark_decontamination": op7_benchmark_decontamination}
ORACLE = {"op7_benchmark_decontamination": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM benchmark),
items AS (SELECT item_id, w, least(len(w), 10) AS size FROM b WHERE len(w) > 0),
windows AS (SELECT DISTINCT item_id, size, array_to_string(w[i:i + size - 1], ' ') AS gram
            FROM (SELECT item_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM items)),
grams AS (SELECT doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') AS gram
          FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i
                FROM d JOIN (SELECT DISTINCT size FROM windows) ON len(w) >= size)),
found AS (SELECT doc_id, item_id, i, size FROM grams JOIN windows USING (size, gram)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM found) GROUP BY doc_id),
runs AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
         FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM found) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN runs USING (doc_id)"""}
