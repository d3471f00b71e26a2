"""Approximate nearest neighbours by balanced posting lists.

Vectors are lifted onto a sphere, where the largest inner product is the least distance.
A bounded sample gives the centroids: leaves of equal size of a tree of median cuts, moved
by a few rounds of means in which large lists become dearer.  The centroids and a graph of
their neighbours are small enough for every task; searches walk the graph.  Each vector is
posted to its nearest list and, near a boundary, to further ones.  A query opens the lists
whose distance is within a ratio of the nearest one's; the ratio is measured on the sample,
so that the wanted share of neighbours is met whether the vectors form clusters or not.

Lists and queries meet in blocks: a list of many vectors is cut into parts, the queries of a
list into shares, and of a block only the vectors are held while its queries pass.  Of equal vectors
only the smallest ids can be among the nearest, so no group of copies is posted whole; equal queries
are searched once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from curate.llm.textbytes import materialise

#: Vectors a list should hold, and the most lists there are (their centroids go to every task).
LIST, MOST_LISTS = 512, 16_384
#: The sample that the lists are fitted on: so many vectors a list, within these bounds (and 64 MB).
PER_LIST, SAMPLE = 32, (8_192, 65_536)
SAMPLE_VALUES = 1 << 24
#: A vector is posted to so many lists at most, if they are so much farther at most than the nearest one.
COPIES, BOUNDARY = 3, 1.05
#: Share of the sample's neighbours that the opened lists must hold.
TARGET = 0.95
#: Vectors of a block, and its queries; neighbours and entries of the graph's walk.
PART, SHARE = 8_192, 32_768
DEGREE, BEAM, ROWS = 16, 24, 128


def _squares(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] - 2 * (x @ c.T) + (c * c).sum(1)[None, :], 0)


def lifted(x: np.ndarray, radius: float, query: bool) -> np.ndarray:
    """Vectors on a sphere of that radius, one dimension up; of queries only the direction counts."""
    square = (x.astype(np.float64) ** 2).sum(1)
    if query:
        return np.concatenate([x * (radius / np.sqrt(square))[:, None], np.zeros((len(x), 1))], 1).astype(np.float32)
    return np.concatenate([x, np.sqrt(np.maximum(radius * radius - square, 0))[:, None]], 1).astype(np.float32)


def _leaves(x: np.ndarray, rows: np.ndarray, n: int, rng: np.random.Generator) -> Iterator[np.ndarray]:
    """Parts of ``rows`` of nearly equal size, cut across the direction of two distant means."""
    if n <= 1 or len(rows) <= 1:
        yield rows
        return
    a, b = x[rows[rng.integers(len(rows))]], x[rows[rng.integers(len(rows))]]
    for _ in range(3):
        side = ((x[rows] - (a + b) / 2) @ (b - a)) > 0
        if side.all() or not side.any():
            break
        a, b = x[rows[~side]].mean(0), x[rows[side]].mean(0)
    order = rows[np.argsort(x[rows] @ (b - a), kind="stable")]
    cut = max(1, len(rows) * (n // 2) // n)
    yield from _leaves(x, order[:cut], n // 2, rng)
    yield from _leaves(x, order[cut:], n - n // 2, rng)


@dataclass
class Lists:
    """Centroids, the graph of their neighbours, and the ratio within which lists are opened."""

    radius: float
    centroids: np.ndarray
    graph: np.ndarray
    entries: np.ndarray
    ratio: float = 1.0

    @classmethod
    def fit(cls, sample: np.ndarray, n_lists: int, radius: float, k: int = 20, target: float = TARGET, rounds: int = 5) -> Lists:
        """Lists fitted on a sample (rows are vectors); at least one, of at least one vector."""
        rng = np.random.default_rng(17)
        x = lifted(sample, radius, False)
        c = np.array([x[r].mean(0) for r in _leaves(x, np.arange(len(x)), n_lists, rng)], np.float32)
        price = np.zeros(len(c))
        for _ in range(rounds):
            near = np.empty(len(x), np.int64)
            for i in range(0, len(x), 4096):
                near[i:i + 4096] = (_squares(x[i:i + 4096], c) + price).argmin(1)
            size = np.bincount(near, minlength=len(c))
            total = np.zeros_like(c)
            np.add.at(total, near, x)
            spread = float(((x - c[near]) ** 2).sum(1).mean())
            c = np.where(size[:, None] > 0, total / np.maximum(size, 1)[:, None], c)
            price += 0.05 * spread * (size / (len(x) / len(c)) - 1)
        degree = min(DEGREE, len(c) - 1)
        graph = np.zeros((len(c), degree), np.int32)
        for i in range(0, len(c), 1024):
            d = _squares(c[i:i + 1024], c)
            d[np.arange(len(d)), np.arange(i, i + len(d))] = np.inf
            graph[i:i + 1024] = np.argsort(d, 1)[:, :degree]
        jumps = rng.integers(0, len(c), (len(c), 4)).astype(np.int32)          # edges that join distant regions
        entries = np.unique(np.linspace(0, len(c) - 1, int(np.ceil(np.sqrt(len(c))))).astype(np.int64))
        lists = cls(radius, c, np.concatenate([graph, jumps], 1), entries)
        lists.ratio = lists._measured(sample, x, k, target)
        return lists

    def _measured(self, sample: np.ndarray, x: np.ndarray, k: int, target: float) -> float:
        """How much farther than the nearest list the lists of a query's neighbours are, for ``target`` of them."""
        asked = np.linspace(0, len(x) - 1, min(len(x), 256)).astype(np.int64)
        if len(x) < 2 or len(self.centroids) < 2:
            return 1.0
        score = sample[asked].astype(np.float64) @ sample.T
        score[np.arange(len(asked)), asked] = -np.inf
        k = min(k, len(x) - 1)
        best = np.argpartition(-score, k - 1, 1)[:, :k]
        far = _squares(lifted(sample[asked], self.radius, True), self.centroids)
        held, _ = self.posted(x[best.ravel()])
        held = held.reshape(len(asked), -1)                                    # k * COPIES lists each, -1 for none
        away = np.where(held >= 0, np.take_along_axis(far, np.maximum(held, 0), 1), np.inf).reshape(len(asked), k, -1).min(2)
        return float(np.quantile(np.sqrt(away / np.maximum(far.min(1), 1e-12)[:, None]), target, method="higher"))

    def walk(self, x: np.ndarray, ratio: float) -> np.ndarray:
        """Squared distances to the centroids that the walk met, else infinite.  It goes on from every centroid
        within the ratio of the nearest one so far, and from the nearest ``BEAM``."""
        n, beam = len(self.centroids), min(BEAM, len(self.centroids))
        far, done = np.full((len(x), n), np.inf, np.float32), np.zeros((len(x), n), bool)
        q, c = np.repeat(np.arange(len(x)), len(self.entries)), np.tile(self.entries, len(x))
        while len(q):
            for i in range(0, len(q), 1 << 16):
                a, b = q[i:i + (1 << 16)], c[i:i + (1 << 16)]
                far[a, b] = ((x[a] - self.centroids[b]) ** 2).sum(1)
            limit = np.maximum(far.min(1) * ratio * ratio, np.partition(far, beam - 1, 1)[:, beam - 1])
            go = (far <= limit[:, None]) & np.isfinite(far) & ~done
            done |= go
            q, c = np.nonzero(go)
            fresh = np.zeros_like(done)
            fresh[np.repeat(q, self.graph.shape[1]), self.graph[c].ravel()] = True
            q, c = np.nonzero(fresh & np.isinf(far))
        return far

    def posted(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The lists of lifted vectors, nearest first, -1 for none; and how many each has."""
        out = np.full((len(x), COPIES), -1, np.int64)
        for i in range(0, len(x), ROWS):
            far = self.walk(x[i:i + ROWS], 1.0)
            order = np.argsort(far, 1, kind="stable")[:, :COPIES]
            d = np.take_along_axis(far, order, 1)
            out[i:i + ROWS, :order.shape[1]] = np.where(d <= np.maximum(d[:, :1] * BOUNDARY ** 2, d[:, :1]), order, -1)
        return out, (out >= 0).sum(1)

    def opened(self, x: np.ndarray, sizes: np.ndarray, least: int) -> list[np.ndarray]:
        """The lists to read for each vector: within the ratio, and on until they hold ``least`` vectors.
        ``sizes``: how many vectors are nearest to each list."""
        out = []
        x = lifted(x, self.radius, True)
        for i in range(0, len(x), ROWS):
            far = self.walk(x[i:i + ROWS], self.ratio)
            limit = far.min(1) * np.float32(self.ratio ** 2 * (1 + 1e-6))
            for row, most, v in zip(far, limit, x[i:i + ROWS]):
                chosen = np.flatnonzero(row <= most)
                if sizes[chosen].sum() < least:
                    every = np.argsort(_squares(v[None, :], self.centroids)[0], kind="stable")
                    enough = int(np.searchsorted(np.cumsum(sizes[every]), least)) + 1
                    chosen = np.union1d(chosen, every[:enough])
                out.append(chosen)
        return out


# ---------------------------------------------------------------------------


def _matrix(column: pa.Array, kind=np.float64) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1).astype(kind) if len(column) else np.zeros((0, 1), kind)


def _post(batches: Iterator[pa.RecordBatch], lists: Lists) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            held, n = lists.posted(lifted(_matrix(batch.column("vector")), lists.radius, False))
            offsets = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(pa.array(offsets), pa.array(held[held >= 0].astype(np.int32)))], names=[*batch.schema.names, "lists"])


def _open(batches: Iterator[pa.RecordBatch], lists: Lists, sizes: np.ndarray, least: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            found = lists.opened(_matrix(batch.column("vector")), sizes, least)
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(found).astype(np.int32)))], names=[*batch.schema.names, "lists"])


def _best(q: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best different ids of each q, by score, then id."""
    order = np.lexsort((-score, ids, q))
    q, ids, score = q[order], ids[order], score[order]
    new = np.ones(len(q), bool)
    new[1:] = (q[1:] != q[:-1]) | (ids[1:] != ids[:-1])
    q, ids, score = q[new], ids[new], score[new]
    order = np.lexsort((ids, -score, q))
    q, ids, score = q[order], ids[order], score[order]
    start = np.flatnonzero(np.concatenate([[True], q[1:] != q[:-1]])) if len(q) else np.zeros(0, np.int64)
    place = np.arange(len(q)) - np.repeat(start, np.diff(np.append(start, len(q))))
    keep = place < k
    return q[keep], ids[keep], score[keep]


def _scan(batches: Iterator[pa.RecordBatch], k: int, hold: int = 1 << 18) -> Iterator[pa.RecordBatch]:
    """Sorted blocks, the vectors of each before its queries; the k best of each query over the blocks a task has."""
    names = ["qid", "vec_id", "score"]
    key, held, ids, matrix = None, [], None, None
    kept = [[np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]]
    count = 0

    def best():
        return _best(*(np.concatenate(x) for x in kept), k)

    for batch in batches:
        block = np.stack([batch.column(c).to_numpy() for c in ("list", "part", "share")], 1) if batch.num_rows else np.zeros((0, 3))
        body = batch.column("_query").to_numpy(zero_copy_only=False).astype(bool)
        turn = np.flatnonzero(np.concatenate([[True], (block[1:] != block[:-1]).any(1) | (body[1:] != body[:-1])])) if len(block) else []
        for lo, hi in zip(turn, [*turn[1:], len(block)]):
            if key is None or (block[lo] != key).any():
                key, held, matrix = block[lo], [], None
            rows = batch.slice(lo, hi - lo)
            if not body[lo]:
                held.append((rows.column("id").to_numpy(), _matrix(rows.column("vector"))))
                continue
            if not held:
                continue
            if matrix is None:
                ids, matrix = np.concatenate([x for x, _ in held]), np.concatenate([x for _, x in held])
            asked, queries = rows.column("id").to_numpy(), _matrix(rows.column("vector"))
            for i in range(0, len(asked), 256):
                score = queries[i:i + 256] @ matrix.T
                if score.shape[1] > k:                                      # ties of the last place stay in
                    last = np.partition(score, score.shape[1] - k, 1)[:, score.shape[1] - k]
                    q, v = np.nonzero(score >= last[:, None])
                else:
                    q, v = np.nonzero(np.ones_like(score, bool))
                found = _best(asked[i:i + 256][q], ids[v], score[q, v], k)
                for x, y in zip(kept, found):
                    x.append(y)
                count += len(found[0])
                if count > hold:
                    found = best()
                    if len(found[0]) > hold // 2:
                        yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], names=names)
                        found = tuple(x[:0] for x in found)
                    kept, count = [[x] for x in found], len(found[0])
    yield pa.RecordBatch.from_arrays([pa.array(x) for x in best()], names=names)


def _usable(x: Column) -> Column:
    """Not null, no null or non-finite component, not zero."""
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return x.isNotNull() & F.coalesce(fine, F.lit(False)) & F.coalesce(F.exists(x, lambda v: v != 0), F.lit(False))


def _in_blocks(rows: DataFrame, grid: dict[int, tuple[int, int]], query: bool) -> DataFrame:
    """A row for each block it takes part in: a vector in one part and all shares of its list, a query the other way round."""
    spark = rows.sparkSession
    sizes = spark.createDataFrame([(k, *v) for k, v in sorted(grid.items())], "list int, parts int, shares int")
    out = rows.select("id", "vector", F.explode("lists").alias("list")).join(F.broadcast(sizes), "list")
    own = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    part, share = (every("parts"), own("shares")) if query else (own("parts"), every("shares"))
    return out.withColumn("part", part).withColumn("share", share).select("list", "part", "share", F.lit(query).alias("_query"), "id", "vector")


def nearest(vectors: DataFrame, queries: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
            list_size: int = LIST, target: float = TARGET) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k largest inner products of each row for which ``queries``
    holds with the other rows; all of them if there are fewer.  Ties go to the smaller id.

    Vectors that are null, zero, or hold null or non-finite components take no part; nor do rows
    without an id or of another length than most (of equally common lengths the greatest).
    Of rows that share an id the nearest counts, none for a query of that id; each of their vectors is a query.
    Other columns are not read.  The result is approximate: ``target`` is the share of neighbours
    aimed at.  An empty table gives no rows.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).alias("vector"), F.coalesce(queries, F.lit(False)).alias("_asks"))
    rows = rows.filter(F.col("id").isNotNull() & _usable(F.col("vector")))
    common = rows.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    rows = rows.filter(F.size("vector") == F.lit(common.d if common else 0))
    square = F.aggregate("vector", F.lit(0.0), lambda s, v: s + v.cast("double") * v.cast("double"))

    place = F.row_number().over(Window.partitionBy("vector").orderBy("id"))
    candidates = materialise(rows.select("id", "vector").distinct().withColumn("_n", place).filter(F.col("_n") <= k + 1).drop("_n").withColumn("_square", square), "vectors")
    asked = materialise(rows.filter("_asks").select("vector").distinct().select("vector", F.monotonically_increasing_id().alias("id")), "queries")
    total = candidates.agg(F.count(F.lit(1)).alias("n"), F.max("_square").alias("square")).first()
    if not total.n:
        return rows.limit(0).select(F.col("id").alias("query_id"), F.lit(1).alias("rank"), F.col("id").alias("vec_id"), F.lit(0.0).alias("score"))

    n_lists = int(min(MOST_LISTS, max(1, -(-total.n // list_size))))
    wanted = int(min(max(SAMPLE[0], PER_LIST * n_lists), SAMPLE[1], max(1024, SAMPLE_VALUES // common.d)))
    share = min(1.0, wanted / total.n)
    sample = candidates.filter(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1).select("id", "vector").toArrow().sort_by("id")
    sample = sample.slice(0, 2 * wanted) if sample.num_rows else candidates.limit(1).select("id", "vector").toArrow()
    held = spark.sparkContext.broadcast(Lists.fit(_matrix(sample["vector"].combine_chunks(), np.float32), n_lists, float(np.sqrt(total.square)), k, target))

    with_lists = lambda df: candidates.sparkSession.createDataFrame([], df.schema).withColumn("lists", F.lit(None).cast("array<int>")).schema
    base = candidates.select("id", "vector")
    posted = materialise(base.mapInArrow(lambda b: _post(b, held.value), with_lists(base)), "posted")
    first = {r.list: r.n for r in posted.groupBy(F.col("lists")[0].alias("list")).agg(F.count(F.lit(1)).alias("n")).collect()}
    sizes = np.array([first.get(i, 0) for i in range(len(held.value.centroids))], np.int64)
    probed = materialise(asked.mapInArrow(lambda b: _open(b, held.value, sizes, k + 1), with_lists(asked)), "probed")

    count = lambda df: {r.list: r.n for r in df.select(F.explode("lists").alias("list")).groupBy("list").agg(F.count(F.lit(1)).alias("n")).collect()}
    vectors_of, queries_of = count(posted), count(probed)
    grid = {i: (-(-n // PART), -(-queries_of[i] // SHARE)) for i, n in vectors_of.items() if i in queries_of}
    blocks = _in_blocks(posted, grid, False).unionByName(_in_blocks(probed, grid, True))
    blocks = blocks.repartition("list", "part", "share").sortWithinPartitions("list", "part", "share", "_query")
    found = blocks.mapInArrow(lambda b: _scan(b, k + 1), "qid long, vec_id long, score double").repartition("qid")
    found = found.groupBy("qid", "vec_id").agg(F.max("score").alias("score"))
    found = found.withColumn("place", F.row_number().over(Window.partitionBy("qid").orderBy(F.desc("score"), "vec_id"))).filter(F.col("place") <= k + 1)
    best = found.groupBy("qid").agg(F.array_sort(F.collect_list(F.struct("place", "vec_id", "score"))).alias("hits"))
    best = best.join(asked, best.qid == asked.id).select("vector", "hits")
    answers = rows.filter("_asks").select(F.col("id").alias("query_id"), "vector").distinct().join(best, "vector")
    others = F.slice(F.filter("hits", lambda h: h["vec_id"] != F.col("query_id")), 1, k)
    return (answers.select("query_id", F.posexplode(others).alias("rank", "hit"))
            .select("query_id", (F.col("rank") + 1).alias("rank"), F.col("hit.vec_id").alias("vec_id"), F.col("hit.score").alias("score")))


def op11_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 20 == 0)


QUERIES = {"op11_nearest_neighbours": op11_nearest_neighbours}
ORACLE: dict[str, str] = {}
