"""N-gram Jaccard join by prefix trees.

Every text becomes a set of n-gram hashes under one global order (n-grams known to be
frequent first, the others by hash).  Equal sets fold into one entity.  Two sets that
reach the threshold share k of their last ``n - ceil(t*n) + k`` n-grams in that order, so
only those are shuffled, entities meet where they share one, and pairs that share fewer than
k (1 for small sets, up to SHARED) are no candidates.

Links are found without listing the pairs of a group.  In a star round every member
of a group meets the group's leader only; verified links merge entities to
components; the next round looks only at groups that still hold several
components.  In the last round small groups (a fixed size) list their pairs, which are counted;
the large groups of one leader are joined to a family, where every member outside the largest
component meets all members of other components, in blocks.  So no link between different
components is missed.  Candidates pass exact bounds (lengths, then a histogram
of the sets) before whole sets are compared.

Sets are compared in prefix trees: the candidates of one probe are stored in global
order, shared leading n-grams once; the probe walks the tree, keeps the overlap of
shared paths and leaves a subtree when the overlap plus what remains on either side
can't reach the threshold.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from curate.llm.textbytes import LOWER, NOT_SPACE, U64, buffer, chunks, materialise, mix, prefix_hash, signed, span_hash, words

CHUNK = 1 << 20
#: N-grams kept as frequent (by count over all texts), which bounds what is broadcast.
FREQUENT = 1 << 18
#: Buckets of a set's histogram at least; larger sets have twice, four times ... as many, with at least PER_BUCKET n-grams
#: each, since full buckets of unlike sets are much alike.
BUCKETS, PER_BUCKET = 64, 4
#: A full bucket, which bounds nothing; cells of histograms that are compared at a time.
FULL, CELLS = 255, 1 << 20
#: Candidates of one probe that share a tree; more of them make further trees.
TREE = 512
#: Probes of a family, and n-grams of them on average, that are held together while its members pass.
BLOCK, BLOCK_GRAMS = 1024, 1 << 22
#: Members of a group up to which the last round lists its pairs (at most SMALL / 2 a row).
SMALL = 16
#: Star rounds before the last round, which misses no link (more of them help where families chain).
STAR_ROUNDS = 1
#: N-grams that a candidate pair shares among its last ones (which are as many more): one, and one
#: more for every PER_SHARED n-grams of the set, up to SHARED.
SHARED, PER_SHARED = 4, 60
#: Entities below which their ids are broadcast instead of shuffling the texts.
BROADCAST_IDS = 1_000_000
_MULT = (U64(3), U64(0x9E3779B97F4A7C15), U64(0xC2B2AE3D27D4EB4F), U64(0x165667B19E3779F9), U64(0x27D4EB2F165667C5))


def gram_sets(buf: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(n-grams, offsets): the sorted distinct n-gram hashes of each document of a chunk."""
    n_docs = len(offsets) - 1
    low = LOWER[buf]
    start, end, doc = words(low, offsets, NOT_SPACE)
    count = np.bincount(doc, minlength=n_docs)
    h = span_hash(prefix_hash(low), start, end)
    grams, owner = np.zeros(0, U64), np.zeros(0, np.int64)
    if len(h) >= size:
        total = h[:len(h) - size + 1] * _MULT[0]
        for k in range(1, size):
            total = mix(total) + h[k:len(h) - size + 1 + k] * _MULT[k % len(_MULT)]
        ok = doc[:len(h) - size + 1] == doc[size - 1:]
        grams, owner = mix(total)[ok], doc[:len(h) - size + 1][ok]
    short = np.flatnonzero((count > 0) & (count < size))
    if len(short):
        first = np.cumsum(count) - count
        whole = [mix(np.array([hash((int(count[d]), *h[first[d]:first[d] + count[d]].tolist())) & (1 << 64) - 1], U64))[0] for d in short]
        grams, owner = np.concatenate((grams, np.array(whole, U64))), np.concatenate((owner, short))
    order = np.lexsort((grams, owner))
    grams, owner = grams[order], owner[order]
    fresh = np.ones(len(grams), bool)
    fresh[1:] = (grams[1:] != grams[:-1]) | (owner[1:] != owner[:-1])
    grams, owner = grams[fresh], owner[fresh]
    at = np.zeros(n_docs + 1, np.int64)
    np.cumsum(np.bincount(owner, minlength=n_docs), out=at[1:])
    return grams, at


def entity_ids(grams: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A 64-bit id of each document's set (of its n-grams and their number)."""
    sums = np.zeros(len(grams) + 1, U64)
    np.cumsum(mix(grams), out=sums[1:])
    return signed(mix(sums[at[1:]] - sums[at[:-1]] + mix((at[1:] - at[:-1]).astype(U64))))


def order_keys(grams: np.ndarray, frequent: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Keys of the global order: frequent n-grams first (most frequent smallest), then the others."""
    key = (grams >> U64(1)) | U64(1 << 63)
    if len(frequent):
        k = np.minimum(np.searchsorted(frequent, grams), len(frequent) - 1)
        known = frequent[k] == grams
        key[known] = rank[k[known]]
    return key


def histograms(grams: np.ndarray, n: np.ndarray) -> list[bytes]:
    """A histogram of each set (of ``n`` n-grams): a byte a bucket, buckets by the low bits of the n-grams, so that
    neighbouring parts of a large histogram add up to a smaller one."""
    buckets = np.maximum(BUCKETS, 1 << np.log2(np.maximum(n // PER_BUCKET, 1)).astype(np.int64))
    first = np.concatenate(([0], np.cumsum(buckets)))
    cell = np.repeat(first[:-1], n) + (grams & np.repeat(buckets - 1, n).astype(U64)).astype(np.int64)
    flat = np.minimum(np.bincount(cell, minlength=first[-1]), FULL).astype(np.uint8).tobytes()
    return [flat[a:b] for a, b in zip(first.tolist(), first[1:].tolist())]


def _folded(hists: list[bytes], buckets: int) -> np.ndarray:
    """Histograms of one length as counts in ``buckets``; where one was full the count is beyond any set's size."""
    own = np.frombuffer(b"".join(hists), np.uint8).astype(np.int64)
    own[own == FULL] = 1 << 40
    return own.reshape(len(hists), -1, buckets).sum(1)


def coarse(hists: list[bytes]) -> np.ndarray:
    """Counts in BUCKETS, 65535 where one is full."""
    out, sizes = np.zeros((len(hists), BUCKETS), np.uint16), np.array([len(h) for h in hists], np.int64)
    for size in np.unique(sizes).tolist():
        own = np.flatnonzero(sizes == size)
        out[own] = np.minimum(_folded([hists[k] for k in own.tolist()], BUCKETS), 65535)
    return out


def within(hist_a: list[bytes], hist_b: list[bytes], total: np.ndarray, num: int, den: int) -> np.ndarray:
    """Whether the histograms of each pair, with ``total`` n-grams together, leave the threshold within reach."""
    out = np.zeros(len(hist_a), bool)
    sizes = np.array([(len(a), len(b)) for a, b in zip(hist_a, hist_b)], np.int64).reshape(-1, 2)
    for x, y in np.unique(sizes, axis=0).tolist():
        same, step = np.flatnonzero((sizes == (x, y)).all(1)), max(1, CELLS // max(x, y))
        for own in (same[k:k + step] for k in range(0, len(same), step)):
            a, b = (_folded([hists[k] for k in own.tolist()], min(x, y)) for hists in (hist_a, hist_b))
            out[own] = (num + den) * np.minimum(a, b).sum(1) >= num * total[own]
    return out


def _sketch(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    heavy = pa.struct([("gram", pa.int64()), ("n", pa.int64())])
    for batch in batches:
        buf, offsets = buffer(batch.column("text"))
        ids, sizes, hists, every, seen = [], [], [], [], set()
        for i, j in chunks(offsets, CHUNK):
            grams, at = gram_sets(buf[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], size)
            own = entity_ids(grams, at)
            n = at[1:] - at[:-1]
            owner = np.repeat(np.arange(j - i), n)
            ids.append(own), sizes.append(n)
            hists += histograms(grams, n)
            fresh = np.array([x not in seen and not seen.add(x) for x in own.tolist()])
            every.append(grams[fresh[owner]] if len(owner) else grams)
        known, count = np.unique(np.concatenate(every) if every else np.zeros(0, U64), return_counts=True)
        often = count >= 2
        known, count = known[often], count[often]
        if len(known) > FREQUENT:
            top = np.argsort(-count, kind="stable")[:FREQUENT]
            known, count = known[top], count[top]
        lengths = np.zeros(len(batch), np.int64)
        if len(batch):
            lengths[0] = len(known)
        values = pa.StructArray.from_arrays([pa.array(signed(known)), pa.array(count.astype(np.int64))], fields=list(heavy))
        at = np.zeros(len(batch) + 1, np.int32)
        np.cumsum(lengths, out=at[1:])
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int64)), pa.array(np.concatenate(sizes) if sizes else np.zeros(0, np.int64)),
             pa.array(hists, pa.binary()), pa.ListArray.from_arrays(pa.array(at), values)],
            names=["doc_id", "entity", "n", "hist", "heavy"])


class Order:
    """The frequent n-grams, sorted by hash, with their ranks (0: the most frequent)."""

    def __init__(self, grams: list[int]):
        known = np.array(grams, np.int64).view(U64)
        by_hash = np.argsort(known, kind="stable")
        self.frequent, self.rank = known[by_hash], by_hash.astype(U64)


def _prefixes(batches: Iterator[pa.RecordBatch], size: int, num: int, den: int, order: Order) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        buf, offsets = buffer(batch.column("text"))
        seen: set[int] = set()
        for i, j in chunks(offsets, CHUNK):
            grams, at = gram_sets(buf[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], size)
            own = entity_ids(grams, at)
            n = at[1:] - at[:-1]
            fresh = np.array([x not in seen and not seen.add(x) for x in own.tolist()]) & (n > 0)
            owner = np.repeat(np.arange(j - i), n)
            key = order_keys(grams, order.frequent, order.rank)
            sort = np.lexsort((key, owner))
            place = np.arange(len(grams)) - at[owner]
            tail = (place >= n[owner] - (n - -(-n * num // den) + np.clip(n // PER_SHARED, 1, SHARED))[owner]) & fresh[owner]
            take = sort[tail]
            yield pa.RecordBatch.from_arrays(
                [pa.array(signed(grams[take])), pa.array(own[owner[tail]]), pa.array(n[owner[tail]].astype(np.int32))], names=["gram", "entity", "n"])


def _sets(batches: Iterator[pa.RecordBatch], size: int, order: Order) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        buf, offsets = buffer(batch.column("text"))
        for i, j in chunks(offsets, CHUNK):
            grams, at = gram_sets(buf[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], size)
            key = order_keys(grams, order.frequent, order.rank)
            keys = [np.sort(key[a:b]).tobytes() for a, b in zip(at[:-1], at[1:])]
            yield pa.RecordBatch.from_arrays([pa.array(entity_ids(grams, at)), pa.array(keys, pa.binary())], names=["entity", "keys"])


class PrefixTree:
    """Sets in global order as a prefix tree: sorted, each with the depth it shares with the one
    before.  A shared path is stored and compared once."""

    STEP = 64

    def __init__(self, sets: list[tuple[int, np.ndarray]]):
        self.sets = sorted(sets, key=lambda s: s[1].astype(">u8").tobytes())
        self.shared = [0]
        for (_, a), (_, b) in zip(self.sets, self.sets[1:]):
            m = min(len(a), len(b))
            differ = np.flatnonzero(a[:m] != b[:m])
            self.shared.append(int(differ[0]) if len(differ) else m)

    def probe(self, keys: np.ndarray, num: int, den: int) -> Iterator[int]:
        """The members that link with the set ``keys``."""
        depths, overlaps, behind = [0], [0], [0]  # along the current path: depth, overlap, probe's keys passed
        for (member, own), shared in zip(self.sets, self.shared):
            while depths[-1] > shared:
                depths.pop(), overlaps.pop(), behind.pop()
            need = -(-num * (len(keys) + len(own)) // (num + den))
            depth, overlap, passed = depths[-1], overlaps[-1], behind[-1]
            while depth < len(own) and overlap + min(len(own) - depth, len(keys) - passed) >= need:
                end = min(depth + self.STEP, len(own))
                part = own[depth:end]
                at = np.searchsorted(keys, part)
                overlap += int((keys[np.minimum(at, len(keys) - 1)] == part).sum()) if len(keys) else 0
                passed = int(np.searchsorted(keys, part[-1], "right"))
                depth = end
                depths.append(depth), overlaps.append(overlap), behind.append(passed)
            if depth == len(own) and overlap >= need:
                yield member


def _verify(batches: Iterator[pa.RecordBatch], num: int, den: int) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by (a, salt, role): the probe's own set, then its candidates."""
    group, probe, waiting = None, None, []

    def flush() -> list[tuple[int, int]]:
        out = [(group[0], m) for m in PrefixTree(waiting).probe(probe, num, den)] if waiting and probe is not None else []
        waiting.clear()
        return out

    found: list[tuple[int, int]] = []
    for batch in batches:
        for a, salt, role, entity, keys in zip(*(batch.column(c).to_pylist() for c in ("a", "salt", "role", "entity", "keys"))):
            if (a, salt) != group:
                found += flush()
                group, probe = (a, salt), None
            if role == 0:
                probe = np.frombuffer(keys, U64)
            else:
                waiting.append((entity, np.frombuffer(keys, U64)))
                if len(waiting) >= TREE:
                    found += flush()
        if found:
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())], names=["a", "b"])
            found = []
    found = flush()
    if found:
        yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())], names=["a", "b"])


def _bounded(batches: Iterator[pa.RecordBatch], num: int, den: int) -> Iterator[pa.RecordBatch]:
    """Pairs whose histograms leave the threshold within reach."""
    for batch in batches:
        total = np.asarray(batch.column("n_a")).astype(np.int64) + np.asarray(batch.column("n_b"))
        keep = pa.array(within(batch.column("hist_a").to_pylist(), batch.column("hist_b").to_pylist(), total, num, den))
        yield batch.select(["a", "b"]).filter(keep)


def _meet(batches: Iterator[pa.RecordBatch], num: int, den: int) -> Iterator[pa.RecordBatch]:
    """Rows come by (lead, block, role): a block's probes, then the members that it meets.  Gives
    the pairs (a: the probe) of different components that the bounds leave."""
    key, probes = None, None
    for batch in batches:
        lead, block, role, entity, n, comp = (np.asarray(batch.column(c)) for c in ("lead", "block", "role", "entity", "n", "comp"))
        hist = np.array([*batch.column("hist").to_pylist(), b""], object)[:-1]
        rough = coarse(hist.tolist())
        edge = np.flatnonzero((np.diff(lead) != 0) | (np.diff(block) != 0) | (np.diff(role) != 0)) + 1 if len(batch) else np.zeros(0, int)
        for lo, hi in zip([0, *edge.tolist()], [*edge.tolist(), len(batch)]):
            if lo == hi:
                continue
            a, b = [], []
            part = (entity[lo:hi], n[lo:hi].astype(np.int64), comp[lo:hi], rough[lo:hi], hist[lo:hi])
            if role[lo] == 0:
                again = key == (lead[lo], block[lo])
                probes = tuple(np.concatenate(x) for x in zip(probes, part)) if again else part
                key = (lead[lo], block[lo])
                continue
            for i in range(len(probes[0])):
                size = probes[1][i] + part[1]
                near = np.flatnonzero((probes[2][i] != part[2]) & (np.minimum(probes[1][i], part[1]) * den >= np.maximum(probes[1][i], part[1]) * num))
                if len(near):
                    least = np.minimum(probes[3][i], part[3][near])
                    most = least.sum(1, dtype=np.int64) + (least == 65535).sum(1) * (1 << 40)  # a full bucket bounds nothing
                    near = near[(num + den) * most >= num * size[near]]
                    near = near[within([probes[4][i]] * len(near), part[4][near].tolist(), size[near], num, den)]
                    a.append(np.full(len(near), probes[0][i])), b.append(part[0][near])
            if a:
                x, y = np.concatenate(a), np.concatenate(b)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), c)) for c in key] + [pa.array(x), pa.array(y)], names=["lead", "block", "a", "b"])


def _verify_family(batches: Iterator[pa.RecordBatch], num: int, den: int) -> Iterator[pa.RecordBatch]:
    """Rows come by (lead, block, role): the sets of a block's probes, then each member that passes, with the probes it is a pair with (``among``)."""
    group, held = None, {}
    for batch in (whole.slice(i, TREE) for whole in batches for i in range(0, whole.num_rows, TREE)):
        found: list[tuple[int, int]] = []
        for lead, block, role, entity, keys, among in zip(*(batch.column(c).to_pylist() for c in ("lead", "block", "role", "entity", "keys", "among"))):
            if (lead, block) != group:
                group, held = (lead, block), {}
            own = np.frombuffer(keys, U64)
            if role == 0:
                held[entity] = own
                continue
            for k in range(0, len(among), TREE):
                found += [(entity, m) for m in PrefixTree([(m, held[m]) for m in among[k:k + TREE]]).probe(own, num, den)]
        if found:
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())], names=["a", "b"])


def connect(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, root): connected components of (a, b) links by alternating large and small stars;
    root is the smallest node.  Every step is a join and an aggregation on nodes."""
    edges = edges.filter("a <> b").distinct()
    while True:
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lowest, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = materialise(small.unionByName(lowest.select("a", F.col("m").alias("b"))).distinct(), name)
        # done when every node points to one node that points nowhere
        twice = edges.groupBy("a").count().filter("count > 1").select("a")
        if twice.unionByName(edges.select(F.col("b").alias("a")).join(edges.select("a"), "a", "left_semi")).isEmpty():
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


class _Join:
    """State of one join: entities, the groups of entities that share a prefix n-gram, texts."""

    def __init__(self, docs: DataFrame, size: int, threshold: tuple[int, int]):
        self.docs, self.size, (self.num, self.den) = docs, size, threshold
        spark = docs.sparkSession
        rows = materialise(docs.mapInArrow(lambda b: _sketch(b, size), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, entity bigint, n bigint, hist binary, heavy array<struct<gram:bigint,n:bigint>>"), "sketch")
        self.rows = rows.select("doc_id", "entity", "n")
        self.entities = materialise(rows.filter("n > 0").groupBy("entity").agg(F.min("doc_id").alias("min_id"), F.first("n").alias("n"), F.first("hist").alias("hist")), "entities")
        often = (rows.filter(F.size("heavy") > 0).select(F.explode("heavy").alias("h")).groupBy("h.gram").agg(F.sum("h.n").alias("n"))
                 .orderBy(F.desc("n"), "gram").limit(FREQUENT).select("gram"))
        self.order = spark.sparkContext.broadcast(Order([r.gram for r in often.collect()]))

    def groups(self) -> DataFrame:
        """(gram, entity, n) of the groups in which lengths leave some link possible."""
        order, size, num, den = self.order, self.size, self.num, self.den
        prefixes = self.docs.mapInArrow(lambda b: _prefixes(b, size, num, den, order.value), "gram bigint, entity bigint, n int")
        single = prefixes.repartition("gram").groupBy("gram", "entity").agg(F.first("n").alias("n"))
        near = Window.partitionBy("gram").orderBy("n")
        close = ((F.lag("n").over(near) * den >= F.col("n") * num) | (F.col("n") * den >= F.lead("n").over(near) * num))
        return materialise(single.withColumn("close", close).filter("close").drop("close"), "groups")

    def bounded(self, pairs: DataFrame) -> DataFrame:
        """Pairs (a, b) within the length and histogram bounds."""
        ent = self.entities
        num, den = self.num, self.den
        both = (pairs.join(ent.select(F.col("entity").alias("a"), F.col("n").alias("n_a"), F.col("hist").alias("hist_a")), "a")
                .join(ent.select(F.col("entity").alias("b"), F.col("n").alias("n_b"), F.col("hist").alias("hist_b")), "b"))
        return materialise(both.mapInArrow(lambda x: _bounded(x, num, den), "a bigint, b bigint"), "pairs")

    def families(self, members: DataFrame) -> DataFrame:
        """Pairs (lead, block, a, b) of different components within the bounds, from (lead, entity, n, comp).

        All groups of one leader are a family.  The members outside its largest component are
        dealt out in blocks; each block meets all members of the family, which pass by as a stream.  A pair is
        given once: in one family, and of two probes with one as ``a``.
        """
        num, den = self.num, self.den
        own, same = Window.partitionBy("lead"), Window.partitionBy("lead", "comp")
        once = members.repartition("lead").groupBy("lead", "entity").agg(F.first("n").alias("n"), F.first("comp").alias("comp"))
        sized = once.withColumn("size", F.count("*").over(same)).withColumn("other", F.max(F.struct("size", "comp")).over(own)["comp"] != F.col("comp"))
        blocks = F.ceil(F.greatest(F.sum(F.col("other").cast("int")).over(own) / BLOCK, F.sum(F.when(F.col("other"), F.col("n"))).over(own) / BLOCK_GRAMS))
        rows = materialise(sized.withColumn("blocks", blocks).filter("blocks > 0").drop("size").join(self.entities.select("entity", "hist"), "entity"), "families")
        probes = rows.filter("other").withColumn("block", F.pmod(F.xxhash64("entity"), F.col("blocks"))).withColumn("role", F.lit(0))
        passing = rows.withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1))).withColumn("role", F.lit(1))
        dealt = (probes.unionByName(passing).select("lead", "block", "role", "entity", "n", "comp", "hist")
                 .repartition("lead", "block").sortWithinPartitions("lead", "block", "role"))
        found = dealt.mapInArrow(lambda b: _meet(b, num, den), "lead bigint, block bigint, a bigint, b bigint")
        once = found.groupBy(F.least("a", "b").alias("x"), F.greatest("a", "b").alias("y")).agg(F.min(F.struct("lead", "block", "a", "b")).alias("p"))
        return materialise(once.select("p.*"), "pairs")

    def sets(self, pairs: DataFrame) -> DataFrame:
        """(entity, keys): the sets, in global order, of all entities in ``pairs``."""
        wanted = materialise(pairs.select(F.explode(F.array("a", "b")).alias("entity")).distinct().join(self.entities.select("entity", "min_id"), "entity"), "wanted")
        ids = wanted.select(F.col("min_id").alias("doc_id"), F.col("entity").alias("_wanted"))
        few = wanted.count() <= BROADCAST_IDS
        texts = self.docs.join(F.broadcast(ids) if few else ids, "doc_id").select("text")
        if not wanted.filter("min_id is null").isEmpty():  # sets that only rows with a null id have
            texts = texts.unionByName(self.docs.filter("doc_id is null").select("text"))
        size, order = self.size, self.order
        # of rows that share an id, the text that makes the entity counts, once
        sets = texts.mapInArrow(lambda b: _sets(b, size, order.value), "entity bigint, keys binary")
        return materialise(sets.join(F.broadcast(wanted.select("entity")) if few else wanted.select("entity"), "entity", "left_semi").dropDuplicates(["entity"]), "sets")

    def links(self, pairs: DataFrame, sets: DataFrame | None = None) -> DataFrame:
        """The pairs that link, by prefix trees of each probe's candidates."""
        sets, num, den = self.sets(pairs) if sets is None else sets, self.num, self.den
        crowd = pairs.groupBy("a").agg(F.count("*").alias("n_b")).filter(F.col("n_b") > TREE)
        salted = pairs.join(crowd, "a", "left").select("a", "b", F.coalesce(F.pmod(F.xxhash64("b"), F.ceil(F.col("n_b") / TREE)), F.lit(0)).cast("bigint").alias("salt"))
        members = salted.join(sets, F.col("b") == F.col("entity")).select("a", "salt", F.lit(1).alias("role"), "entity", "keys")
        probes = salted.select("a", "salt").distinct().join(sets, F.col("a") == F.col("entity")).select("a", "salt", F.lit(0).alias("role"), "entity", "keys")
        rows = probes.unionByName(members).repartition("a", "salt").sortWithinPartitions("a", "salt", "role")
        return materialise(rows.mapInArrow(lambda b: _verify(b, num, den), "a bigint, b bigint"), "links")

    def family_links(self, pairs: DataFrame, sets: DataFrame) -> DataFrame:
        """As ``links``, of the pairs of ``families``: a set travels once for each block that it meets, however many pairs it has there."""
        num, den = self.num, self.den
        columns = ["lead", "block", "role", "entity", "keys", "among"]
        held = (pairs.select("lead", "block", F.col("a").alias("entity")).distinct().join(sets, "entity")
                .withColumn("role", F.lit(0)).withColumn("among", F.lit(None).cast("array<bigint>")))
        passing = (pairs.groupBy("lead", "block", F.col("b").alias("entity")).agg(F.collect_list("a").alias("among")).join(sets, "entity")
                   .withColumn("role", F.lit(1)))
        rows = held.select(columns).unionByName(passing.select(columns)).repartition("lead", "block").sortWithinPartitions("lead", "block", "role")
        return materialise(rows.mapInArrow(lambda b: _verify_family(b, num, den), "a bigint, b bigint"), "links")


def components(docs: DataFrame, size: int = 5, threshold: tuple[int, int] = (80, 100), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id.

    Texts link when their sets of ``size``-word shingles have a Jaccard similarity of
    ``threshold`` (a fraction) or more; component_id is the smallest doc_id reachable by links.
    A text with fewer words is one shingle; without words (or null) it is empty, links with
    nothing and is its own component.  Rows with a null id take part; their component is the
    smallest id that is not null, if there is one.  Repeated rows are equal sets and so one
    component.  An empty table gives no rows.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    join = _Join(docs, size, threshold)
    num, den = threshold
    split = join.groups().withColumn("comp", F.col("entity"))
    whole, same = Window.partitionBy("gram"), Window.partitionBy("gram", "comp")
    close = F.least("n_a", "n_b") * den >= F.greatest("n_a", "n_b") * num
    enough = F.count("*") >= F.min(F.greatest(F.lit(1), F.least(F.lit(SHARED), F.floor(F.least("n_a", "n_b") / PER_SHARED))))
    links = roots = None
    for k in range(STAR_ROUNDS + 1):
        if roots is not None:
            split = split.select("gram", "entity", "n").join(roots, F.col("entity") == F.col("node"), "left").select("gram", "entity", "n", F.coalesce("root", "entity").alias("comp"))
        sized = split.withColumn("size", F.count("*").over(same)).withColumn("lead_comp", F.max(F.struct("size", "comp")).over(whole)["comp"])
        split = materialise(sized.withColumn("others", F.sum((F.col("comp") != F.col("lead_comp")).cast("int")).over(whole)).filter("others > 0").drop("others", "size", "lead_comp"), "split")
        # a group's leader is the member whose n-grams are shared most
        central = split.withColumn("m", F.count("*").over(whole)).groupBy("entity").agg(F.sum("m").alias("degree"))
        led = split.join(central, "entity").withColumn("lead", F.max(F.struct("degree", "entity", "n", "comp")).over(whole))
        if k < STAR_ROUNDS:  # each member meets the leader
            meet = led.filter(F.col("comp") != F.col("lead.comp")).select(F.col("entity").alias("b"), F.col("n").alias("n_b"), F.col("lead.entity").alias("a"), F.col("lead.n").alias("n_a"))
            pairs = join.bounded(meet.filter(close).groupBy("a", "b").agg(enough.alias("enough")).filter("enough").select("a", "b"))
        else:
            # small groups give their pairs, counted; a pair that a large group holds is met in its family
            led = materialise(led.select("gram", "entity", "n", "comp", F.col("lead.entity").alias("lead"), (F.count("*").over(whole) <= SMALL).alias("small")), "led")
            few = led.filter("small")
            x, y = (few.select("gram", F.col("entity").alias(e), F.col("n").alias(f"n_{e}"), F.col("comp").alias(f"c_{e}")) for e in "ab")
            meet = x.join(y, "gram").filter((F.col("a") < F.col("b")) & (F.col("c_a") != F.col("c_b"))).filter(close)
            pairs = join.bounded(meet.groupBy("a", "b").agg(enough.alias("enough")).filter("enough").select("a", "b"))
            crowded = join.families(led.filter("not small").select("lead", "entity", "n", "comp"))
        sets = join.sets(pairs if k < STAR_ROUNDS else pairs.unionByName(crowded.select("a", "b")))
        found = join.links(pairs, sets)
        if k == STAR_ROUNDS:
            found = found.unionByName(join.family_links(crowded, sets))
        if found.isEmpty():
            continue
        links = found if links is None else links.unionByName(found)
        roots = connect(links)
    if roots is None:
        roots = join.entities.select(F.col("entity").alias("node"), F.col("entity").alias("root")).limit(0)
    labelled = join.entities.select("entity", "min_id").join(roots, F.col("entity") == F.col("node"), "left").select("entity", "min_id", F.coalesce("root", "entity").alias("root"))
    smallest = labelled.groupBy("root").agg(F.min("min_id").alias("component_id"))
    named = materialise(labelled.join(smallest, "root").select(F.col("entity").alias("_e"), "component_id"), "named")
    return (join.rows.join(named, F.col("entity") == F.col("_e"), "left")
            .select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")))


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return components(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), 4, (85, 100))


QUERIES = {"op2_ngram_jaccard": op2_ngram_jaccard}
ORACLE = {"op2_ngram_jaccard": r"""
WITH RECURSIVE d AS MATERIALIZED (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS MATERIALIZED (SELECT DISTINCT doc_id, g FROM (
    SELECT doc_id, array_to_string(w[i:i + 3], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 2)) AS i FROM d WHERE len(w) >= 4)
    UNION ALL SELECT doc_id, array_to_string(w, ' ') FROM d WHERE len(w) BETWEEN 1 AND 3)),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS MATERIALIZED (SELECT x, y FROM shared JOIN sizes s ON s.doc_id = x JOIN sizes t ON t.doc_id = y WHERE 100 * k >= 85 * (s.n + t.n - k)),
edges AS MATERIALIZED (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach(doc_id, other) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.doc_id, e.y FROM reach r JOIN edges e ON r.other = e.x)
SELECT d.doc_id, coalesce(any_value(s.n), 0)::BIGINT AS n_shingles, min(r.other) AS component_id
FROM d JOIN reach r USING (doc_id) LEFT JOIN sizes s USING (doc_id) GROUP BY d.doc_id"""}
