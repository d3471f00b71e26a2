"""Toxicity: a convolutional text classifier trained in numpy.

Words (lower-case, without punctuation) are hashed to embeddings, a word's being the sum of those
of the word and of its beginnings (so forms of one stem share what is learned); filters of one, two and
three words run over the whole text, each filter's maximum goes to a logistic output.
It is trained on all labelled documents, in rounds in which partitions train copies that are averaged.
A fifth of the documents that is not trained on sets the score's scale, so that 0.3 is the best cut,
and a threshold by language.  For scoring, all filter positions are one matrix product over a chunk's
words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from curate.llm import averaging
from curate.llm.textbytes import ALNUM, LOWER, U64, buffer, chunks, crc32_mod, materialise, prefix_hash, span_hash, words

CHUNK = 1 << 18
#: Labelled documents, and bytes of their words, that a task holds at a time; a partition trained on has at least so many documents, if there are.
GROUP, GROUP_BYTES = 4_096, 32 << 20
HASHED, DIM, FILTERS, WIDTHS = 1 << 15, 12, 12, (1, 2, 3)
EPOCHS, BATCH, RATE, SEED = 6, 32, 0.02, 11
CUT = 0.3
#: Bytes of the beginnings of a word that have an embedding besides the word.
BEGINNINGS = (4, 5, 6)
IDS = 1 + len(BEGINNINGS)


def word_ids(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(a row of hashed ids a word, words of each document) of a chunk."""
    low = LOWER[buf]
    start, end, doc = words(low, offsets, ALNUM)
    prefix = prefix_hash(low)
    ids = np.stack([(span_hash(prefix, start, e) >> U64(40)).astype(np.int64) % HASHED for e in (end, *(np.minimum(start + b, end) for b in BEGINNINGS))], axis=1)
    return ids.astype(np.int32), np.bincount(doc, minlength=len(offsets) - 1)


class TextCNN:
    """Embedding (the last row is padding), filters by width, output weights and bias."""

    def __init__(self, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.embed = rng.normal(0, 0.1, (HASHED + 1, DIM)).astype(np.float32)
        self.embed[-1] = 0
        self.filters = [rng.normal(0, 0.3, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS]
        self.out = rng.normal(0, 0.1, FILTERS * len(WIDTHS)).astype(np.float32)
        self.bias = np.float32(0)
        self.scale, self.shift = 1.0, 0.0
        self.by_lang: dict[str, float] = {}

    def warm_start(self, seen: np.ndarray, n: np.ndarray) -> None:
        """One embedding dimension starts as the log-odds of a word's presence in toxic documents:
        ``seen`` counts the clean and the toxic documents (``n``) of every word."""
        odds = np.log((seen[1] + 0.5) / (n[1] + 1)) - np.log((seen[0] + 0.5) / (n[0] + 1))
        self.embed[:, 0] = np.clip(np.where(seen.sum(0) >= 3, odds, 0), -2, 4)
        self.embed[-1] = 0
        self.filters[0][0, :, 0] = 0
        self.filters[0][0, 0, 0] = 1
        self.out[0], self.bias = 1, np.float32(-3)

    def arrays(self) -> dict[str, np.ndarray]:
        """What training changes, with Adam's moments and steps."""
        own = {"embed": self.embed, **{f"filters{k}": f for k, f in enumerate(self.filters)}, "out": self.out}
        zero = {f"{m}_{n}": np.zeros_like(a) for m in "mv" for n, a in own.items()}
        return {**own, **zero, "bias": np.array([self.bias], np.float32), "step": np.zeros(1)}

    def take(self, state: dict[str, np.ndarray]) -> None:
        self.embed, self.out, self.bias = state["embed"], state["out"], np.float32(state["bias"][0])
        self.filters = [state[f"filters{k}"] for k in range(len(WIDTHS))]

    def positions(self, ids: np.ndarray) -> np.ndarray:
        """Every filter's value at every word of padded ids."""
        n = len(ids) - max(WIDTHS) + 1
        x = sum(self.embed[ids[:, k]] for k in range(IDS))
        y = x @ np.concatenate([f[k] for f in self.filters for k in range(len(f))], axis=1)
        out, at = np.empty((n, FILTERS * len(WIDTHS)), np.float32), 0
        for k, w in enumerate(WIDTHS):
            own = out[:, k * FILTERS:(k + 1) * FILTERS]
            own[:] = y[:n, at:at + FILTERS]
            for j in range(1, w):
                own += y[j:n + j, at + j * FILTERS:at + (j + 1) * FILTERS]
            at += w * FILTERS
        return out

    def train(self, docs: list[np.ndarray], labels: np.ndarray, state: dict[str, np.ndarray], epoch: int, seed: int = SEED) -> None:
        """An epoch of Adam on the logistic loss, in the arrays of ``state``; only the words under a maximum get a gradient."""
        rng = np.random.default_rng(seed)
        pad = np.full((max(WIDTHS), IDS), HASHED, np.int32)
        docs = [np.concatenate((d, pad[1:])) if len(d) else pad for d in docs]
        names = ["embed", *(f"filters{k}" for k in range(len(WIDTHS))), "out"]
        self.take(state)
        for _ in range(epoch + 1):
            order = rng.permutation(len(docs))
        for b in range(0, len(docs), BATCH):
            state["step"] += 1
            step = float(state["step"][0])
            batch = order[b:b + BATCH]
            count = np.array([len(docs[d]) for d in batch])
            ids, first = np.concatenate([docs[d] for d in batch]), np.cumsum(count) - count
            y = self.positions(ids)
            # a text's last places are its padding's
            place = np.stack([a + y[a:a + n - max(WIDTHS) + 1].argmax(0) for a, n in zip(first.tolist(), count.tolist())])
            most = np.take_along_axis(y, place, 0)
            act = np.maximum(most, 0)
            p = 1 / (1 + np.exp(-(act @ self.out + self.bias)))
            delta = ((p - labels[batch]) / len(batch)).astype(np.float32)
            back = delta[:, None] * self.out * (most > 0)
            grads, rows, values = {"out": delta @ act}, [], []
            for k, w in enumerate(WIDTHS):
                own, at = back[:, k * FILTERS:(k + 1) * FILTERS], place[:, k * FILTERS:(k + 1) * FILTERS]
                grads[f"filters{k}"] = np.empty_like(self.filters[k])
                for j in range(w):
                    word = ids[at + j]
                    grads[f"filters{k}"][j] = np.einsum("bf,bfd->df", own, self.embed[word].sum(2))
                    rows.append(word.reshape(-1, IDS))
                    values.append((own[:, :, None] * self.filters[k][j].T).reshape(-1, DIM))
            state["bias"] -= np.float32(RATE * delta.sum())
            self.bias = state["bias"][0]
            flat = np.concatenate(rows).ravel()
            by_row = np.argsort(flat, kind="stable")
            row, begin = np.unique(flat[by_row], return_index=True)
            grads["embed"] = np.add.reduceat(np.concatenate(values)[by_row // IDS], begin, axis=0)
            fade = RATE * np.sqrt(1 - 0.999 ** step) / (1 - 0.9 ** step)
            for n in names:
                at, g, m, v = row if n == "embed" else slice(None), grads[n], state[f"m_{n}"], state[f"v_{n}"]
                m[at] = 0.9 * m[at] + 0.1 * g
                v[at] = 0.999 * v[at] + 0.001 * g * g
                state[n][at] -= ((fade * (0.1 if n == "embed" else 1)) * m[at] / (np.sqrt(v[at]) + 1e-6)).astype(np.float32)
            self.embed[-1] = 0

    def logits(self, ids: np.ndarray, count: np.ndarray) -> np.ndarray:
        """Output of every document of a chunk (before the scale); one without words has no active filter."""
        out = np.full(len(count), self.bias, np.float64)
        has = count > 0
        if not has.any():
            return out
        n, gap = count[has], max(WIDTHS) - 1
        begin = np.cumsum(n + gap) - (n + gap)
        size = int((n + gap).sum())
        x = np.zeros((size, DIM), np.float32)
        place = np.arange(len(ids)) + np.repeat(np.arange(len(n)) * gap, n)
        x[place] = sum(self.embed[ids[:, k]] for k in range(IDS))
        y = x @ np.concatenate([f[k] for f in self.filters for k in range(len(f))], axis=1)
        ends = np.stack((begin, begin + n), axis=1).ravel()
        z, at = 0.0, 0
        for k, w in enumerate(WIDTHS):
            own = y[:size - gap, at:at + FILTERS].copy()
            for j in range(1, w):
                own += y[j:size - gap + j, at + j * FILTERS:at + (j + 1) * FILTERS]
            at += w * FILTERS
            edges = np.minimum(ends, len(own) - 1)
            most = np.maximum.reduceat(own, edges, axis=0)[::2]
            # the last document's stretch ends where the array ends
            most[-1] = own[begin[-1]:].max(0)
            z = z + np.maximum(most, 0) @ self.out[k * FILTERS:(k + 1) * FILTERS]
        out[has] += z
        return out

    def scores(self, logits: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * logits + self.shift, -30, 30)))

    def calibrate(self, held: DataFrame) -> None:
        """Put the cut with the best F1 at CUT, with a slope fitted by likelihood; then one
        threshold a language (those with too few toxic documents keep CUT).
        ``held``: h, toxic, lang, logit."""
        cut = _best_cuts(held.select(F.lit("").alias("g"), F.col("logit").alias("s"), "toxic", "h"))[""]
        base = float(np.log(CUT / (1 - CUT)))
        slopes = np.geomspace(0.1, 10, 41)
        side = 1 - 2 * F.col("toxic")
        wrong = [side * (float(s) * (F.col("logit") - cut) + base) for s in slopes]
        loss = held.agg(*(F.avg(F.greatest(x, F.lit(0.0)) + F.log1p(F.exp(-F.abs(x)))).alias(f"l{i}") for i, x in enumerate(wrong))).first()
        self.scale = float(slopes[int(np.argmin(loss))])
        self.shift = float(base - self.scale * cut)
        by_lang = held.filter("lang <> ''").groupBy("lang").agg(F.sum("toxic").alias("ones"), F.sum(1 - F.col("toxic")).alias("noughts")).collect()
        enough = [r.lang for r in by_lang if r.ones >= 20 and r.noughts >= 20]
        z = F.greatest(F.lit(-30.0), F.least(F.lit(30.0), F.col("logit") * self.scale + self.shift))
        cuts = _best_cuts(held.filter(F.col("lang").isin(enough)).select(F.col("lang").alias("g"), (1 / (1 + F.exp(-z))).alias("s"), "toxic", "h")) if enough else {}
        self.by_lang = {lang: cuts.get(lang, CUT) for lang in sorted(r.lang for r in by_lang)}


def _best_cuts(rows: DataFrame) -> dict[str, float]:
    """The cut of every group ``g`` with the best F1 over its scores ``s``, in the middle of the widest gap that reaches it.

    The rows are sorted by ranges; a range's place in its group comes from the counts of those before it."""
    order = [F.col("g"), F.col("s").desc(), F.col("h")]
    rows = materialise(rows.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "cuts")
    parts = rows.groupBy("g", "part").agg(F.count("*").alias("n"), F.sum("toxic").alias("hits"), F.max("s").alias("top"))
    by_part = Window.partitionBy("g").orderBy("part")
    before = by_part.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("g")
    parts = parts.select("g", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n_before"), F.coalesce(F.sum("hits").over(before), F.lit(0)).alias("hits_before"),
                         F.lead("top").over(by_part).alias("below"), F.sum("hits").over(whole).alias("all"))
    own = Window.partitionBy("g", "part").orderBy(F.col("s").desc(), "h")
    up_to = own.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = rows.join(F.broadcast(parts), ["g", "part"]).select(
        "g", "s", (F.col("n_before") + F.row_number().over(own)).alias("rank"), (F.col("hits_before") + F.sum("toxic").over(up_to)).alias("found"),
        F.coalesce(F.lead("s").over(own), F.col("below"), F.col("s")).alias("next"), "all")
    f1 = 2 * F.col("found") / (F.col("rank") + F.greatest(F.col("all"), F.lit(1)))
    return {r.g: r.cut for r in ranked.groupBy("g").agg(F.max_by((F.col("s") + F.col("next")) / 2, F.struct(f1, -F.col("rank"))).alias("cut")).collect()}


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[np.ndarray], np.ndarray]]:
    """(words, labels) of bounded groups of documents, each in the order of the hashes."""
    held, size = [], 0
    for batch in batches:
        for r in zip(*(batch.column(n).to_pylist() for n in ("h", "toxic", "lang", "ids"))):
            held.append(r)
            size += len(r[3])
            if len(held) >= GROUP or size >= GROUP_BYTES:
                yield _unpacked(held)
                held, size = [], 0
    if held:
        yield _unpacked(held)


def _unpacked(held: list[tuple]) -> tuple[list[np.ndarray], np.ndarray]:
    held = sorted(held)
    return [np.frombuffer(r[3], np.uint16).reshape(-1, IDS).astype(np.int32) for r in held], np.array([r[1] for r in held], np.float64)


def _hash_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        at = buffer(whole.column("text"))[1]
        for i, j in chunks(at, CHUNK):
            batch = whole.slice(i, j - i)
            ids, count = word_ids(*buffer(batch.column("text")))
            first = np.cumsum(count) - count
            rows = [ids[a:a + n].astype(np.uint16).tobytes() for a, n in zip(first, count)]
            yield pa.RecordBatch.from_arrays([batch.column("h"), batch.column("toxic"), batch.column("lang"), pa.array(rows, pa.binary())], names=["h", "toxic", "lang", "ids"])


def _presence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many documents of either label hold each word."""
    seen = np.zeros((2, HASHED + 1), np.int64)
    for docs, labels in _groups(batches):
        for ids, y in zip(docs, labels):
            seen[int(y), np.unique(ids)] += 1
    label, word = np.nonzero(seen)
    yield pa.RecordBatch.from_arrays([pa.array(label.astype(np.int32)), pa.array(word.astype(np.int32)), pa.array(seen[label, word])], names=["toxic", "word", "n"])


def fit(docs: DataFrame, labels: DataFrame) -> TextCNN:
    """The model for ``docs`` (doc_id, text, lang) and ``labels`` (doc_id, toxic).

    All labelled documents are used: a fifth, by a hash of the id, for the scale and the thresholds, the others
    for training.  Rows with a null id or a label that is not 0 or 1 are left out; with repeated labels of an id
    the largest counts.  lang only groups the calibration's thresholds.
    """
    known = labels.filter("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")).filter("toxic in (0, 1)").withColumn("h", F.xxhash64("doc_id", F.lit(SEED)))
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang")).join(known.hint("merge"), "doc_id")
    hashed = materialise(rows.select("h", "toxic", "lang", "text").mapInArrow(_hash_words, "h bigint, toxic int, lang string, ids binary"), "labelled")
    holds = F.pmod("h", F.lit(5)) == 0
    n = {(r.hold, r.toxic): r["count"] for r in hashed.groupBy(holds.alias("hold"), "toxic").count().collect()}
    model = TextCNN()
    if all(n.get((hold, y)) for hold in (False, True) for y in (0, 1)):
        data = averaging.dealt(hashed.filter(~holds), n[False, 0] + n[False, 1], GROUP)
        seen = np.zeros((2, HASHED + 1))
        found = data.mapInArrow(_presence, "toxic int, word int, n bigint").groupBy("toxic", "word").agg(F.sum("n").alias("n")).toArrow()
        seen[np.asarray(found.column("toxic")), np.asarray(found.column("word"))] = np.asarray(found.column("n"))
        model.warm_start(seen, np.array([n[False, 0], n[False, 1]]))

        def learn(state: dict[str, np.ndarray], batches: Iterator[pa.RecordBatch], epoch: int) -> int:
            own, rows = TextCNN(), 0
            for texts, y in _groups(batches):
                own.train(texts, y, state, epoch)
                rows += len(y)
            return rows

        model.take(averaging.train(data, model.arrays(), EPOCHS, learn))
        held = data.sparkSession.sparkContext.broadcast(model)

        def logits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts = [np.frombuffer(x, np.uint16).reshape(-1, IDS).astype(np.int32) for x in batch.column("ids").to_pylist()]
                z = np.array([held.value.logits(t, np.array([len(t)]))[0] for t in texts], np.float64)
                yield pa.RecordBatch.from_arrays([batch.column("h"), batch.column("toxic"), batch.column("lang"), pa.array(z)], names=["h", "toxic", "lang", "logit"])

        model.calibrate(materialise(hashed.filter(holds).mapInArrow(logits, "h bigint, toxic int, lang string, logit double"), "held"))
        return model
    model.out[:] = 0
    ones, rows = (sum(v for (_, y), v in n.items() if y >= least) for least in (1, 0))
    # labels of one kind: their share for every text
    model.bias = np.float32(np.log((ones / rows + 1e-3) / (1 - ones / rows + 1e-3))) if rows else np.float32(-5)
    return model


def score(spark: SparkSession, docs: DataFrame, model: TextCNN) -> DataFrame:
    """Every column of ``docs`` plus score (0 to 1): a text without words gets the model's bias.
    An input column of that name is replaced."""
    held = spark.sparkContext.broadcast(model)
    data = docs.drop("score").withColumn("_text", F.coalesce(F.col("text").cast("string"), F.lit("")))
    names = [c for c in data.columns if c != "_text"]
    schema = data.select(*names, F.lit(0.0).alias("score")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        for batch in batches:
            buf, offsets = buffer(batch.column("_text"))
            out = [model.logits(*word_ids(buf[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])) for i, j in chunks(offsets, CHUNK)]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(model.scores(np.concatenate(out)) if out else np.zeros(0))], names=[*names, "score"])

    return data.mapInArrow(run, schema)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    model = fit(docs, labels.filter(crc32_mod("doc_id", 4) != 2))
    scored = score(spark, docs.select("doc_id", "text", "lang", (crc32_mod("doc_id", 4) == 2).alias("held_out")), model)
    by_lang = F.lit(CUT)
    for lang, cut in model.by_lang.items():
        by_lang = F.when(F.col("lang") == lang, F.lit(cut)).otherwise(by_lang)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= CUT).cast("int").alias("predicted"),
                         (F.col("score") >= by_lang).cast("int").alias("flagged_by_language"))


QUERIES = {"op4_toxicity": op4_toxicity}
ORACLE: dict[str, str] = {}
