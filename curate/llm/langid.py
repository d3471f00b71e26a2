"""Language identification by compression.

For each language a bounded sample of labelled text becomes a raw-content zstandard
dictionary.  Texts count as lower-case letters with one space between words.  A text is cut into pieces, every piece is compressed with each
dictionary, and the language with the fewest bytes in total wins; the text is
rejected when it has no letter or when the margin over the runner-up is narrow.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curate.llm.textbytes import buffer, crc32_mod

#: The fitted sample: distinct texts of a language at most, characters of each, bytes of its dictionary.
SAMPLE_DOCS, SAMPLE_CHARS, DICT_BYTES = 1_000, 112, 112_000
#: Bytes of all dictionaries together: with more languages than fit, each has an equal, smaller part.
ALL_BYTES = 32 << 20
PIECE = 4_096
#: The level every text meets, and the finer one (matches from 3 bytes on) that settles equal sizes.
LEVEL, FINE = 5, 19


def letters(text: Column) -> Column:
    """Lower-case letters of the text, every other run of characters as one space."""
    return F.regexp_replace(F.lower(text.cast("string")), r"[^\p{L}]+", " ")


def learn(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> dict[str, bytes]:
    """language -> dictionary content, from labelled ``docs`` (null languages and texts are left out).

    A language's sample is its distinct texts of smallest hash, one excerpt of each from a place
    that the hash picks within the whole text, so it is the same whatever the partitioning and
    repeated rows count once.  SAMPLE_DOCS, SAMPLE_CHARS, DICT_BYTES and ALL_BYTES bound the sample;
    every language is learnt, one without letters in its texts with an empty dictionary.
    A hash bound from each language's approximate number of texts thins the rows
    before they are gathered, about twice as many as the sample needs.
    """
    labelled = (docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
                .filter("lang is not null and text is not null").withColumn("h", F.xxhash64("text", F.lit(3))))
    worded = F.col("text").rlike(r"\p{L}")
    distinct = {r.lang: r.n or 0 for r in labelled.groupBy("lang").agg(F.approx_count_distinct(F.when(worded, F.col("h")), 0.03).alias("n")).collect()}
    if not distinct:
        return {}
    own_bytes = min(DICT_BYTES, ALL_BYTES // len(distinct))
    most = max(1, min(SAMPLE_DOCS, own_bytes // SAMPLE_CHARS))
    bound = [(lang, min((1 << 63) - 1, int(2 * most / max(n, 1) * (1 << 64)) - (1 << 63))) for lang, n in distinct.items()]
    bounds = docs.sparkSession.createDataFrame(bound, "_lang string, bound bigint")
    whole = letters(F.col("text"))
    start = 1 + F.pmod(F.hash("h"), F.greatest(F.lit(1), F.length("text") - SAMPLE_CHARS + 1))
    rows = (labelled.join(F.broadcast(bounds), F.col("lang") == F.col("_lang")).filter((F.col("h") <= F.col("bound")) & worded)
            .select("lang", "h", whole.alias("text")).select("lang", "h", F.substring("text", start, F.lit(SAMPLE_CHARS)).alias("text"))
            .distinct().collect())
    out: dict[str, bytes] = {}
    samples: dict[str, list[tuple[int, str]]] = {lang: [] for lang in sorted(distinct)}
    for r in rows:
        samples[r.lang].append((r.h, r.text))
    for lang, texts in samples.items():
        out[lang] = b"\n".join(dict.fromkeys(t.encode() for _, t in sorted(texts)[:most]))[:own_bytes]
    return out


class Compressors:
    """One zstandard compressor a language; built once in a Python worker."""

    def __init__(self, dictionaries: dict[str, bytes], fine: bool = False):
        self.names = list(dictionaries)
        self.compress = []
        for content in dictionaries.values():
            content = content or b"\0" * 8
            own = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            if fine:
                how = zstandard.ZstdCompressionParameters.from_level(FINE, source_size=PIECE, dict_size=len(content), min_match=3, write_checksum=0, write_content_size=0, write_dict_id=0)
                own.precompute_compress(compression_params=how)
                self.compress.append(zstandard.ZstdCompressor(dict_data=own, compression_params=how).compress)
            else:
                own.precompute_compress(level=LEVEL)
                self.compress.append(zstandard.ZstdCompressor(dict_data=own, write_checksum=False, write_content_size=False, write_dict_id=False).compress)

    def sizes(self, raw: bytes) -> list[int]:
        pieces = [raw[i:i + PIECE] for i in range(0, len(raw), PIECE)]
        return [sum(len(c(p)) for p in pieces) for c in self.compress]


def identify(spark: SparkSession, docs: DataFrame, dictionaries: dict[str, bytes], text_col: str = "text") -> DataFrame:
    """Every column of ``docs`` plus lang_pred, score and margin.

    lang_pred is ``und`` (score and margin 0) where the text is null or has no letter, or when no
    language is known.  Otherwise it is the language with the smallest size (where several have it,
    the smallest under a finer compression of the text written twice counts, since zstandard stores short
    texts as they are unless something repeats; then the first by name), score = runner-up / (best + runner-up) is 0.5 to 1, and
    margin = 1 - best / runner-up.  Input columns named like an output are replaced.
    """
    held = spark.sparkContext.broadcast(dictionaries)
    plain = F.coalesce(letters(F.col(text_col)), F.lit(""))
    clash = [c for c in docs.columns if c.lower() in ("lang_pred", "score", "margin", "_text")]
    data = docs.drop(*clash).select("*", plain.alias("_text"))
    names = [c for c in data.columns if c != "_text"]
    schema = data.select(*names, F.lit("").alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(0.0).alias("margin")).schema
    for f in schema:
        f.nullable = True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools, fine = Compressors(held.value), None
        for batch in batches:
            buf, at = buffer(batch.column("_text"))
            lang, score, margin = [], [], []
            for i in range(len(batch)):
                own = buf[at[i]:at[i + 1]].tobytes()
                if not own.strip() or not tools.names:
                    lang.append("und"), score.append(0.0), margin.append(0.0)
                    continue
                sizes = tools.sizes(own)
                if sizes.count(min(sizes)) > 1:
                    fine = fine or Compressors(held.value, fine=True)
                    sizes = fine.sizes(own + b" " + own)
                order = np.argsort(sizes, kind="stable")
                best = sizes[order[0]]
                second = sizes[order[1]] if len(order) > 1 else 2 * best
                lang.append(tools.names[order[0]]), score.append(second / (best + second)), margin.append(1 - best / second)
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(margin, pa.float64())], names=[*names, "lang_pred", "score", "margin"])

    return data.mapInArrow(run, schema)


def rejected(min_margin: float = 0.01) -> Column:
    """True for rows of ``identify`` to turn away, whatever their length: no language, or a narrow margin."""
    return (F.col("lang_pred") == "und") | (F.col("margin") < min_margin)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    held_out = crc32_mod("doc_id", 5) == 0
    found = identify(spark, docs.select("doc_id", "text", held_out.alias("held_out")), learn(docs.filter(~held_out)))
    return found.select("doc_id", "held_out", "lang_pred", "score", "margin")


QUERIES = {"op10_language_id": op10_language_id}
ORACLE: dict[str, str] = {}
