"""Fill-in-middle transformation by in-place block rotation.

A text is cut behind two of its tokens into prefix, middle and suffix.  The sentinels
are inserted into the text's bytes where the cuts lie, which gives ``<P>prefix<M>middle
<S>suffix``; the wanted order is reached by exchanging two neighbouring blocks of that
bytearray with three reversals, and undone by the exchange back.  Nothing is drawn at
random: cuts and form come from a digest of seed and document id, so that reruns and
repeated tasks agree.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from curate.llm.textbytes import NOT_SPACE, buffer, chunks, words

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
#: Bytes of text whose token positions are held at a time (one longer text is taken alone).
CHUNK = 4 << 20
_OUT = {"n": "long", "form": "string", "prefix_chars": "long", "middle_chars": "long", "output": "string"}


def reverse(buf: bytearray, lo: int, hi: int) -> None:
    buf[lo:hi] = buf[lo:hi][::-1]


def rotate(buf: bytearray, lo: int, mid: int, hi: int) -> None:
    """Exchange the blocks lo:mid and mid:hi where they stand: each reversed, then both together."""
    reverse(buf, lo, mid)
    reverse(buf, mid, hi)
    reverse(buf, lo, hi)


def arrange(text: bytes, first: int, second: int, form: str) -> bytes:
    """``text`` cut at bytes first <= second, in the order of ``form`` (psm or spm)."""
    buf = bytearray(text)
    buf[second:second] = SUFFIX
    buf[first:first] = MIDDLE
    buf[:0] = PREFIX
    middle, suffix = len(PREFIX) + first, len(PREFIX) + len(MIDDLE) + second
    rotate(buf, middle if form == "psm" else 0, suffix, len(buf))
    return bytes(buf)


def recover(output: bytes, form: str) -> bytes:
    """The text that ``arrange`` was given.  No sentinel can arise at a seam, as each
    begins with ``<`` and holds no other; so the only ones are those inserted."""
    if form not in ("psm", "spm"):
        return output
    buf = bytearray(output)
    if form == "psm":
        rotate(buf, buf.index(SUFFIX), buf.index(MIDDLE), len(buf))
    else:
        rotate(buf, 0, buf.index(PREFIX), len(buf))
    for mark in (SUFFIX, MIDDLE, PREFIX):
        at = buf.index(mark)
        del buf[at:at + len(mark)]
    return bytes(buf)


def _with(df: DataFrame, **more: str) -> StructType:
    return StructType([*df.schema.fields, *StructType.fromDDL(", ".join(f"{c} {t}" for c, t in more.items())).fields])


def _transform(batches: Iterator[pa.RecordBatch], text_col: str, rate: int, spm: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        buf, offsets = buffer(batch.column(text_col))
        digest = [batch.column(f"_h{k}").to_numpy() for k in range(4)]
        for i, j in chunks(offsets, CHUNK):
            at = offsets[i:j + 1] - offsets[i]
            part = buf[offsets[i]:offsets[j]]
            _, end, doc = words(part, at, NOT_SPACE)
            lead = np.zeros(len(part) + 1, np.int64)          # code points before each byte
            np.cumsum((part & 0xC0) != 0x80, out=lead[1:])
            first = np.searchsorted(doc, np.arange(j - i + 1))
            out: dict[str, list] = {c: [] for c in _OUT}
            for d in range(j - i):
                lo, hi = int(at[d]), int(at[d + 1])
                cut = [lo, *end[first[d]:first[d + 1]].tolist()]
                if cut[-1] < hi:                               # white space at the end is a token
                    cut.append(hi)
                n, text = len(cut) - 1, part[lo:hi].tobytes()
                h = [int(x[i + d]) for x in digest]
                a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
                if not text or h[2] % 100 >= rate or any(m in text for m in (PREFIX, SUFFIX, MIDDLE)):
                    form, sizes, output = "plain", (None, None), text
                else:
                    form = "spm" if h[3] % 100 < spm else "psm"
                    sizes = int(lead[cut[a]] - lead[lo]), int(lead[cut[b]] - lead[cut[a]])
                    output = arrange(text, cut[a] - lo, cut[b] - lo, form)
                for c, v in zip(_OUT, (n, form, *sizes, output)):
                    out[c].append(v)
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary())
            kept = [c for c in batch.schema.names if c not in ("_h0", "_h1", "_h2", "_h3")]
            rows = batch.slice(i, j - i)
            made = [pa.array(out[c], kind) for c, kind in zip(_OUT, kinds)]
            made[-1] = made[-1].cast(pa.string())
            yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in kept), *made], names=[*kept, *_OUT])


def fill_in_middle(docs: DataFrame, rate: int = 50, spm: int = 80, seed: int = 42,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every column of ``docs`` plus n (tokens), form, prefix_chars, middle_chars and output.

    ``rate`` percent of the texts are transformed, ``spm`` percent of those begin with the
    suffix.  A token is a word with the white space before it, or white space at the end.
    A null text counts as empty and a null id as empty digits; empty texts and texts that
    hold a sentinel stay plain, with null sizes; repeated rows are treated alike.  Texts are
    taken whole, one bytearray at a time.  Input columns named like an output are replaced.
    """
    clash = {*_OUT, "_h0", "_h1", "_h2", "_h3"} - {id_col, text_col}
    kept = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in clash])
    if dict(kept.dtypes)[text_col] != "string":
        kept = kept.withColumn(text_col, F.col(f"`{text_col}`").cast("string"))
    hexes = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))).cast("binary"), 256)
    numbers = [F.conv(F.substring(hexes, 8 * k + 1, 8), 16, 10).cast("bigint").alias(f"_h{k}") for k in range(4)]
    return kept.select("*", *numbers).mapInArrow(lambda b: _transform(b, text_col, rate, spm), _with(kept, **_OUT))


def _restore(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        forms = batch.column("form").to_pylist()
        buf, offsets = buffer(batch.column("output"))
        kept = [c for c in batch.schema.names if c != "restored"]
        for i, j in chunks(offsets, CHUNK):
            texts = [recover(buf[offsets[d]:offsets[d + 1]].tobytes(), forms[d]) for d in range(i, j)]
            rows = batch.slice(i, j - i)
            yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in kept), pa.array(texts, pa.binary()).cast(pa.string())], names=[*kept, "restored"])


def restore(df: DataFrame) -> DataFrame:
    """``df`` plus restored: the text rebuilt from the columns ``output`` (null: empty) and
    ``form`` (anything but psm and spm: as it is).  A column ``restored`` is replaced."""
    df = df.drop("restored")
    return df.mapInArrow(_restore, _with(df, restored="string"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    made = restore(fill_in_middle(docs).drop("text"))
    digest = lambda c: F.sha2(F.col(c).cast("binary"), 256).alias(f"{c}_sha256")
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", digest("output"), digest("restored"))


QUERIES = {"op13_fill_in_middle": op13_fill_in_middle}
ORACLE = {"op13_fill_in_middle": r"""
WITH cut AS (
  SELECT doc_id, t, regexp_extract_all(t, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS tok, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)),
num AS (
  SELECT *, CAST(len(tok) AS BIGINT) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
         CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM cut),
part AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 50 THEN 'plain'
              WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM num),
put AS (
  SELECT *, array_to_string(tok[1:a], '') AS p, array_to_string(tok[a + 1:b], '') AS m, array_to_string(tok[b + 1:n], '') AS s FROM part)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars, CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m WHEN 'spm' THEN '<S>' || s || '<P>' || p || '<M>' || m ELSE t END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM put"""}
