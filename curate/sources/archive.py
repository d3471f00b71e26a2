"""Archive expansion (SRC1, STR6, STR7).

Many ZIP archives are expanded in parallel.  ``binaryFile`` only *lists* them
(``path``, ``length``; the content column is pruned, so no bytes are read by
the listing).  A first step reads the central directories, one row per
member; the ``(archive, member)`` rows are then spread over the cluster, so
the members of one large archive are read by many tasks.  Each task opens its
archives through ``pyarrow.fs`` as seekable streams, so a whole archive is
never held in memory and archives larger than a single Spark binary value
are fine.  Members are yielded in batches bounded by rows and by characters
(one member is one value).  Decoding is UTF-8 with replacement characters and
universal newlines.

``stream=False`` falls back to reading each archive's bytes through Spark
(``binaryFile`` content) for file systems pyarrow cannot open.
"""

from __future__ import annotations

import hashlib
import io
import mimetypes
import uuid
import zipfile
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

MEMBER_SCHEMA = ("path string, member_path string, file_name string, size_bytes long, "
                 "type string, text string")
_COLUMNS = ["path", "member_path", "file_name", "size_bytes", "type", "text"]
_BATCH_ROWS = 256
_BATCH_CHARS = 1 << 25


def _member_type(name: str) -> str:
    return mimetypes.guess_type(name)[0] or "application/octet-stream"


def _name(info: zipfile.ZipInfo) -> str:
    return info.filename.rsplit("/", 1)[-1]


def _wanted(zf: zipfile.ZipFile, expected: frozenset[str] | None) -> list[int]:
    """Positions of the (expected) members in the archive's directory."""
    return [i for i, info in enumerate(zf.infolist())
            if not info.is_dir() and (expected is None or _name(info) in expected)]


def _row(path: str, zf: zipfile.ZipFile, position: int, with_text: bool) -> tuple:
    info, text = zf.infolist()[position], None
    if with_text:
        with zf.open(info, "r") as raw:
            text = io.TextIOWrapper(raw, encoding="utf-8", errors="replace").read()
    return (path, info.filename, _name(info), info.file_size, _member_type(_name(info)), text)


def arrow_uri(path: str) -> str:
    """A Spark/Hadoop path as a URI pyarrow understands (``file:/x`` -> ``file:///x``, s3a -> s3)."""
    if path.startswith("file:") and not path.startswith("file://"):
        return "file://" + path[len("file:"):]
    for hadoop, arrow in (("s3a://", "s3://"), ("s3n://", "s3://")):
        if path.startswith(hadoop):
            return arrow + path[len(hadoop):]
    return path if "://" in path else f"file://{path}"


def _open_stream(path: str):
    from pyarrow import fs as pafs
    filesystem, p = pafs.FileSystem.from_uri(arrow_uri(path))
    f = filesystem.open_input_file(p)
    # an archive without members is shorter than what zipfile looks for before its end
    return f if f.size() > 64 else io.BytesIO(f.read())


def _directory(expected: frozenset[str] | None):
    """Archive paths -> one row per (expected) member: its position in the directory."""
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path in pdf["path"]:
                with _open_stream(path) as f, zipfile.ZipFile(f) as zf:
                    positions = _wanted(zf, expected)
                if positions:
                    yield pd.DataFrame({"path": [path] * len(positions), "position": positions})
    return read


def _opened(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[str, zipfile.ZipFile, list[int]]]:
    """Every archive named in the ``(path, position)`` rows, opened once a batch."""
    for pdf in batches:
        for path, part in pdf.groupby("path", sort=False):
            with _open_stream(path) as f, zipfile.ZipFile(f) as zf:
                yield path, zf, part["position"].tolist()


def _whole(batches: Iterator[pd.DataFrame], expected: frozenset[str] | None
           ) -> Iterator[tuple[str, zipfile.ZipFile, list[int]]]:
    """The same for archives whose bytes came through Spark."""
    for pdf in batches:
        for path, content in zip(pdf["path"], pdf["content"]):
            with zipfile.ZipFile(io.BytesIO(bytes(content))) as zf:
                yield path, zf, _wanted(zf, expected)


def _expander(expected: frozenset[str] | None, with_text: bool, stream: bool):
    def expand(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows: list[tuple] = []
        chars = 0
        for path, zf, positions in _opened(batches) if stream else _whole(batches, expected):
            for position in positions:
                rows.append(_row(path, zf, position, with_text))
                chars += len(rows[-1][-1] or "")
                if len(rows) >= _BATCH_ROWS or chars >= _BATCH_CHARS:
                    yield pd.DataFrame(rows, columns=_COLUMNS)
                    rows, chars = [], 0
        if rows:
            yield pd.DataFrame(rows, columns=_COLUMNS)
    return expand


def list_archives(spark: SparkSession, path: str, glob: str = "*.zip") -> DataFrame:
    """``path, length`` of every archive (no content is read)."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", glob)
            .option("recursiveFileLookup", True).load(path).select("path", "length"))


def _member_rows(spark: SparkSession, path: str, expected: frozenset[str] | None,
                 glob: str) -> DataFrame:
    """``path, position`` of every (expected) member, spread over the cluster's tasks."""
    n = spark.sparkContext.defaultParallelism
    members = (list_archives(spark, path, glob).select("path").repartition(n, "path")
               .mapInPandas(_directory(expected), "path string, position int"))
    return members.repartition(n, "path", "position")


def expand_archives(spark: SparkSession, path: str, expected: Iterable[str] | None = None,
                    glob: str = "*.zip", with_text: bool = True, stream: bool = True) -> DataFrame:
    """One row per archive member: ``path, member_path, file_name, size_bytes, type, text``.

    Directory entries are skipped; ``file_name`` is the text after the last
    ``/``; with ``expected`` only members of those names are kept.
    ``size_bytes`` is the member's uncompressed size.  ``with_text=False``
    lists members without decompressing them (``text`` is null).
    """
    exp = None if expected is None else frozenset(expected)
    if stream:
        files = _member_rows(spark, path, exp, glob)
    else:
        files = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
                 .option("recursiveFileLookup", True).load(path).select("path", "content"))
    return files.mapInPandas(_expander(exp, with_text, stream), MEMBER_SCHEMA)


# --------------------------------------------------------------------------
# Streaming extraction to files (bronze)
# --------------------------------------------------------------------------

EXTRACT_SCHEMA = ("path string, member_path string, file_name string, size_bytes long, "
                  "type string, target_path string")
EXTRACT_SCHEMA_COLUMNS = ["path", "member_path", "file_name", "size_bytes", "type", "target_path"]
_CHUNK_CHARS = 1 << 20


def _target(out_dir: str, archive: str, member: str, name: str, position: int = 0) -> str:
    # archives of one name, members of one safe spelling and members that an archive
    # holds twice must not share a file
    digest = hashlib.sha256(f"{archive}\0{position}\0{member}".encode()).hexdigest()[:24]
    return f"{out_dir.rstrip('/')}/file_name={name}/member-{digest}.txt"


def _extractor(out_dir: str):
    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs as pafs
        from pyspark import TaskContext
        ctx = TaskContext.get()
        attempt = f"{ctx.partitionId()}-{ctx.attemptNumber()}" if ctx else "driver"
        out_fs, out_root = pafs.FileSystem.from_uri(arrow_uri(out_dir))
        prefix = out_dir.rstrip("/")
        rows: list[tuple] = []
        for path, zf, positions in _opened(batches):
            for position in positions:
                info = zf.infolist()[position]
                target = _target(out_dir, path, info.filename, _name(info), position)
                local = out_root.rstrip("/") + target[len(prefix):]
                folder, _, base = local.rpartition("/")
                out_fs.create_dir(folder, recursive=True)
                # Each attempt writes its own temporary file, then moves it onto
                # the deterministic target: a retried or speculative attempt
                # replaces the file whole, never duplicates or interleaves it.
                # Spark does not read names that begin with "_", so what a killed attempt
                # leaves is never data.
                tmp = f"{folder}/_{base}.{attempt}.{uuid.uuid4().hex[:8]}.tmp"
                with zf.open(info, "r") as raw, out_fs.open_output_stream(tmp) as out:
                    text = io.TextIOWrapper(raw, encoding="utf-8", errors="replace")
                    while chunk := text.read(_CHUNK_CHARS):
                        out.write(chunk.encode("utf-8"))
                out_fs.move(tmp, local)
                rows.append((*_row(path, zf, position, False)[:-1], target))
                if len(rows) >= _BATCH_ROWS:
                    yield pd.DataFrame(rows, columns=EXTRACT_SCHEMA_COLUMNS)
                    rows = []
        if rows:
            yield pd.DataFrame(rows, columns=EXTRACT_SCHEMA_COLUMNS)
    return extract


def extract_members(spark: SparkSession, path: str, out_dir: str,
                    expected: Iterable[str] | None = None, glob: str = "*.zip") -> DataFrame:
    """Stream every (expected) member's decoded text to ``out_dir/file_name=<name>/``.

    Returns one metadata row per member (lazy: runs when the frame is
    consumed, e.g. written as the manifest).  Member text never becomes a
    DataFrame value, so members of any size are copied in bounded memory.
    """
    exp = None if expected is None else frozenset(expected)
    return _member_rows(spark, path, exp, glob).mapInPandas(_extractor(out_dir), EXTRACT_SCHEMA)
