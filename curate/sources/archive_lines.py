"""Lines of archive members, without a member ever being one value (SRC1, SRC2).

``expand_archives`` gives a member as one text, which a member above 2 GB cannot be.
Here a task decompresses its member as a stream and yields the lines in Arrow batches
of bounded size, so memory does not depend on the member.  A line ends with ``\\n``,
``\\r\\n`` or ``\\r``; bytes that are no UTF-8 become replacement characters.

Two ways in: :func:`read_archive_lines` lists the archives' directories on the cluster
as well; and the data source ``archive_lines`` (``spark.read.format("archive_lines").load(path)``,
after :func:`register`) plans on the driver: small archives go together to partitions of
about PARTITION_BYTES, unopened, and the members of larger ones are spread over several.
"""

from __future__ import annotations

import fnmatch
import io
import zipfile
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from curate.sources.archive import _member_rows, _open_stream, _wanted, arrow_uri

LINES_SCHEMA = "path string, member_path string, line_no long, line string"
_ARROW = pa.schema([("path", pa.string()), ("member_path", pa.string()), ("line_no", pa.int64()), ("line", pa.string())])
# A batch is yielded at so many lines or characters.
BATCH_LINES, BATCH_CHARS = 20_000, 4 << 20
# Compressed bytes that a partition of the data source reads (a member is never split), and archives that it opens.
PARTITION_BYTES, PARTITION_ARCHIVES = 4 << 20, 64


def _batch(path: str, member: str, first: int, lines: list[str]) -> pa.RecordBatch:
    n = len(lines)
    return pa.RecordBatch.from_arrays([pa.array([path] * n, pa.string()), pa.array([member] * n, pa.string()),
                                       pa.array(range(first, first + n), pa.int64()), pa.array(lines, pa.string())], schema=_ARROW)


def member_lines(path: str, zf: zipfile.ZipFile, position: int) -> Iterator[pa.RecordBatch]:
    """The lines of one member, numbered from 0, as bounded batches."""
    info = zf.infolist()[position]
    lines, chars, first = [], 0, 0
    with zf.open(info, "r") as raw:
        for line in io.TextIOWrapper(raw, encoding="utf-8", errors="replace"):
            lines.append(line[:-1] if line.endswith("\n") else line)
            chars += len(line)
            if len(lines) >= BATCH_LINES or chars >= BATCH_CHARS:
                yield _batch(path, info.filename, first, lines)
                first, lines, chars = first + len(lines), [], 0
    if lines:
        yield _batch(path, info.filename, first, lines)


def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows, small batches put together up to the bounds of one."""
    held, rows, size = [], 0, 0
    for batch in batches:
        if held and (rows + batch.num_rows > BATCH_LINES or size + batch.nbytes > BATCH_CHARS):
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, rows, size = [], 0, 0
        held.append(batch)
        rows, size = rows + batch.num_rows, size + batch.nbytes
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def read_archive_lines(spark: SparkSession, path: str, expected: Iterable[str] | None = None,
                       glob: str = "*.zip") -> DataFrame:
    """``path, member_path, line_no, line`` of the (expected) members of all archives below ``path``.

    An empty member has no lines.
    """
    wanted = frozenset(expected) if expected is not None else None

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                with _open_stream(row["path"]) as f, zipfile.ZipFile(f) as zf:
                    yield from member_lines(row["path"], zf, row["position"])

    return _member_rows(spark, path, wanted, glob).mapInArrow(read, LINES_SCHEMA)


@dataclass
class MembersPartition(InputPartition):
    """Archives, each with the positions of the members to read (None: all that are wanted)."""

    archives: list[tuple[str, list[int] | None]]


def _member_groups(path: str, members: frozenset[str] | None) -> Iterator[list[int]]:
    """The wanted members of a large archive in groups of about PARTITION_BYTES."""
    with _open_stream(path) as f, zipfile.ZipFile(f) as zf:
        infos, group, held = zf.infolist(), [], 0
        for i in _wanted(zf, members):
            if group and held + infos[i].compress_size > PARTITION_BYTES:
                yield group
                group, held = [], 0
            group.append(i)
            held += infos[i].compress_size
    if group:
        yield group


class ArchiveLinesReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path, self.glob = options["path"], options.get("glob", "*.zip")
        names = options.get("members")
        self.members = frozenset(names.split(",")) if names else None

    def partitions(self) -> list[MembersPartition]:
        from pyarrow import fs as pafs
        filesystem, root = pafs.FileSystem.from_uri(arrow_uri(self.path))
        info = filesystem.get_file_info(root)
        files = [info] if info.is_file else filesystem.get_file_info(pafs.FileSelector(root, recursive=True))
        scheme = arrow_uri(self.path).split("://")[0]
        out, small, held = [], [], 0
        for f in sorted((f for f in files if f.is_file and fnmatch.fnmatch(f.base_name, self.glob)), key=lambda f: f.path):
            path = f"{scheme}://{f.path}"
            if f.size > PARTITION_BYTES:
                out += [MembersPartition([(path, group)]) for group in _member_groups(path, self.members)]
                continue
            if small and (held + f.size > PARTITION_BYTES or len(small) >= PARTITION_ARCHIVES):
                out.append(MembersPartition(small))
                small, held = [], 0
            small.append((path, None))
            held += f.size
        return [*out, MembersPartition(small)] if small else out

    def read(self, partition: MembersPartition) -> Iterator[pa.RecordBatch]:
        if partition is not None:                  # no archives: one empty partition is planned
            yield from gathered(self._lines(partition))

    def _lines(self, partition: MembersPartition) -> Iterator[pa.RecordBatch]:
        for path, positions in partition.archives:
            with _open_stream(path) as f, zipfile.ZipFile(f) as zf:
                for position in _wanted(zf, self.members) if positions is None else positions:
                    yield from member_lines(path, zf, position)


class ArchiveLines(DataSource):
    """``archive_lines``: options ``path``, ``glob`` (of archives), ``members`` (names, comma-joined)."""

    @classmethod
    def name(cls) -> str:
        return "archive_lines"

    def schema(self) -> str:
        return LINES_SCHEMA

    def reader(self, schema) -> ArchiveLinesReader:
        return ArchiveLinesReader(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(ArchiveLines)
