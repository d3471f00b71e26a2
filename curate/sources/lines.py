"""Line-oriented text: scanning, sectioning, routing and dimension parsing.

SRC2 ``read_lines``, SRC3 ``split_sections``, SRC4 ``route_sections``,
SRC5 ``section_to_dim``.

A "lines" frame has columns ``file, block, idx, line``: ``(block, idx)``
orders the lines of one file.  ``read_lines`` takes ``block`` from the
file split's byte offset and ``idx`` from ``monotonically_increasing_id``
(increasing within a split), so a large file is read and sectioned by many
tasks in parallel; nothing is collected and no task ever holds a whole file.

Sectioning is a distributed running count of separator lines: per-block
separator counts (one row per block) are prefix-summed over blocks, then a
running sum inside each block (a window bounded by one block) gives every
line its section number.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curate.functions.casting import lenient_cast
from curate.functions.text import csv_fields
from curate.spec import DimSpec

LINE_COLS = ("file", "block", "idx", "line")
BROADCAST_MAX_SECTIONS = 1_000_000


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """``file, block, idx, line`` for every line of the text file(s) at ``path``.

    ``\\n``, ``\\r\\n`` and ``\\r`` all end a line.
    """
    return spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("idx"),
        F.col("value").alias("line"),
    )


def stripped(c: Column) -> Column:
    """Remove leading/trailing whitespace of any kind (like Python ``str.strip``)."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def split_sections(lines: DataFrame, sep: str = ",") -> DataFrame:
    """Assign a section number to every non-separator line.

    A separator is a line equal to ``sep`` after stripping whitespace.  Output:
    ``file, section, block, idx, line`` where ``section`` counts the separators
    before the line; separator lines are dropped, so empty sections vanish.
    """
    flagged = lines.withColumn("_sep", (stripped(F.col("line")) == sep).cast("long"))
    per_block = flagged.groupBy("file", "block").agg(F.sum("_sep").alias("_bsep"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1)
    per_block = per_block.select("file", "block",
                                 F.coalesce(F.sum("_bsep").over(before), F.lit(0)).alias("_off"))
    in_block = Window.partitionBy("file", "block").orderBy("idx").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    return (flagged.join(per_block, ["file", "block"])
            .withColumn("section", F.col("_off") + F.sum("_sep").over(in_block))
            .where(F.col("_sep") == 0)
            .select("file", "section", "block", "idx", "line"))


def section_headers(sections: DataFrame) -> DataFrame:
    """One row per section: ``file, section, section_no, header, header_block, header_idx, lines``.

    ``header`` is the first non-blank line; ``section_no`` numbers the
    sections of a file 0, 1, 2, ... in order; ``lines`` counts all lines.
    """
    nonblank = stripped(F.col("line")) != ""
    pos = F.when(nonblank, F.struct("block", "idx"))
    heads = sections.groupBy("file", "section").agg(
        F.min(pos).alias("_pos"),
        F.min_by(F.col("line"), pos).alias("_head"),
        F.count(F.lit(1)).alias("lines"),
    )
    order = Window.partitionBy("file").orderBy("section")
    return heads.select(
        "file", "section",
        (F.row_number().over(order) - 1).alias("section_no"),
        F.when(F.col("_pos").isNotNull(), F.col("_head")).alias("header"),
        F.col("_pos.block").alias("header_block"),
        F.col("_pos.idx").alias("header_idx"),
        "lines",
    )


def route_sections(headers: DataFrame, dims: Sequence[DimSpec]) -> DataFrame:
    """Add ``dim``: the first spec whose keyword occurs in the header (case-insensitive)."""
    low = F.lower(F.col("header"))
    dim: Column = F.lit(None).cast("string")
    for d in reversed(list(dims)):
        dim = F.when(low.contains(d.keyword.lower()), F.lit(d.table)).otherwise(dim)
    return headers.withColumn("dim", dim)


def header_fields(header: Column) -> Column:
    """Field names of a header line, stripped and in lower case."""
    return F.transform(csv_fields(header), lambda x: F.lower(stripped(x)))


def header_widths(routed: DataFrame, dims: Sequence[DimSpec] = ()
                  ) -> dict[str | None, tuple[int, int]]:
    """``{dim: (sections, widest header)}`` (``None``: unrouted) -- one small row per dimension.

    A section routed to one of ``dims`` must name its id and name columns, as
    a column lookup by name would otherwise fail; the first offending header is
    reported.
    """
    names = header_fields(F.col("header"))
    ok = F.lit(True)
    for d in dims:
        has = (F.array_contains(names, d.id_col.lower())
               & F.array_contains(names, d.name_col.lower()))
        ok = F.when(F.col("dim") == d.table, has).otherwise(ok)
    rows = routed.groupBy("dim").agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.max(F.size(names)), F.lit(0)).alias("w"),
        F.first(F.when(~ok, F.col("header")), ignorenulls=True).alias("bad_header")).collect()
    for r in rows:
        if r["bad_header"] is not None:
            raise ValueError(f"sections routed to {r['dim']} must name the dimension's id and "
                             f"name columns; header: {r['bad_header']!r}")
    return {r["dim"]: (int(r["n"]), int(r["w"])) for r in rows}


def section_to_dim(sections: DataFrame, routed: DataFrame, dim: DimSpec,
                   id_type: T.DataType = T.IntegerType(),
                   n_sections: int | None = None, width: int | None = None) -> DataFrame:
    """``(dim.id_col, dim.out_name)`` rows of the sections routed to ``dim``.

    Lines after the header are parsed by Spark's CSV parser (``from_csv``)
    with as many string fields as the header has, as a header-based CSV read
    would; the id and name fields are then found by header name
    (case-insensitive).  Ids are cast leniently; rows without an id are
    dropped (FLT1).  ``n_sections`` / ``width`` (sections routed to ``dim``,
    widest header) are computed when not given; the count decides whether
    the header rows are broadcast.
    """
    heads = routed.where(F.col("dim") == dim.table).select(
        "file", "section", "header", "header_block", "header_idx")
    if n_sections is None or width is None:
        n_sections, width = header_widths(routed).get(dim.table, (0, 0))
    # One row per section: broadcast it (size checked), so a section holding
    # most of the lines is never shuffled into one task.
    if n_sections <= BROADCAST_MAX_SECTIONS:
        heads = F.broadcast(heads)
    body = sections.join(heads, ["file", "section"]).where(
        ~((F.col("block") == F.col("header_block")) & (F.col("idx") == F.col("header_idx")))
        & (F.col("line") != ""))
    names = header_fields(F.col("header"))
    id_pos = F.array_position(names, dim.id_col.lower())
    name_pos = F.array_position(names, dim.name_col.lower())
    width = max(width, 1)
    parsed = F.from_csv(F.col("line"), ", ".join(f"_c{i} STRING" for i in range(width)))
    fields = F.array(*[parsed[f"_c{i}"] for i in range(width)])
    pick = lambda p: F.when(p > 0, F.try_element_at(fields, p.cast("int")))
    out = body.select(
        lenient_cast(pick(id_pos), id_type).alias(dim.id_col),
        pick(name_pos).alias(dim.out_name),
    )
    return out.where(F.col(dim.id_col).isNotNull())
