"""String column functions (STR1-STR8).

All are thin, JVM-side compositions of ``pyspark.sql.functions``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curate.functions.casting import lenient_cast


def _as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def string_columns(df: DataFrame) -> list[str]:
    """Names of the ``StringType`` columns of ``df`` in schema order (PRJ5)."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def trim_strings(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """``trim`` every string column (spaces only, like ``F.trim``) in one projection."""
    targets = set(string_columns(df) if cols is None else cols)
    return df.select([F.trim(F.col(f"`{c}`")).alias(c) if c in targets else F.col(f"`{c}`")
                      for c in df.columns])


def strip_chars(c: Column | str, chars: str) -> Column:
    """Remove every occurrence of any character in ``chars`` (STR4: ``strip_chars(c, '.')``)."""
    if not chars:
        return _as_col(c)
    cls = "".join("\\" + ch if ch in "\\^]-[" else ch for ch in chars)
    return F.regexp_replace(_as_col(c), f"[{cls}]", "")


def interval_bounds(c: Column | str) -> tuple[Column, Column]:
    """Parse ``"[lo-hi)"`` into ``(lo int, hi int)``; no match gives null (STR5)."""
    col = _as_col(c)
    lo = lenient_cast(F.regexp_extract(col, r"\[(\d+)-", 1), T.IntegerType())
    hi = lenient_cast(F.regexp_extract(col, r"-(\d+)\)", 1), T.IntegerType())
    return lo, hi


def basename(c: Column | str) -> Column:
    """Text after the last ``/`` (STR6)."""
    return F.substring_index(_as_col(c), "/", -1)


def contains_ci(c: Column | str, needle: str) -> Column:
    """Case-insensitive substring test (STR8)."""
    return F.lower(_as_col(c)).contains(needle.lower())


def csv_fields(c: Column | str) -> Column:
    """Split one CSV line into an ``array<string>`` of fields.

    Honours double-quoted fields (embedded commas); like Spark's CSV reader
    with default options, doubled quotes inside a quoted field are kept as
    they are, and an empty field, quoted or not, becomes null.
    """
    col = _as_col(c)
    # Every field is matched together with the comma before it (one is prepended),
    # so no match is empty and a leading empty field is not skipped.
    raw = F.regexp_extract_all(F.concat(F.lit(","), col), F.lit(r',("(?:[^"]|"")*"|[^,]*)'), 1)

    def unquote(x: Column) -> Column:
        quoted = x.startswith('"') & x.endswith('"') & (F.length(x) >= 2)
        inner = F.regexp_replace(F.substring(x, 2, 1 << 30), r'"$', "")
        # Spark's reader escapes with a backslash, so doubled quotes stay as they are.
        value = F.when(quoted, inner).otherwise(x)
        # empty fields, quoted or not, read as null (Spark's CSV default nullValue "")
        return F.when(value == "", F.lit(None).cast("string")).otherwise(value)

    return F.transform(raw, unquote)
