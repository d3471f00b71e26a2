"""Lenient string -> integral casting (CAST1).

Spark 4 runs with ANSI mode on by default, where ``cast('abc' as int)``
raises.  Curation needs the older, forgiving behaviour: unparsable text
becomes null so it can be *counted* as a cast failure instead of failing
the job.  ``try_cast`` alone is not enough because it rejects decimal text
(``'12.7'``) that the non-ANSI cast truncates to ``12``.  The recipe below
rewrites decimal text to its integral part first, then ``try_cast``s, which
reproduces the non-ANSI result (surrounding whitespace allowed, fraction
truncated toward zero, out-of-range -> null) without touching the session's
ANSI setting.  Everything stays a JVM expression inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# "  -12.75 " -> "  -012", ".5" and "." -> "0", "-.5" -> "-0": the fraction is dropped and a
# zero put before the digits, if any (without integral digits the non-ANSI cast yields 0).
_DECIMAL_TEXT = r"^(\s*[+-]?)(\d*)\.\d*\s*$"
_INTEGRAL_PART = "$10$2"      # group 1, a zero, group 2 (there is no group 10)

INTEGRAL_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lenient_cast(c: Column | str, data_type: T.DataType | str) -> Column:
    """Cast ``c`` to ``data_type``; values that cannot be cast become null.

    For integral targets, decimal text is truncated like the non-ANSI cast.
    Other targets use ``try_cast`` directly.
    """
    col = _as_col(c)
    dt = T._parse_datatype_string(data_type) if isinstance(data_type, str) else data_type
    if isinstance(dt, INTEGRAL_TYPES):
        text = col.cast("string")
        # Fast path: plain integer text casts directly (no regex evaluated;
        # coalesce only evaluates the rewrite when the direct cast fails).
        rewritten = F.regexp_replace(text, _DECIMAL_TEXT, _INTEGRAL_PART)
        return F.coalesce(text.try_cast(dt), rewritten.try_cast(dt))
    if isinstance(dt, T.StringType):
        return col.cast(dt)
    return col.try_cast(dt)


def lenient_cast_expr(name: str, dt: T.DataType) -> str:
    """:func:`lenient_cast` of a quoted column as SQL text."""
    kind = dt.simpleString()
    if isinstance(dt, INTEGRAL_TYPES):
        text = f"CAST({name} AS STRING)"
        pattern = _DECIMAL_TEXT.replace("\\", "\\\\")
        return (f"coalesce(try_cast({text} AS {kind}), "
                f"try_cast(regexp_replace({text}, '{pattern}', '{_INTEGRAL_PART}') AS {kind}))")
    return f"CAST({name} AS {kind})" if isinstance(dt, T.StringType) else f"try_cast({name} AS {kind})"


def cast_failed(c: Column | str, data_type: T.DataType | str) -> Column:
    """True where a non-null value does not survive :func:`lenient_cast`."""
    col = _as_col(c)
    return col.isNotNull() & lenient_cast(col, data_type).isNull()
