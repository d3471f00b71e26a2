"""Column -> Column functions: casting, strings, value maps, numbers, JSON."""

from curate.functions.casting import cast_failed, lenient_cast
from curate.functions.conditional import LOWER, bucket, canonical, ordinal
from curate.functions.jsonfmt import field, format_metric, payload, utc_now_iso
from curate.functions.numeric import pct
from curate.functions.text import (basename, contains_ci, csv_fields, interval_bounds,
                                   string_columns, strip_chars, trim_strings)

__all__ = [
    "LOWER", "basename", "bucket", "canonical", "cast_failed", "contains_ci", "csv_fields",
    "field", "format_metric", "interval_bounds", "lenient_cast", "ordinal", "payload", "pct",
    "string_columns", "strip_chars", "trim_strings", "utc_now_iso",
]
