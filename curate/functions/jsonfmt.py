"""JSON payload and formatting helpers (JSN1, JSN2, DT1, FMT1)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def payload(**fields: Column) -> Column:
    """Serialise named columns to one JSON object string (JSN1)."""
    return F.to_json(F.struct(*[_as_col(v).alias(k) for k, v in fields.items()]))


def field(payload_col: Column | str, path: str, data_type: str = "string",
          default: object = None) -> Column:
    """Extract ``$.path`` from a JSON payload, typed, with a default (JSN2)."""
    v = F.get_json_object(_as_col(payload_col), f"$.{path}")
    if data_type != "string":
        v = v.try_cast(data_type)
    return v if default is None else F.coalesce(v, F.lit(default).cast(data_type))


def utc_iso(ts: Column | str) -> Column:
    """A timestamp in UTC as ISO-8601 with a ``Z`` suffix, whatever the session's time zone."""
    return F.date_format(F.to_utc_timestamp(_as_col(ts), F.current_timezone()),
                         "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def utc_now_iso() -> Column:
    """Current UTC time as ISO-8601 with a ``Z`` suffix (DT1)."""
    return utc_iso(F.current_timestamp())


def parsed(payload_col: Column | str) -> Column:
    """A JSON payload parsed once (null if malformed), for :func:`variant_field`."""
    return F.try_parse_json(_as_col(payload_col))


def variant_field(variant: Column | str, path: str, data_type: str = "string",
                  default: object = None) -> Column:
    """``$.path`` of a parsed payload, typed, with a default; objects and arrays come as JSON text."""
    v = F.try_variant_get(_as_col(variant), f"$.{path}", "string").try_cast(data_type)
    return v if default is None else F.coalesce(v, F.lit(default).cast(data_type))


def format_metric(c: Column | str, decimals: int = 0) -> Column:
    """Thousands separators, fixed decimals (FMT1)."""
    return F.format_number(_as_col(c), decimals)
