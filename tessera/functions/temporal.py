"""Timestamp helpers.  Outputs are TIMESTAMP_NTZ holding UTC wall-clock time."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


ISO_PATTERN = (r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}"
               r"(:[0-9]{2}(\.[0-9]{1,9})?)?(Z|[+-][0-9]{2}:[0-9]{2})?$")


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def to_ntz(col: Column | str, dtype: T.DataType | None = None) -> Column:
    """Cast to TIMESTAMP_NTZ (UTC wall clock).  Strings must be well formed (ANSI error)."""
    c = _c(col)
    if isinstance(dtype, T.TimestampNTZType):
        return c
    if isinstance(dtype, T.StringType):
        return c.cast("timestamp").cast("timestamp_ntz")
    return c.cast("timestamp_ntz")


def parse_iso_timestamp(col: Column | str) -> Column:
    """ISO-8601 text with a full date and a time (seconds, fraction and ``Z`` or
    an offset optional) -> TIMESTAMP_NTZ; NULL for anything else.  The cast
    alone would take a bare time as today's and a bare year as its first day."""
    c = _c(col)
    return F.when(c.rlike(ISO_PATTERN), F.try_to_timestamp(c)).cast("timestamp_ntz")


def iso_utc_text(col: Column | str) -> Column:
    """TIMESTAMP_NTZ -> ``yyyy-MM-ddTHH:mm:ss.ffffffZ`` (the topic's event time format)."""
    return F.date_format(_c(col), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def seconds_to_timestamp(col: Column | str) -> Column:
    """Unix seconds (float) -> TIMESTAMP_NTZ through an integer cast that rounds
    half away from zero (1.5 -> 2, -0.5 -> -1); a bare cast would truncate."""
    return F.timestamp_seconds(F.round(_c(col)).cast("long")).cast("timestamp_ntz")


def epoch_seconds(col: Column | str) -> Column:
    """TIMESTAMP_NTZ (UTC) -> unix seconds as DOUBLE, microseconds kept."""
    return F.unix_micros(_c(col).cast("timestamp")).cast("double") / F.lit(1_000_000.0)


def days_between(as_of: _dt.date | str, col: Column | str) -> Column:
    """Calendar days from the day of ``col`` to ``as_of`` (INT).  ``as_of`` is
    injected, never ``current_date``, so rebuilds are reproducible."""
    day = as_of if isinstance(as_of, _dt.date) else _dt.date.fromisoformat(str(as_of))
    return F.datediff(F.lit(day), F.to_date(_c(col)))
