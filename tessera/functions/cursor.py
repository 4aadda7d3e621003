"""Opaque ingestion cursors ``cursor_<stream>_<position>``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CURSOR_PREFIX = "cursor"  # fixed value: cursor text is cursor_<stream>_<n>


def cursor_position(col: Column | str) -> Column:
    """Last ``_``-separated token as BIGINT; NULL when it is not an integer."""
    c = F.col(col) if isinstance(col, str) else col
    return F.element_at(F.split(c, "_"), -1).try_cast("bigint")


def format_cursor(stream: Column | str, position: Column | str) -> Column:
    s = F.col(stream) if isinstance(stream, str) else stream
    p = F.col(position) if isinstance(position, str) else position
    return F.concat(F.lit(CURSOR_PREFIX + "_"), s, F.lit("_"), p.cast("string"))
