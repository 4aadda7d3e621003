"""Size-checked broadcast and lineage cuts.

A dimension is broadcast only after its row count has been *proven* below a
bound; beyond the bound the join stays a shuffle join (sort-merge, with AQE's
skew-join splitting hot keys).  Where a frame is written anyway, the proof is
the row count observed during the write (``tables.write_counted``), which
costs no job; otherwise it is a plain count, of which each task sends one
number — run it over stored data, not over a long lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_BROADCAST_MAX_ROWS = 1_000_000


def row_count_at_most(df: DataFrame, max_rows: int) -> bool:
    return df.count() <= max_rows


def broadcast_if_bounded(df: DataFrame, max_rows: int | None = DEFAULT_BROADCAST_MAX_ROWS,
                         checked: bool = False) -> DataFrame:
    """``F.broadcast(df)`` when ``df`` has at most ``max_rows`` rows, else ``df``.

    ``checked=True`` means the caller already knows the bound (e.g. a list of
    configured stream names); ``max_rows=None`` disables broadcasting.
    """
    if max_rows is None:
        return df
    if checked or row_count_at_most(df, max_rows):
        return F.broadcast(df)
    return df
