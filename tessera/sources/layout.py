"""Day-partitioned tables clustered by a Z-order key and sized by their data (A5)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.session import scratch_path
from tessera.sources import fs
from tessera.sources.tables import write_counted

#: Ranges of each clustering column: 2 ** BITS; rows sampled for their bounds.
BITS, SAMPLE_ROWS = 6, 20_000
TARGET_BYTES, LEAST_BYTES = 256 << 20, 4 << 20


def range_bounds(stored: DataFrame, columns: list[str], rows: int, bits: int = BITS,
                 sample_rows: int = SAMPLE_ROWS) -> dict[str, list]:
    """For each column at most 2**bits - 1 values that cut it into ranges of about equal rows.

    Taken from a sample of about ``sample_rows`` rows, whatever the table's size; a value
    that is more frequent than a range gets one of its own.
    """
    share = min(1.0, sample_rows / max(1, rows))
    sample = stored.select(*columns).sample(share, seed=7).limit(2 * sample_rows).collect()
    out = {}
    for c in columns:
        values = sorted(r[c] for r in sample if r[c] is not None)
        n = 1 << bits
        out[c] = sorted({values[len(values) * i // n] for i in range(1, n)}) if values else []
    return out


def range_of(column: str, bounds: list, bits: int = BITS) -> Column:
    """Number of bounds that are at most the value, spread over 2**bits places, so that a
    column of few values weighs as much as one of many: a balanced tree of comparisons, as
    many for a row as the number has bits; null counts as the smallest value."""
    def tree(lo: int, hi: int) -> str:
        if lo == hi:
            return str((lo << bits) // (len(bounds) + 1))
        mid = (lo + hi) // 2
        return f"CASE WHEN x.v >= x.b[{mid}] THEN {tree(mid + 1, hi)} ELSE {tree(lo, mid)} END"
    text = tree(0, len(bounds))
    for i, value in enumerate(bounds):
        text = text.replace(f"x.b[{i}]", _literal(value))
    return F.expr(text.replace("x.v", f"`{column}`")).cast("long")


def _literal(value) -> str:
    if isinstance(value, str):
        escaped = value.replace("\\", "\\\\").replace("'", "\\'")
        return f"'{escaped}'"
    if isinstance(value, (bool, int)):
        return str(value)
    if isinstance(value, float):
        return f"double('{value!r}')"
    return f"'{value}'"  # dates, timestamps and decimals: cast to the column's type by the comparison


def interleaved(ranges: list[str], bits: int = BITS) -> Column:
    """Z-order number of the named range columns: their bits in turns, the highest first."""
    return F.expr(" | ".join(f"shiftleft(shiftright({r}, {bit}) & 1L, {bit * len(ranges) + len(ranges) - 1 - i})"
                             for bit in range(bits) for i, r in enumerate(ranges)))


def write_clustered_table(df: DataFrame, path: str, day_source: str, day_col: str, cluster_by: list[str],
                          tiebreak: list[str] | tuple = (), target_bytes: int = TARGET_BYTES,
                          order: str = "z") -> dict:
    """A5: rebuild a table partitioned by the day of ``day_source`` and clustered on up to three columns.

    ``df`` is computed once, to a staged table; its rows and bytes size the result, and a
    bounded sample of its clustering columns gives the ranges that the Z-order key
    interleaves, so that files have tight minima and maxima in *each* of the columns,
    not only in the first.  Files are ranges of (day, key, tiebreak): about
    ``target_bytes`` each, and never fewer rows' worth than lets all cores write a small
    table.  ``order="sorted"`` ranges on the columns one after the other instead.
    """
    spark = df.sparkSession
    staged_path = scratch_path(spark, "clustered")
    out = df.withColumn(day_col, F.to_date(day_source))
    rows = write_counted(out, staged_path)
    stored = spark.read.schema(out.schema).parquet(staged_path)
    size = fs.total_bytes(spark, staged_path)
    least = min(spark.sparkContext.defaultParallelism, -(-size // LEAST_BYTES))
    files = max(1, least, -(-size // target_bytes))
    if order == "z" and cluster_by:
        bounds = range_bounds(stored, list(cluster_by), rows)
        places = {f"_r{i}": range_of(c, bounds[c]) for i, c in enumerate(cluster_by)}
        keyed = stored.withColumns(places).withColumn("_z", interleaved(list(places))).drop(*places)
        keys = [day_col, "_z", *tiebreak]
    else:
        keyed, keys = stored.withColumn("_z", F.lit(0)), [day_col, *cluster_by, *tiebreak]
    (keyed.repartitionByRange(files, *keys).sortWithinPartitions(*keys).drop("_z")
     .write.mode("overwrite").partitionBy(day_col).parquet(path))
    return {"rows": rows, "bytes": size, "ranges": files}
