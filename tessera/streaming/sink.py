"""Committed batches and compaction of a stream's tables.

The tables of a stream (silver, bronze, dead letters) have a folder for each day, query
and micro-batch.  Two small numbered pointers decide which of them a reader sees:

* ``_batches/<query>/``: the last batch of each query whose writes are all done.  It is
  published after the last table, so bronze, silver and dead letters of a batch become
  visible together; a batch that is replayed although it was committed is left alone.
* ``<table>/_compacted/``: for each compacted day the folder that holds its merged rows,
  and up to which batch of each query it holds them.  Later batches (late rows) are read
  beside it until the next compaction.

Both become predicates on partition columns, so folders that are not visible are pruned
and never listed row by row.
"""

from __future__ import annotations

import datetime as _dt
import json
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.sources import fs
from tessera.sources.tables import StaleVersion

QUERY_COL, BATCH_COL = "query_id", "batch_id"
#: ``query_id`` of folders that a compaction wrote; their ``batch_id`` is its number.
COMPACTED = "compacted"


# ---------------------------------------------------------------- committed batches
def _batches(root: str) -> str:
    return f"{root}/_batches"


def committed(spark: SparkSession, root: str) -> dict[str, int]:
    """Last committed batch of every query; one entry for each checkpoint there ever was."""
    found = {}
    for query in fs.list_dirs(spark, _batches(root)):
        names = fs.list_files(spark, f"{_batches(root)}/{query}")
        if names:
            found[query] = int(names[-1])
    return found


def last_batch(spark: SparkSession, root: str, query: str) -> int:
    names = fs.list_files(spark, f"{_batches(root)}/{query}")
    return int(names[-1]) if names else -1


def commit_batch(spark: SparkSession, root: str, query: str, batch: int) -> None:
    """Make all tables' rows of a batch visible at once."""
    folder = f"{_batches(root)}/{query}"
    before = fs.list_files(spark, folder)
    fs.publish_new(spark, f"{folder}/{batch:020d}", "")
    for name in before[:-1]:  # the one before stays: it is read by whoever listed it just now
        fs.delete(spark, f"{folder}/{name}")


def _text(value: str) -> str:
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def _is_committed(last: dict[str, int]) -> str:
    seen = [f"({QUERY_COL} = {_text(q)} AND {BATCH_COL} <= {n})" for q, n in last.items()]
    return f"({' OR '.join(seen) or 'false'})"


# ----------------------------------------------------------------------- compaction
@dataclass
class Compaction:
    """Number, merged days, rows and files of one compaction."""

    number: int
    days: list[str]
    rows: int = 0
    files: int = 0


def _state(spark: SparkSession, table: str) -> tuple[int, dict]:
    names = fs.list_files(spark, f"{table}/_compacted")
    if not names:
        return 0, {}
    return int(names[-1].removesuffix(".json")), json.loads(fs.read_text(spark, f"{table}/_compacted/{names[-1]}"))


def visible_sql(spark: SparkSession, root: str, table: str, day_col: str | None = None) -> str:
    """Predicate on partition columns: folders of committed batches and live compactions."""
    _, days = _state(spark, table) if day_col else (0, {})
    batch = f"({_is_committed(committed(spark, root))} AND {QUERY_COL} <> {_text(COMPACTED)})"
    if not days:
        return batch
    day = f"date_format({day_col}, 'yyyy-MM-dd')"
    upto = {f"{d}|{q}": n for d, s in days.items() for q, n in s["upto"].items()}
    taken = f"element_at({_map(upto)}, concat({day}, '|', {QUERY_COL}))" if upto else "-1"
    live = f"element_at({_map({d: s['number'] for d, s in days.items()})}, {day})"
    return (f"({batch} AND {BATCH_COL} > coalesce({taken}, -1) OR "
            f"{QUERY_COL} = {_text(COMPACTED)} AND coalesce({live}, -1) = {BATCH_COL})")


def _map(values: dict[str, int]) -> str:
    return f"map({', '.join(f'{_text(k)}, {v}L' for k, v in values.items())})"


def visible(spark: SparkSession, root: str, table: str, day_col: str | None = None) -> Column:
    return F.expr(visible_sql(spark, root, table, day_col))


def read_visible(spark: SparkSession, root: str, table: str, schema: T.StructType, day_col: str | None = None) -> DataFrame:
    return spark.read.schema(schema).parquet(table).where(visible(spark, root, table, day_col))


_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


@contextmanager
def _streamed_writes(spark: SparkSession) -> Iterator[None]:
    """Partitioned writes without Spark's sort by folder, which holds all of a task's rows;
    a task that fills one folder needs one open file instead."""
    before = spark.conf.get(_WRITERS, None)
    spark.conf.set(_WRITERS, "2")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_WRITERS)
        else:
            spark.conf.set(_WRITERS, before)


def compact(spark: SparkSession, root: str, table: str, schema: T.StructType, day_col: str, before: str | _dt.date,
            key: str, target_bytes: int = 256 << 20, min_folders: int = 2) -> Compaction:
    """Merge the batch folders of days earlier than ``before`` into files of about ``target_bytes``.

    Only days with at least ``min_folders`` visible folders are touched.  Folders are
    listed and sized from the file system; one job reads and writes all those days, each
    in as many files as its bytes ask for, rows dealt by ``key``.  A task writes one file as
    its rows arrive, whatever their number.  The merged folder counts
    once the pointer names it; a compaction that stops before leaves no trace but unseen
    files, and of two at once one gets :class:`StaleVersion`.
    """
    number, days = _state(spark, table)
    last, cutoff = committed(spark, root), str(before)
    files: dict[str, int] = {}
    for day in fs.list_partition_values(spark, table, day_col):
        if day < cutoff:
            folders = [(q, int(b)) for q in fs.list_partition_values(spark, f"{table}/{day_col}={day}", QUERY_COL)
                       for b in fs.list_partition_values(spark, f"{table}/{day_col}={day}/{QUERY_COL}={q}", BATCH_COL)]
            state = days.get(day, {"number": -1, "upto": {}})
            live = [(q, b) for q, b in folders if (q == COMPACTED and b == state["number"])
                    or (q != COMPACTED and state["upto"].get(q, -1) < b <= last.get(q, -1))]
            if len(live) >= min_folders:
                size = sum(fs.total_bytes(spark, f"{table}/{day_col}={day}/{QUERY_COL}={q}/{BATCH_COL}={b}") for q, b in live)
                files[day] = max(1, -(-size // target_bytes))
    done = Compaction(number + 1, sorted(files))
    if not files:
        return Compaction(number, [])
    # file number: the day's first number and a hash of the key within the day
    first, total = {}, 0
    for day in done.days:
        first[day], total = total, total + files[day]
    day = F.date_format(F.col(day_col), "yyyy-MM-dd")
    of_day = lambda values: F.element_at(F.expr(_map(values)), day)
    file = of_day(first) + F.pmod(F.xxhash64(key), of_day(files))
    rows = (read_visible(spark, root, table, schema, day_col).where(F.col(day_col).isin(*[_dt.date.fromisoformat(d) for d in done.days]))
            .withColumn(QUERY_COL, F.lit(COMPACTED)).withColumn(BATCH_COL, F.lit(done.number).cast("long"))
            .withColumn("_file", file.cast("int")).repartitionById(total, F.col("_file")).drop("_file"))
    with _streamed_writes(spark):
        (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(day_col, QUERY_COL, BATCH_COL).parquet(table))
    days = days | {d: {"number": done.number, "upto": last} for d in done.days}
    if not fs.publish_new(spark, f"{table}/_compacted/{done.number:012d}.json", json.dumps(days)):
        raise StaleVersion(f"{table}: compaction {done.number} exists already")
    done.files = total
    return done


def drop_superseded(spark: SparkSession, root: str, table: str, day_col: str) -> list[str]:
    """Delete folders that the newest compaction replaced, once no reader uses them any more."""
    _, days = _state(spark, table)
    dropped = []
    for day, state in days.items():
        base = f"{table}/{day_col}={day}"
        for q in fs.list_partition_values(spark, base, QUERY_COL):
            for b in fs.list_partition_values(spark, f"{base}/{QUERY_COL}={q}", BATCH_COL):
                old = int(b) != state["number"] if q == COMPACTED else int(b) <= state["upto"].get(q, -1)
                # a compaction that is being written has a higher number
                if old and not (q == COMPACTED and int(b) > state["number"]):
                    fs.delete(spark, f"{base}/{QUERY_COL}={q}/{BATCH_COL}={b}")
                    dropped.append(f"{day}/{q}/{b}")
    return dropped
