"""Hourly API ingestion cycle (P4): cursors -> extract -> land -> raw append ->
silver -> cursor advance, all streams in one Spark job per step.

Commit order is land -> raw -> silver -> cursors.  Landing and raw rows live in
folders of the run, which a retry replaces as a whole, and silver is merged by
key from the run's own raw rows, whatever its stamp is: no row depends on a
comparison with an earlier run's stamp.  The cursor table's next version names
the run that commits it, so "the cursors moved" and "the run is finished" are one
atomic step.  A crash before it makes the retry read the same offsets (and what
the log has gained) again; a run that is finished is not run again and its
folders stay untouched.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators import incremental as inc
from tessera.operators.silver import api_silver_projection
from tessera.operators.sizing import DEFAULT_BROADCAST_MAX_ROWS
from tessera.schemas import API_RAW, WATERMARKS
from tessera.sources import bindings, fs
from tessera.sources.keyed import KeyedTable
from tessera.sources.tables import (
    VersionedTable,
    expire_partitions,
    load_landed,
    run_folder,
    write_landing,
)

RAW_RUN = T.StructType(API_RAW.fields + [T.StructField("_ingest_date", T.DateType())])
LANDED = T.StructType(API_RAW.fields + [T.StructField("dt", T.DateType())])


@dataclass
class ApiTables:
    root: str

    @property
    def landing(self) -> str:
        return f"{self.root}/landing"

    @property
    def raw(self) -> str:
        return f"{self.root}/raw"

    @property
    def rejects(self) -> str:
        return f"{self.root}/rejects"

    def silver(self, spark: SparkSession) -> KeyedTable:
        return KeyedTable(spark, f"{self.root}/silver", "event_id")

    def watermarks(self, spark: SparkSession) -> VersionedTable:
        return VersionedTable(spark, f"{self.root}/watermarks")


def merge_into(table: KeyedTable, source: DataFrame, key: str | list[str],
               on_duplicate: str = "error", order_col: str | None = None,
               broadcast_max_rows: int | None = DEFAULT_BROADCAST_MAX_ROWS,
               mark_col: str | None = None, mark_by: str | None = None,
               mark_groups: list[str] | None = None) -> str:
    """Upsert ``source`` into a keyed table; returns append / rewrite / noop.

    See :meth:`KeyedTable.merge`: only buckets with a redelivered key are written anew.
    With ``mark_col`` the newest value per ``mark_by`` is kept in the table's pointer as
    its high-water mark, so the next incremental run does not scan the table for it.  The
    marks of ``mark_groups`` (the known values of ``mark_by``) are observed while the
    source is staged; without them they are collected from the source's groups.
    """
    if (keys := [key] if isinstance(key, str) else list(key)) != table.key:
        raise ValueError(f"the table's key is {table.key}, not {keys}")
    if on_duplicate == "latest":
        source = inc.upsert(None, source, key, "latest", order_col)
    metrics = []
    if mark_col is not None:
        micros = F.unix_micros(F.col(mark_col).cast("timestamp"))
        if mark_groups:
            metrics = [F.max(F.when(F.col(mark_by) == F.lit(g), micros)).alias(f"mark:{g}") for g in mark_groups]
        elif mark_by is None:
            metrics = [F.max(micros).alias("mark:")]

    def marks(observed: dict, old: dict | None) -> dict | None:
        if mark_col is None:
            return old
        merged = dict(old or {})
        for stat, v in observed.items():
            if stat.startswith("mark:") and v is not None:
                g = stat[len("mark:"):]
                merged[g] = max(merged.get(g, v), v)
        return merged

    if mark_col is not None and mark_by is not None and not mark_groups:
        found = source.groupBy(F.col(mark_by).cast("string").alias("g")).agg(F.max(micros).alias("v")).collect()
        known = {f"mark:{r['g']}": r["v"] for r in found}
        return table.merge(source, on_duplicate, lambda _, old: marks(known, old), broadcast_max_rows=broadcast_max_rows).mode
    return table.merge(source, on_duplicate, marks, metrics, broadcast_max_rows).mode


def marks_as_timestamps(marks: dict | None) -> dict | None:
    """Pointer marks (unix micros per group) -> datetimes for ``incremental_filter``."""
    if marks is None:
        return None
    import datetime as _dt
    epoch = _dt.datetime(1970, 1, 1)
    return {k: epoch + _dt.timedelta(microseconds=int(v)) for k, v in marks.items()}


def _finished(spark: SparkSession, tables: ApiTables, wm: VersionedTable, run_id: str) -> bool:
    """Whether the run committed its cursors (or found nothing to commit).

    The run's note says which version of the cursor table it was about to
    commit; that version names the run that did.
    """
    note = fs.read_text(spark, f"{tables.root}/runs/{run_id}.done")
    if note is not None:
        return True
    for name in fs.list_files(spark, f"{tables.root}/runs"):
        if name.startswith(f"{run_id}.v") and wm.run_of(int(name.rsplit(".v", 1)[1])) == run_id:
            fs.publish_new(spark, f"{tables.root}/runs/{run_id}.done", "")
            return True
    return False


def run_cycle(spark: SparkSession, log: DataFrame, tables: ApiTables, streams: list[str],
              stamp, run_id: str, value_path: str = "$.value", message_path: str = "$.message",
              keep_days: int | None = None, after_step: Callable[[str], None] = lambda step: None,
              max_rejected: int = 0, forget_before: str | None = None) -> dict:
    """One ingestion run over a stream log ``(stream_name, pos, event_id,
    stream_type, data, timestamp)``.  Returns a small report.

    ``stamp`` may be older than an earlier run's (a backfill) or equal to it.
    ``keep_days`` expires landed days that are older than that before the stamp.
    Landed lines that cannot be read are set aside; more than ``max_rejected`` of them stop
    the run before silver and cursors move.  ``forget_before`` (a UTC time) deletes what only
    table versions superseded by then hold.
    ``after_step`` is called after each commit point (land, raw, silver, cursors).
    """
    wm_table = tables.watermarks(spark)
    if _finished(spark, tables, wm_table, run_id):
        return {"run_id": run_id, "silver_write": "finished before"}
    base = wm_table.version
    wm = wm_table.read()
    cursors = inc.lookup_rows(spark, streams, wm)
    extracted = inc.extract_new(log, cursors)

    # land: NDJSON per stream and ingestion day in the run's folder; the newest
    # consumed offset per stream is observed in the same pass
    landing_dir = run_folder(tables.landing, run_id)
    obs = Observation(f"cursors_{run_id}")
    rows = (inc.sanitize(extracted.observe(obs, *inc.cursor_metrics(streams)), stamp)
            .withColumn("dt", F.to_date("ingested_at")))
    write_landing(rows, landing_dir)
    metrics = obs.get
    after_step("land")

    # raw: the landed files loaded into the run's folder of the raw table
    loaded = load_landed(spark, landing_dir, LANDED, API_RAW.fieldNames(), tables.raw, tables.rejects, run_id, max_rejected)
    after_step("raw")

    # silver: this run's raw rows, merged by key
    own = spark.read.schema(RAW_RUN).parquet(run_folder(tables.raw, run_id))
    mode = merge_into(tables.silver(spark), api_silver_projection(own, value_path, message_path), "event_id",
                      mark_col="ingested_at", mark_by="source_stream", mark_groups=streams)
    after_step("silver")

    # cursors last (one row per stream: keys unique by construction)
    if any(v is not None for v in metrics.values()):
        new_cursors = inc.cursors_from_metrics(spark, metrics, stamp)
        fs.publish_new(spark, f"{tables.root}/runs/{run_id}.v{base + 1}", "")
        wm_table.commit_rewrite(inc.upsert(wm, new_cursors, "stream_name", "checked", source_small=True)
                                .select(*WATERMARKS.fieldNames()), wm_table.marks(), base, run_id)
        after_step("cursors")
    fs.publish_new(spark, f"{tables.root}/runs/{run_id}.done", "")
    expired = []
    if keep_days is not None:
        expired = expire_partitions(spark, tables.landing, "dt", str(stamp)[:10], keep_days)
    forgotten = forget_versions(spark, tables, forget_before) if forget_before is not None else []
    return {"run_id": run_id, "silver_write": mode, "expired": len(expired), "forgotten": len(forgotten), **loaded}


def forget_versions(spark: SparkSession, tables: ApiTables, before: str) -> list[str]:
    """Delete what only versions superseded before ``before`` (UTC) hold, of silver and cursors.

    A run that is not noted as done may have committed the cursor version its note names:
    that version's pointer stays, so the run is still known to be finished.
    """
    notes = fs.list_files(spark, f"{tables.root}/runs")
    done = {n.removesuffix(".done") for n in notes if n.endswith(".done")}
    named = {int(n.rsplit(".v", 1)[1]) for n in notes if not n.endswith(".done") and n.rsplit(".v", 1)[0] not in done}
    return tables.silver(spark).vacuum(before) + tables.watermarks(spark).vacuum(before, keep=frozenset(named))


# ---------------------------------------------------------------------------
# the two-run scenario used by the registered queries: the log as it stood
# before FIRST_RUN_CUT is ingested at STAMP_1, the whole log at STAMP_2.
FIRST_RUN_CUT = "2024-01-16 00:00:00"
STAMP_1 = "2024-01-16 00:00:00"
STAMP_2 = "2024-01-31 00:00:00"
STREAMS = list(bindings.API_STREAMS.values())


def log_as_of(log: DataFrame, cut: str) -> DataFrame:
    """The append-only log as it was visible at ``cut``."""
    return log.where(F.col("event_ts") < F.lit(cut).cast("timestamp_ntz"))


def two_runs(spark: SparkSession, sf_dir: str, root: str) -> ApiTables:
    log = bindings.api_log(spark, sf_dir)
    tables = ApiTables(root)
    run_cycle(spark, log_as_of(log, FIRST_RUN_CUT), tables, STREAMS, STAMP_1, "1", "$.k")
    run_cycle(spark, log, tables, STREAMS, STAMP_2, "2", "$.k")
    return tables


class Crash(RuntimeError):
    """A run stopped on purpose at a commit point."""


def crashing_runs(spark: SparkSession, sf_dir: str, root: str) -> ApiTables:
    """A scenario of failures that must not lose or repeat a row: run 1 is stopped
    after each commit point in turn and retried with the same id, with a grown log
    and another stamp; a backfill with an older stamp takes the rest of the log;
    then finished runs are started again."""
    log = bindings.api_log(spark, sf_dir)
    tables = ApiTables(root)
    cuts = ["2024-01-05 00:00:00", "2024-01-09 00:00:00", "2024-01-13 00:00:00", FIRST_RUN_CUT]
    for step, cut in zip(("land", "raw", "silver", "cursors"), cuts):
        def stop(done, at=step):
            if done == at:
                raise Crash(at)
        try:
            run_cycle(spark, log_as_of(log, cut), tables, STREAMS, f"{cut[:10]} 23:59:00", "1", "$.k", after_step=stop)
        except Crash:
            pass
    run_cycle(spark, log_as_of(log, FIRST_RUN_CUT), tables, STREAMS, STAMP_1, "1", "$.k")
    run_cycle(spark, log, tables, STREAMS, "2023-12-31 00:00:00", "backfill", "$.k")
    for run in ("1", "backfill"):
        run_cycle(spark, log, tables, STREAMS, STAMP_2, run, "$.k")
    return tables
