"""Incremental ingestion: high-water marks, cursors, keyed upserts (A7, A8, B6,
C4, C5, D5, K1).

All per-stream work happens in one job with the stream as a column; the
cursor and high-water-mark tables have one row per configured stream, so
their size is bounded by configuration and they are broadcast or turned into
scan predicates.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.cursor import cursor_position, format_cursor
from tessera.operators.gold import top1
from tessera.operators.sizing import DEFAULT_BROADCAST_MAX_ROWS, broadcast_if_bounded

EPOCH_FLOOR = "1900-01-01 00:00:00"  # fixed value: high-water mark of an empty target
PAGE_SIZE = 1_000  # fixed value: rows per API page


def _ts_lit(value) -> F.Column:
    return F.lit(str(value)).cast("timestamp_ntz")


# ------------------------------------------------------------ high-water mark
def high_water_mark(target: DataFrame | None, stamp_col: str = "ingested_at",
                    by: str | None = None) -> dict[str | None, _dt.datetime | None]:
    """Largest ``stamp_col`` in the target, globally (``by=None``) or per ``by``.

    One aggregate; the result has one row (global) or one row per stream, so
    bringing it to the driver is bounded by configuration, not by data.
    """
    if target is None:
        return {}
    if by is None:
        row = target.agg(F.max(stamp_col).alias("hwm")).first()
        return {None: row["hwm"] if row else None}
    return {r[by]: r["hwm"] for r in
            target.groupBy(by).agg(F.max(stamp_col).alias("hwm")).collect()}


def incremental_filter(raw: DataFrame, target: DataFrame | None, stamp_col: str = "ingested_at",
                       scope: str = "global", by: str = "source_stream",
                       partition_col: str | None = None,
                       marks: dict | None = None,
                       streams: list[str] | None = None) -> DataFrame:
    """Rows of ``raw`` strictly newer than the target's high-water mark.

    ``scope="global"``: one ``MAX`` over the whole target, ``COALESCE``-d to
    1900-01-01 (the upstream behaviour).  ``scope="per_stream"``: one mark per
    ``by`` value; streams unknown to the target are read whole.  The marks are
    computed first and applied as literals, so the predicate reaches the
    parquet scan (and, with ``partition_col`` = an ingest-day partition
    column, prunes whole day folders).  ``marks`` (per ``by`` value) may be
    given instead of ``target`` when the table keeps them as metadata, so no
    scan of the target is needed at all.  With ``streams`` (the configured
    list) the raw side is known to hold only those streams; when every one
    of them has a mark, the smallest mark is added as a plain conjunct, which
    the scan and the partition pruner can use (an OR over streams alone
    cannot prune folders).
    """
    if marks is None:
        marks = high_water_mark(target, stamp_col, None if scope == "global" else by)
    elif scope == "global":
        marks = {None: max((v for v in marks.values() if v is not None), default=None)}
    if scope == "global":
        hwm = marks.get(None) or _dt.datetime.fromisoformat(EPOCH_FLOOR)
        cond = F.col(stamp_col) > _ts_lit(hwm)
        if partition_col is not None:
            cond = cond & (F.col(partition_col) >= F.lit(hwm.date()))
        return raw.where(cond)
    known = {k: v for k, v in marks.items() if k is not None and v is not None}
    if streams is not None:
        known = {k: v for k, v in known.items() if k in streams}
        pending = [s_ for s_ in streams if s_ not in known]
        cond = F.col(by).isin(*pending) if pending else F.lit(False)
    else:
        if not known:
            return raw
        cond = ~F.col(by).isin(*known) | F.col(by).isNull()
    for stream, hwm in known.items():
        part = (F.col(by) == F.lit(stream)) & (F.col(stamp_col) > _ts_lit(hwm))
        if partition_col is not None:
            part = part & (F.col(partition_col) >= F.lit(hwm.date()))
        cond = cond | part
    if streams is not None and known and len(known) == len(streams):
        floor = min(known.values())
        cond = cond & (F.col(stamp_col) > _ts_lit(floor))
        if partition_col is not None:
            cond = cond & (F.col(partition_col) >= F.lit(floor.date()))
    return raw.where(cond)


# -------------------------------------------------------------------- upsert
def upsert(target: DataFrame | None, source: DataFrame, key: str | list[str],
           on_duplicate: str = "error", order_col: str | None = None,
           broadcast_max_rows: int | None = DEFAULT_BROADCAST_MAX_ROWS,
           source_small: bool | None = None) -> DataFrame:
    """MERGE semantics: source rows replace target rows with the same key, new
    keys are inserted, other target rows are kept.

    ``on_duplicate="error"`` fails when the source holds a key twice (as a
    warehouse MERGE does); ``"latest"`` keeps the row with the largest
    ``order_col``; ``"checked"`` means the caller has already proven the
    source keys unique (e.g. the output of a ``groupBy`` on the key).  The
    anti join broadcasts the source *keys* only when their count is proven
    small (``source_small=True`` when the caller already holds that proof,
    ``False`` to never broadcast); otherwise it is a shuffle join.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if on_duplicate == "latest":
        if order_col is None:
            raise ValueError("on_duplicate='latest' needs order_col")
        source = top1(source, keys, [F.col(order_col).desc_nulls_last()])
    elif on_duplicate == "error":
        dup = source.groupBy(*keys).count().where(F.col("count") > 1).limit(1).collect()
        if dup:
            raise ValueError(f"source holds key {dup[0].asDict()} more than once")
    elif on_duplicate != "checked":
        raise ValueError(f"unknown on_duplicate={on_duplicate!r}")
    if target is None:
        return source
    src_keys = source.select(*keys).distinct()
    if source_small is None:
        src_keys = broadcast_if_bounded(src_keys, broadcast_max_rows)
    elif source_small:
        src_keys = F.broadcast(src_keys)
    kept = target.join(src_keys, keys, "left_anti")
    return source.unionByName(kept.select(*source.columns))


def stamp_updates(df: DataFrame, stamp, column: str = "updated_at") -> DataFrame:
    return df.withColumn(column, _ts_lit(stamp))


# --------------------------------------------------------------- cursors
def stream_list(spark: SparkSession, streams: list[str]) -> DataFrame:
    schema = T.StructType([T.StructField("stream_name", T.StringType(), False)])
    return spark.createDataFrame([(s,) for s in streams], schema)


def lookup_rows(spark: SparkSession, streams: list[str], watermarks: DataFrame | None,
                strict: bool = True) -> list:
    """C4/K2 as driver rows ``(stream_name, current_cursor, cursor_pos)``: every
    configured stream with its stored cursor (NULL = start from the
    beginning) and the parsed position.  A non-NULL cursor that does not parse
    is an error (``strict``) rather than a silent full reload.  The join runs
    in Spark; its result has one row per *configured* stream, so bringing it
    to the driver is bounded by configuration."""
    cfg = stream_list(spark, streams)
    if watermarks is None:
        out = cfg.select("stream_name", F.lit(None).cast("string").alias("current_cursor"))
    else:
        # at most one row per configured stream (the newest), so the broadcast
        # side is bounded by the configuration whatever the table holds
        latest = (watermarks.where(F.col("stream_name").isin(*streams))
                  .groupBy("stream_name")
                  .agg(F.max_by("current_cursor", "updated_at").alias("current_cursor")))
        out = cfg.join(F.broadcast(latest), "stream_name", "left")
    rows = out.withColumn("cursor_pos", cursor_position("current_cursor")).collect()
    if strict:
        bad = [r.asDict() for r in rows if r.current_cursor is not None and r.cursor_pos is None]
        if bad:
            raise ValueError(f"unparsable cursors: {bad}")
    return rows


LOOKUP_SCHEMA = T.StructType([T.StructField("stream_name", T.StringType(), False),
                              T.StructField("current_cursor", T.StringType(), True),
                              T.StructField("cursor_pos", T.LongType(), True)])


def watermark_lookup(spark: SparkSession, streams: list[str], watermarks: DataFrame | None,
                     strict: bool = True) -> DataFrame:
    """C4/K2 as a (small, local) DataFrame; see :func:`lookup_rows`."""
    rows = lookup_rows(spark, streams, watermarks, strict)
    return spark.createDataFrame([tuple(r) for r in rows], LOOKUP_SCHEMA)


def extract_new(log: DataFrame, cursors, page_size: int = PAGE_SIZE) -> DataFrame:
    """K1: rows of the stream log beyond each stream's cursor, all streams in one job.

    ``pos`` is the log's own monotonic offset within a stream, so the cut is a
    plain comparison (no ``row_number`` that would put a whole stream in one
    task).  The cursors (one row per configured stream) become literal
    predicates instead of a join: an exact per-stream condition plus the
    weaker ``pos > min(cursor)`` bound, which Catalyst pushes into the scan
    so parquet row-group statistics skip data that was consumed before.  The
    page label is arithmetic on the offset.  ``cursors`` is the lookup's
    DataFrame or its rows (:func:`lookup_rows`).
    """
    rows = (cursors.select("stream_name", "cursor_pos").collect()  # bounded by configuration
            if isinstance(cursors, DataFrame) else list(cursors))
    if not rows:
        return log.where(F.lit(False)).withColumn("page", F.lit(None).cast("long"))
    stream, pos = F.col("stream_name"), F.col("pos")
    keep = None
    base = None
    for r in rows:
        this = stream == F.lit(r.stream_name)
        cond = this if r.cursor_pos is None else this & (pos > F.lit(r.cursor_pos))
        keep = cond if keep is None else keep | cond
        start = F.lit(-1 if r.cursor_pos is None else r.cursor_pos).cast("long")
        base = F.when(this, start) if base is None else base.when(this, start)
    out = log.where(keep)
    if all(r.cursor_pos is not None for r in rows):
        out = out.where(pos > F.lit(min(r.cursor_pos for r in rows)))
    return out.withColumn("page", F.floor((pos - base - 1) / F.lit(page_size)).cast("long"))


def cursor_metrics(streams: list[str], stream_col: str = "stream_name",
                   pos_col: str = "pos") -> list[F.Column]:
    """Per-stream ``max(pos)`` as observation metrics: attached with
    ``DataFrame.observe`` they are computed in the same pass that lands the
    rows (max is idempotent, so a retried task cannot skew it)."""
    return [F.max(F.when(F.col(stream_col) == F.lit(s), F.col(pos_col))).alias(s)
            for s in streams]


def cursors_from_metrics(spark: SparkSession, metrics: dict, stamp) -> DataFrame:
    """C5 from observed metrics: streams that produced nothing are dropped."""
    rows = [(s, f"cursor_{s}_{int(p)}") for s, p in metrics.items() if p is not None]
    schema = T.StructType([T.StructField("stream_name", T.StringType(), False),
                           T.StructField("current_cursor", T.StringType(), True)])
    return spark.createDataFrame(rows, schema).withColumn("updated_at", _ts_lit(stamp))


def advance_cursors(spark: SparkSession, streams: list[str], extracted: DataFrame, stamp,
                    ) -> DataFrame:
    """D5 + C5: newest consumed position per stream -> new cursor rows; streams
    that produced nothing are dropped (they keep their stored cursor)."""
    newest = extracted.groupBy("stream_name").agg(F.max("pos").alias("last_pos"))
    cfg = F.broadcast(stream_list(spark, streams))  # a Python list: size known
    return (cfg.join(newest, "stream_name", "inner")
            .where(F.col("last_pos").isNotNull())
            .select("stream_name",
                    format_cursor("stream_name", "last_pos").alias("current_cursor"),
                    _ts_lit(stamp).alias("updated_at")))


def sanitize(extracted: DataFrame, stamp, stream_col: str = "stream_name",
             extra: tuple[str, ...] = ()) -> DataFrame:
    """Raw landing shape — one ingestion stamp per run, stream name tag
    (plus any ``extra`` bookkeeping columns the caller wants to carry)."""
    return extracted.select(
        _ts_lit(stamp).alias("ingested_at"),
        F.col(stream_col).alias("source_stream"),
        "event_id", "stream_type", "data", "timestamp", *extra,
    )


def merge_into_catalog_table(source: DataFrame, table_name: str, key: str | list[str]) -> None:
    """A8 on a row-level table format (Delta / Iceberg catalog table): a real
    ``MERGE`` — matched rows updated, new keys inserted — so only the files
    holding matched keys are rewritten.  Needs the format's catalog on the
    classpath; plain parquet tables reject it (use ``api_ingest.merge_into``)."""
    keys = [key] if isinstance(key, str) else list(key)
    cond = None
    for k in keys:
        c = F.col(f"{table_name}.{k}") == F.col(f"source.{k}")
        cond = c if cond is None else cond & c
    (source.alias("source").mergeInto(table_name, cond)
     .whenMatched().updateAll()
     .whenNotMatched().insertAll()
     .merge())
