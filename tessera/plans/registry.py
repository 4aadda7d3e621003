"""Registered queries: one per operator / flow of the inventory.

Each query is ``(spark, sf_dir) -> DataFrame`` over the whole input tables, and
most have a DuckDB oracle in ``ORACLES`` stating the expected result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators import gold, silver
from tessera.operators.audit_history import AuditHistory, StoredModel
from tessera.operators import incremental as inc
from tessera.operators import quality as Q
from tessera.plans import api_ingest, incremental_gold, medallion
from tessera.plans import audit as A
from tessera.plans import oracle as O
from tessera.plans import stream_flow as SF
from tessera.functions.cursor import cursor_position, format_cursor
from tessera.functions.json import json_scalar
from tessera.functions.text import title_case
from tessera.schemas import API_RAW, CORE_TELEMETRY_COLUMNS, RAW_TELEMETRY, with_key_type
from tessera.session import scratch_path
from tessera.sources import bindings, tables
from tessera.sources.keyed import KeyedTable
from tessera.sources.layout import write_clustered_table
from tessera.streaming import bronze as SB
from tessera.streaming import delivery as SD
from tessera.streaming import feed
from tessera.streaming import silver as SS

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


# ------------------------------------------------------------ silver
@register("stg_telemetry", O.table("stg_telemetry"))
def q_stg_telemetry(spark, d):
    """B1: rename, force / 9.80665 -> g, typed event time."""
    return medallion.stg_telemetry(spark, d)


@register("stg_vessels", O.table("stg_vessels"))
def q_stg_vessels(spark, d):
    """Typed projection of the vessels."""
    return silver.stg_vessels(bindings.raw_vessels(spark, d))


@register("title_case_text", r"""
    WITH c AS (SELECT doc_id, string_split(coalesce(text, ''), '') AS ch FROM documents),
    d AS (SELECT doc_id, ch, list_transform(ch, lambda x: contains(chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' []()' || '{}/|\<>!?@"^#$&~_,.:;*%+-', x)) AS cut
          FROM c)
    SELECT doc_id, md5(CASE WHEN len(ch) > 0 THEN array_to_string(list_transform(range(1, len(ch) + 1),
           lambda i: CASE WHEN i = 1 OR cut[i - 1] THEN upper(replace(ch[i], 'ß', 'SS')) ELSE lower(ch[i]) END), '') ELSE '' END) AS titled_md5
    FROM d""")
def q_title_case_text(spark, d):
    """H1: title case of every whole text of ``documents``, against a rule that looks at
    characters one by one (a letter after white space or punctuation is upper case, of a
    sharp s its two letters)."""
    docs = spark.read.parquet(f"{d}/documents.parquet")
    return docs.select("doc_id", F.md5(title_case(F.coalesce("text", F.lit(""))).cast("binary")).alias("titled_md5"))


@register("stg_researchers", O.table("stg_researchers"))
def q_stg_researchers(spark, d):
    """Title-cased names, lower-cased email, typed join time."""
    return silver.stg_researchers(bindings.raw_researchers(spark, d))


# --------------------------------------------------------------- dims (H3, H4)
@register("dim_locations", O.table("dim_locations"))
def q_dim_locations(spark, d):
    """B2: the location dimension."""
    return medallion.dims(spark, d).locations


@register("dim_vessels", O.table("dim_vessels"))
def q_dim_vessels(spark, d):
    """H4: vessel dimension with the age in calendar days at the as-of date."""
    return medallion.dims(spark, d).vessels


@register("dim_researchers", O.table("dim_researchers"))
def q_dim_researchers(spark, d):
    """H3 / H4: researcher dimension with full name and tenure in days."""
    return medallion.dims(spark, d).researchers


# ------------------------------------------------------------ flag / union
@register("low_g_flag", O.with_ctes(
    "SELECT event_id, gravity_g, COALESCE(gravity_g <= 0.1, FALSE) AS is_low_g FROM stg_telemetry"))
def q_low_g_flag(spark, d):
    """``gravity_g <= 0.1``, NULL counted as false."""
    t = medallion.stg_telemetry(spark, d)
    return t.select("event_id", "gravity_g", gold.low_g_flag("gravity_g").alias("is_low_g"))


@register("unified_telemetry", O.table("telemetry_unified"))
def q_unified_telemetry(spark, d):
    """Batch and stream silver under one schema, tagged by ingestion mode."""
    return gold.unified_telemetry(medallion.stg_telemetry(spark, d),
                                  medallion.stg_telemetry_stream(spark, d))


# ------------------------------------------------------------------ joins C1-C3
@register("enrich_vessels", O.with_ctes("""
    SELECT t.event_id, t.vessel_id, v.vessel_name, v.vessel_type, v.age_days AS vessel_age_days
    FROM stg_telemetry t LEFT JOIN dim_vessels v ON t.vessel_id = v.vessel_id"""))
def q_enrich_vessels(spark, d):
    """Events LEFT JOIN vessels (N:1)."""
    t = medallion.stg_telemetry(spark, d)
    v = medallion.dims(spark, d).vessels.select(
        "vessel_id", "vessel_name", "vessel_type", F.col("age_days").alias("vessel_age_days"))
    return t.join(v, "vessel_id", "left").select(
        "event_id", "vessel_id", "vessel_name", "vessel_type", "vessel_age_days")


@register("enrich_locations", O.with_ctes("""
    SELECT t.event_id, t.location_id, l.location_name, l.region
    FROM stg_telemetry t LEFT JOIN dim_locations l ON t.location_id = l.location_id"""))
def q_enrich_locations(spark, d):
    """Events LEFT JOIN locations (N:1)."""
    t = medallion.stg_telemetry(spark, d)
    lo = medallion.dims(spark, d).locations.select("location_id", "location_name", "region")
    return t.join(lo, "location_id", "left").select(
        "event_id", "location_id", "location_name", "region")


@register("enrich_researchers_fanout", O.with_ctes("""
    SELECT t.event_id, t.vessel_id, r.researcher_id, r.full_name AS lead_researcher, r.tenure_days
    FROM stg_telemetry t LEFT JOIN dim_researchers r ON t.vessel_id = r.assigned_vessel_id"""))
def q_enrich_researchers_fanout(spark, d):
    """C3 literal: events LEFT JOIN every researcher of the vessel (N:M fan-out)."""
    t = medallion.stg_telemetry(spark, d)
    r = medallion.dims(spark, d).researchers
    return (t.join(r, t.vessel_id == r.assigned_vessel_id, "left")
            .select("event_id", "vessel_id", "researcher_id",
                    F.col("full_name").alias("lead_researcher"), "tenure_days"))


# ---------------------------------------------------------------- top-1
@register("lead_researcher_top1", O.with_ctes("""
    -- every tenth event delivered twice, the second time by the next vessel
    SELECT t.event_id, t.ingestion_mode, t.vessel_id, r.researcher_id,
           r.full_name AS lead_researcher, r.tenure_days
    FROM (SELECT event_id, ingestion_mode, vessel_id FROM telemetry_unified UNION ALL
          SELECT event_id, ingestion_mode, vessel_id + 1 FROM telemetry_unified WHERE event_id % 10 = 0) t
    LEFT JOIN dim_researchers r ON t.vessel_id = r.assigned_vessel_id
    QUALIFY row_number() OVER (PARTITION BY t.event_id, t.ingestion_mode
                               ORDER BY r.tenure_days DESC NULLS LAST,
                                        r.researcher_id ASC NULLS LAST, t.vessel_id) = 1"""))
def q_lead_researcher_top1(spark, d):
    """E1, lead-first (R1): one lead per vessel, a fan-out-free join, then the top-1 per
    (event_id, ingestion_mode), which redelivered events need."""
    t = gold.unified_telemetry(medallion.stg_telemetry(spark, d),
                               medallion.stg_telemetry_stream(spark, d))
    again = t.where(F.col("event_id") % 10 == 0).withColumn("vessel_id", F.col("vessel_id") + 1)
    t = t.unionByName(again)
    leads = gold.lead_researchers(medallion.dims(spark, d).researchers)
    joined = t.join(leads, t.vessel_id == leads.assigned_vessel_id, "left")
    order = [F.col("tenure_days").desc_nulls_last(), F.col("researcher_id").asc_nulls_last(), F.col("vessel_id")]
    return (gold.top1(joined, ["event_id", "ingestion_mode"], order)
            .select("event_id", "ingestion_mode", "vessel_id", "researcher_id",
                    F.col("full_name").alias("lead_researcher"), "tenure_days"))


# --------------------------------------------------------------- facts
@register("fact_batch_only", O.table("fact_batch"))
def q_fact_batch_only(spark, d):
    """The gold fact with the stream half switched off."""
    return medallion.fact_batch_only(spark, d)


@register("fact_unified", O.table("fact_unified"))
def q_fact_unified(spark, d):
    """P2 (flagship): the gold fact over batch and stream silver."""
    return medallion.fact_unified(spark, d)


@register("fact_incremental", O.table("fact_unified"))
def q_fact_incremental(spark, d):
    """The fact built from silver days in two releases, the second one after later days and
    late rows of earlier ones arrived: only the days they reach are built again."""
    root = scratch_path(spark, "gold-days")
    silver_days = {"batch": medallion.stg_telemetry(spark, d), "stream": medallion.stg_telemetry_stream(spark, d)}
    models = {}
    late = (F.col("observed_at") >= F.lit(_REDELIVERY_FROM).cast("timestamp_ntz")) | (F.col("event_id") % 500 == 0)
    for first in (True, False):
        for mode, df in silver_days.items():
            part = df.select(*CORE_TELEMETRY_COLUMNS).where(~F.coalesce(late, F.lit(False)) if first else F.coalesce(late, F.lit(False)))
            (part.withColumn("day", F.to_date("observed_at")).write.mode("append").partitionBy("day").parquet(f"{root}/{mode}"))
            models[mode] = StoredModel(f"{root}/{mode}", spark.read.parquet(f"{root}/{mode}").schema, "day")
        incremental_gold.incremental_build(spark, f"{root}/gold", models, medallion.dims(spark, d))
    return incremental_gold.read_fact(spark, f"{root}/gold").drop(incremental_gold.DAY)


# =========================================================== API ingestion path

_CUT = api_ingest.FIRST_RUN_CUT
_API_SILVER_COLS = ("event_id, stream_type, source_stream, measure_value, event_message, "
                    "observed_at")


def _api_silver_full(spark, d):
    return silver.api_silver_projection(bindings.api_raw(spark, d), "$.k")


@register("api_union_streams", O.table("api_raw"))
def q_api_union_streams(spark, d):
    """G1: three per-stream tables, UNION ALL by name with a tag per branch."""
    per_stream = {s: bindings.api_raw(spark, d, [s]).drop("source_stream")
                  for s in api_ingest.STREAMS}
    return silver.union_tagged(per_stream)


@register("json_scalar_extract", O.with_ctes(
    "SELECT event_id, measure_value, event_message FROM api_silver"))
def q_json_scalar_extract(spark, d):
    """H8: JSON scalars as text; objects, arrays, null and missing give NULL."""
    return bindings.api_raw(spark, d).select("event_id", json_scalar("data", "$.k").alias("measure_value"),
                                             json_scalar("data", "$.message").alias("event_message"))


@register("stg_api_telemetry", O.table("api_silver"))
def q_stg_api_telemetry(spark, d):
    """K5 full build: G1 -> H8 / H7 projection of every raw API row."""
    return _api_silver_full(spark, d)


@register("sanitize_raw_events", O.with_ctes(f"""
    SELECT TIMESTAMP '{api_ingest.STAMP_1}' AS ingested_at, stream_name AS source_stream,
           event_id, stream_type, data, timestamp FROM api_log"""))
def q_sanitize_raw_events(spark, d):
    """One ingestion stamp per run and the stream tag on every raw row."""
    return inc.sanitize(bindings.api_log(spark, d), api_ingest.STAMP_1)


@register("incremental_filter", O.with_ctes(f"""
    SELECT * FROM api_raw
    WHERE ingested_at > (SELECT COALESCE(MAX(ingested_at), TIMESTAMP '1900-01-01')
                         FROM api_raw WHERE ingested_at < TIMESTAMP '{_CUT}')"""))
def q_incremental_filter(spark, d):
    """B6 (global scope): raw rows beyond the target's high-water mark; the
    target is the silver model as built from rows loaded before the cut."""
    raw = bindings.api_raw(spark, d)
    target = silver.api_silver_projection(
        raw.where(F.col("ingested_at") < F.lit(_CUT).cast("timestamp_ntz")), "$.k")
    return inc.incremental_filter(raw, target, scope="global")


@register("incremental_api_silver", O.table("api_silver"))
def q_incremental_api_silver(spark, d):
    """First run builds the table in full, the second only merges rows
    beyond the high-water mark; the result equals a full rebuild."""
    raw = bindings.api_raw(spark, d)
    table = KeyedTable(spark, scratch_path(spark, "api-silver"), "event_id")
    for visible in (raw.where(F.col("ingested_at") < F.lit(_CUT).cast("timestamp_ntz")), raw):
        target = table.read() if table.exists() else None
        marks = api_ingest.marks_as_timestamps(table.marks()) if target is not None else {}
        new = inc.incremental_filter(visible, target, scope="per_stream", marks=marks)
        api_ingest.merge_into(table, silver.api_silver_projection(new, "$.k"), "event_id",
                              mark_col="ingested_at", mark_by="source_stream", mark_groups=api_ingest.STREAMS)
    return table.read()


_REDELIVERY_FROM = "2024-01-11 00:00:00"
_TARGET_UNTIL = "2024-01-21 00:00:00"
_REDELIVERY_STAMP = "2024-02-01 00:00:00"


@register("upsert_merge", O.with_ctes(f"""
    SELECT {_API_SILVER_COLS},
           CASE WHEN ingested_at >= TIMESTAMP '{_REDELIVERY_FROM}'
                THEN TIMESTAMP '{_REDELIVERY_STAMP}' ELSE ingested_at END AS ingested_at
    FROM api_silver"""))
def q_upsert_merge(spark, d):
    """A target holding rows loaded before 01-21 merged with a redelivery of
    every row from 01-11 on: overlapping keys are updated, new keys inserted."""
    full = _api_silver_full(spark, d)
    ts = F.col("ingested_at")
    target = full.where(ts < F.lit(_TARGET_UNTIL).cast("timestamp_ntz"))
    source = (full.where(ts >= F.lit(_REDELIVERY_FROM).cast("timestamp_ntz"))
              .withColumn("ingested_at", F.lit(_REDELIVERY_STAMP).cast("timestamp_ntz")))
    return inc.upsert(target, source, "event_id")


def _run1_watermarks(spark, d, streams):
    log = api_ingest.log_as_of(bindings.api_log(spark, d), _CUT)
    return inc.advance_cursors(spark, streams, log, api_ingest.STAMP_1)


_LOOKUP_SQL = """
    SELECT s.stream_name,
           'cursor_' || s.stream_name || '_' || CAST(w.last_pos AS VARCHAR) AS current_cursor,
           w.last_pos AS cursor_pos
    FROM (VALUES ('fraud'), ('audit'), ('access'), ('members'), ('sales')) s(stream_name)
    LEFT JOIN (SELECT * FROM run1_cursors WHERE stream_name IN ('fraud', 'audit')) w
           ON s.stream_name = w.stream_name"""


@register("watermark_lookup", O.with_ctes(_LOOKUP_SQL))
def q_watermark_lookup(spark, d):
    """C4: configured streams LEFT JOIN stored cursors; three have none yet."""
    wm = _run1_watermarks(spark, d, ["fraud", "audit"])
    return inc.watermark_lookup(spark, api_ingest.STREAMS, wm)


@register("incremental_extract", O.with_ctes(f"""
    SELECT l.stream_name, l.pos, l.event_id, l.stream_type, l.data, l.timestamp,
           CAST(floor((l.pos - COALESCE(c.cursor_pos, -1) - 1) / 1000) AS BIGINT) AS page
    FROM api_log l JOIN ({_LOOKUP_SQL}) c ON l.stream_name = c.stream_name
    WHERE c.cursor_pos IS NULL OR l.pos > c.cursor_pos"""))
def q_incremental_extract(spark, d):
    """K1: every stream's rows beyond its cursor, in one job."""
    wm = _run1_watermarks(spark, d, ["fraud", "audit"])
    cursors = inc.watermark_lookup(spark, api_ingest.STREAMS, wm)
    return (inc.extract_new(bindings.api_log(spark, d), cursors)
            .select("stream_name", "pos", "event_id", "stream_type", "data", "timestamp", "page"))


@register("cursor_parse", O.with_ctes("""
    SELECT stream_name, 'cursor_' || stream_name || '_' || CAST(pos AS VARCHAR) AS current_cursor,
           pos AS cursor_pos FROM api_log"""))
def q_cursor_parse(spark, d):
    """Cursor text for every log offset, parsed back to its position."""
    log = bindings.api_log(spark, d)
    cur = log.select("stream_name", format_cursor("stream_name", "pos").alias("current_cursor"))
    return cur.withColumn("cursor_pos", cursor_position("current_cursor"))


@register("watermark_advance", O.with_ctes(f"""
    SELECT stream_name, 'cursor_' || stream_name || '_' || CAST(max(pos) AS VARCHAR) AS current_cursor,
           TIMESTAMP '{api_ingest.STAMP_2}' AS updated_at
    FROM api_log GROUP BY stream_name"""))
def q_watermark_advance(spark, d):
    """D5 + C5 + A8: the cursor table after two ingestion runs."""
    t = api_ingest.two_runs(spark, d, scratch_path(spark, "api-cycle"))
    return t.watermarks(spark).read()


@register("api_cycle_two_runs", O.with_ctes(f"""
    SELECT s.{_API_SILVER_COLS.replace(', ', ', s.')},
           CASE WHEN l.pos <= c.last_pos THEN TIMESTAMP '{api_ingest.STAMP_1}'
                ELSE TIMESTAMP '{api_ingest.STAMP_2}' END AS ingested_at
    FROM api_silver s
    JOIN api_log l ON s.event_id = l.event_id
    LEFT JOIN run1_cursors c ON l.stream_name = c.stream_name"""))
def q_api_cycle_two_runs(spark, d):
    """Run the whole cycle twice; the second run only adds what is new."""
    t = api_ingest.two_runs(spark, d, scratch_path(spark, "api-cycle"))
    return t.silver(spark).read()


@register("api_crashing_runs", O.with_ctes(f"SELECT {_API_SILVER_COLS} FROM api_silver"))
def q_api_crashing_runs(spark, d):
    """K3 / K5: runs stopped at every commit point, retried with a grown log and other
    stamps, a backfill with an older stamp, finished runs started again: every row once."""
    t = api_ingest.crashing_runs(spark, d, scratch_path(spark, "api-crash"))
    return t.silver(spark).read().drop("ingested_at")


@register("api_crashing_runs_landing", O.with_ctes("""
    SELECT CASE WHEN event_ts < TIMESTAMP '2024-01-16 00:00:00' THEN '1' ELSE 'backfill' END AS run,
           stream_name AS source_stream, event_id, stream_type, data, timestamp FROM api_log"""))
def q_api_crashing_runs_landing(spark, d):
    """A3: landed files of the same scenario: every payload once, text unchanged, in the
    folder of the run that finished with it; starting a finished run again leaves them."""
    t = api_ingest.crashing_runs(spark, d, scratch_path(spark, "api-crash"))
    landed = tables.read_ndjson(spark, t.landing, T.StructType(
        [*api_ingest.LANDED.fields, T.StructField(tables.RUN_COL, T.StringType())]))
    return landed.select(F.col(tables.RUN_COL).alias("run"), "source_stream", "event_id", "stream_type", "data", "timestamp")


# ============================================================ files and tables
@register("seed_csv_load", O.table("raw_telemetry"))
def q_seed_csv_load(spark, d):
    """A1: raw telemetry written as a quoted CSV seed, loaded with declared types."""
    path = scratch_path(spark, "seed-csv")
    tables.write_csv_seed(bindings.raw_telemetry(spark, d), path)
    schema = with_key_type(RAW_TELEMETRY, T.LongType(), ("vessel_id", "location_id"))
    return tables.read_csv_typed(spark, path, schema)


_RAW_MIN = "ingested_at, source_stream, event_id, stream_type, data, timestamp"


@register("ndjson_land_scan", O.with_ctes(f"SELECT {_RAW_MIN} FROM api_raw"))
def q_ndjson_land_scan(spark, d):
    """A2: landed NDJSON (payload as a nested object) scanned with a declared schema."""
    path = scratch_path(spark, "ndjson")
    tables.write_landing(bindings.api_raw(spark, d), path, partition_cols=())
    return tables.read_ndjson(spark, path, API_RAW)


@register("landing_partitioned_write", O.with_ctes(
    f"SELECT {_RAW_MIN}, CAST(ingested_at AS DATE) AS dt FROM api_raw"))
def q_landing_partitioned_write(spark, d):
    """A3: NDJSON under source_stream=/dt= folders, 50,000 rows per file at most."""
    path = scratch_path(spark, "landing")
    raw = bindings.api_raw(spark, d).withColumn("dt", F.to_date("ingested_at"))
    tables.write_landing(raw, path)
    return tables.read_ndjson(spark, path, API_RAW)


@register("raw_append_load", O.with_ctes(
    f"SELECT {_RAW_MIN}, CAST(ingested_at AS DATE) AS _ingest_date FROM api_raw"))
def q_raw_append_load(spark, d):
    """A4: two landing runs appended to the raw table partitioned by ingest day."""
    root = scratch_path(spark, "raw-append")
    raw = bindings.api_raw(spark, d).withColumn("dt", F.to_date("ingested_at"))
    before = F.col("ingested_at") < F.lit(_CUT).cast("timestamp_ntz")
    for run_id, part in (("1", raw.where(before)), ("2", raw.where(~before))):
        land = f"{root}/landing/run_id={run_id}"
        tables.write_landing(part, land)
        landed = tables.read_ndjson(spark, land, API_RAW).select(*API_RAW.fieldNames())
        tables.append_raw(landed, f"{root}/raw", run_id=run_id)
    return spark.read.parquet(f"{root}/raw").drop(tables.RUN_COL)


@register("landing_quarantine", O.with_ctes("""
    SELECT CASE WHEN CAST(event_id AS BIGINT) % 11 IN (1, 2, 3) THEN 'rejected' ELSE 'loaded' END AS outcome,
           CASE WHEN CAST(event_id AS BIGINT) % 11 NOT IN (1, 2, 3) THEN event_id END AS event_id,
           CASE WHEN CAST(event_id AS BIGINT) % 11 NOT IN (1, 2, 3) THEN data END AS data FROM api_raw"""))
def q_landing_quarantine(spark, d):
    """A2 / A4: landed lines of which three in eleven were spoilt (cut off, a text for the time,
    no object at all) are set aside; the rest is loaded, and together they are all lines."""
    root = scratch_path(spark, "quarantine")
    way = F.col("event_id").cast("long") % 11
    spoilt = (F.when(way == 1, F.expr("left(value, length(value) - 3)"))
              .when(way == 2, F.expr("regexp_replace(value, '\"ingested_at\":\"[^\"]*\"', '\"ingested_at\":\"soon\"')"))
              .when(way == 3, F.concat(F.lit("["), F.col("event_id"), F.lit("]"))).otherwise(F.col("value")))
    raw = bindings.api_raw(spark, d).withColumn("event_key", F.col("event_id"))
    (tables.landing_lines(raw, ("event_key",)).withColumnRenamed("event_key", "event_id").select(spoilt.alias("value"))
     .write.text(f"{root}/landing"))
    found = tables.load_landed(spark, f"{root}/landing", API_RAW, API_RAW.fieldNames(), f"{root}/raw", f"{root}/rejects", "1",
                               max_rejected=1 << 62)
    loaded = spark.read.schema(API_RAW).parquet(f"{root}/raw").select(F.lit("loaded").alias("outcome"), "event_id", "data")
    if not found["rejected"]:
        return loaded
    none = F.lit(None).cast("string")
    return loaded.unionByName(spark.read.parquet(f"{root}/rejects").select(
        F.lit("rejected").alias("outcome"), none.alias("event_id"), none.alias("data")))


_RETENTION_AS_OF = "2024-01-20"


@register("retention_expire", O.with_ctes(
    f"SELECT {_RAW_MIN}, CAST(ingested_at AS DATE) AS dt FROM api_raw "
    f"WHERE CAST(ingested_at AS DATE) > DATE '{_RETENTION_AS_OF}' - INTERVAL 7 DAY"))
def q_retention_expire(spark, d):
    """Landing folders older than 7 days before the as-of date are dropped
    from a listing; what remains is read back."""
    path = scratch_path(spark, "retention")
    raw = bindings.api_raw(spark, d).withColumn("dt", F.to_date("ingested_at"))
    tables.write_landing(raw, path)
    tables.expire_partitions(spark, path, "dt", _RETENTION_AS_OF, keep_days=7)
    return tables.read_ndjson(spark, path, API_RAW)


@register("gold_partitioned_table", O.with_ctes(
    "SELECT *, CAST(observed_at AS DATE) AS observed_date FROM fact_unified"))
def q_gold_partitioned_table(spark, d):
    """A5: the fact rebuilt as a day-partitioned table clustered on its join keys."""
    path = scratch_path(spark, "gold-fact")
    write_clustered_table(medallion.fact_unified(spark, d), path, "observed_at", "observed_date",
                          ["location_id", "vessel_id", "vessel_type"], tiebreak=["event_id"])
    return spark.read.parquet(path)


_PROCESSED_AT = "2024-02-01 00:00:00"


@register("stream_silver_view", O.with_ctes(
    f"SELECT *, TIMESTAMP '{_PROCESSED_AT}' AS processed_at FROM stg_telemetry_stream"))
def q_stream_silver_view(spark, d):
    """The flow's lasting view over the streaming sink, with its six columns."""
    paths = SF.run_stream(spark, d, scratch_path(spark, "stream"), processed_at=_PROCESSED_AT)
    SS.publish_view(spark, paths, "stream_silver_view",
                    ["event_id", "vessel_id", "location_id", "gravity_g", "observed_at", "processed_at"], bindings.STREAM_RECORD)
    return spark.table("stream_silver_view")


# ================================================================ data quality


def _suite_of(model: str, kinds: tuple[str, ...]):
    spec = next(s for s in A.SUITE if s.model == model)
    return Q.ModelChecks(model, [c for c in spec.checks if c.kind in kinds])


@register("check_unique", O.with_ctes("""
    SELECT event_id, count(*) AS n_rows FROM fact_unified WHERE event_id IS NOT NULL
    GROUP BY event_id HAVING count(*) > 1"""))
def q_check_unique(spark, d):
    """D4 / J1 as declared upstream: unique(event_id) on the fact.  Every event
    arrives through both paths, so each id is reported (the true grain is the
    pair, which the audit checks)."""
    return Q.duplicate_keys(medallion.fact_unified(spark, d), "event_id")


_FACT_COLS = list(gold.FACT_COLUMNS)


@register("check_not_null", O.with_ctes("\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS null_rows "
    f"FROM fact_unified" for c in _FACT_COLS)))
def q_check_not_null(spark, d):
    """NULL counts of every fact column in one aggregate pass."""
    return Q.null_counts(medallion.fact_unified(spark, d), _FACT_COLS)


_BETWEEN_SUITE = [_suite_of("stg_telemetry_stream", ("between",)),
                  _suite_of("fct_events", ("between",))]


@register("check_between", O.suite_sql(_BETWEEN_SUITE))
def q_check_between(spark, d):
    """Inclusive range checks (NULL passes) on stream silver and the fact."""
    models = {"stg_telemetry_stream": bindings.stream_silver_table(spark, d, A.PROCESSED_AT),
              "fct_events": medallion.fact_unified(spark, d)}
    return Q.audit(models, _BETWEEN_SUITE)


_MIN_ROWS_SUITE = [_suite_of("dim_researchers", ("min_rows",))]


@register("check_min_rows", O.suite_sql(_MIN_ROWS_SUITE))
def q_check_min_rows(spark, d):
    """Minimum volume (>= 3 researchers)."""
    return Q.audit({"dim_researchers": medallion.dims(spark, d).researchers}, _MIN_ROWS_SUITE)


@register("check_null_keys", O.with_ctes("""
    SELECT count(*) AS total_rows,
           count(*) FILTER (WHERE vessel_id IS NULL) AS null_vessels,
           count(*) FILTER (WHERE location_id IS NULL) AS null_locations
    FROM fact_unified"""))
def q_check_null_keys(spark, d):
    """NULL join keys beside the total, in one aggregate."""
    f = medallion.fact_unified(spark, d)
    return f.agg(F.count(F.lit(1)).alias("total_rows"),
                 F.count_if(F.col("vessel_id").isNull()).alias("null_vessels"),
                 F.count_if(F.col("location_id").isNull()).alias("null_locations"))


_NON_NEG_SUITE = [_suite_of("dim_vessels", ("non_negative",))]


@register("check_non_negative", O.suite_sql(_NON_NEG_SUITE))
def q_check_non_negative(spark, d):
    """Vessel ages below zero."""
    return Q.audit({"dim_vessels": medallion.dims(spark, d).vessels}, _NON_NEG_SUITE)


@register("check_faults", O.with_ctes("""
    SELECT 'dim_vessels' AS model, 'age_days' AS column_name, 'non_negative' AS check_name,
           CAST(count(*) FILTER (WHERE date_diff('day', CAST(commissioned_at AS DATE), DATE '1992-02-01') < 0) AS BIGINT) AS observed,
           count(*) FILTER (WHERE date_diff('day', CAST(commissioned_at AS DATE), DATE '1992-02-01') < 0) = 0 AS passed
    FROM stg_vessels
    UNION ALL SELECT 'stg_telemetry', 'event_id', 'not_null',
           CAST(count(*) FILTER (WHERE event_id % 10 = 0) AS BIGINT), false FROM stg_telemetry
    UNION ALL SELECT 'stg_telemetry', 'event_id', 'unique',
           CAST(count(*) FILTER (WHERE event_id % 10 = 5) AS BIGINT), false FROM stg_telemetry"""))
def q_check_faults(spark, d):
    """D2 / D4 / D6 / J2 on faults made on purpose: ages as of a day before some vessels were
    commissioned, event ids nulled in every tenth row and delivered twice in another tenth."""
    ages = medallion.dims(spark, d, as_of="1992-02-01").vessels
    t = medallion.stg_telemetry(spark, d)
    t = t.unionByName(t.where(F.col("event_id") % 10 == 5)).withColumn(
        "event_id", F.when(F.col("event_id") % 10 != 0, F.col("event_id")))
    return Q.audit({"dim_vessels": ages, "stg_telemetry": t},
                   [_suite_of("dim_vessels", ("non_negative",)), _suite_of("stg_telemetry", ("not_null", "unique"))])


@register("quality_audit", O.suite_sql(A.SUITE))
def q_quality_audit(spark, d):
    """The whole declared suite, one pass per model."""
    return A.quality_audit(spark, d)


_STORED = [s for s in A.SUITE if s.model in ("dim_researchers", "fct_events", "dim_vessels", "dim_locations")]


@register("quality_audit_stored", O.suite_sql(_STORED))
def q_quality_audit_stored(spark, d):
    """The suite over stored gold tables, first without the fact's last days, then
    incrementally: the second audit reads the added days only."""
    root = scratch_path(spark, "stored-audit")
    g = medallion.build_gold(spark, d, dims_root=f"{root}/gold")
    tables.materialize_counted(g.fact.withColumn("observed_date", F.to_date("observed_at")), "fact", f"{root}/whole")
    whole = spark.read.parquet(f"{root}/whole")
    late = F.coalesce(F.col("observed_at") >= F.lit(_REDELIVERY_FROM).cast("timestamp_ntz"), F.lit(False))
    models = {n: StoredModel(f"{root}/gold/{n}", df.schema) for n, df in
              (("dim_researchers", g.dims.researchers), ("dim_vessels", g.dims.vessels), ("dim_locations", g.dims.locations))}
    models["fct_events"] = StoredModel(f"{root}/fact", whole.schema, "observed_date")
    history = AuditHistory(spark, f"{root}/history")
    for part in (whole.where(~late), whole.where(late)):
        part.write.mode("append").partitionBy("observed_date").parquet(f"{root}/fact")
        done = history.run(models, _STORED)
    return done.results


# =================================================================== streaming

_SILVER_CORE = "SELECT event_id, vessel_id, location_id, gravity_g, observed_at FROM stg_telemetry_stream"


@register("stream_bronze_ingest", O.table("stream_records"))
def q_stream_bronze_ingest(spark, d):
    """A10 + I1: the topic read from the beginning into typed bronze rows."""
    paths = SF.run_stream(spark, d, scratch_path(spark, "stream"))
    return SS.read_bronze(spark, paths, bindings.STREAM_RECORD).select(*bindings.STREAM_RECORD.fieldNames())


@register("stream_contract_valid", O.with_ctes("""
    SELECT * FROM stream_records
    WHERE id IS NOT NULL AND vessel_id IS NOT NULL AND raw_force_reading IS NOT NULL
      AND location_id IS NOT NULL AND event_time IS NOT NULL
      AND TRY_CAST(event_time AS TIMESTAMPTZ) IS NOT NULL"""))
def q_stream_contract_valid(spark, d):
    """The contract applied to every topic message (batch form of the same parser)."""
    parsed = SB.parse_contract(bindings.stream_messages(spark, d), bindings.STREAM_RECORD)
    return SB.valid_records(parsed, bindings.STREAM_RECORD)


@register("stream_dead_letter", O.with_ctes("""
    SELECT CAST(to_json(struct_pack(id, vessel_id, raw_force_reading, location_id, event_time)) AS VARCHAR) AS value,
           'rejected' AS reject_reason
    FROM stream_records
    WHERE id IS NULL OR vessel_id IS NULL OR raw_force_reading IS NULL
       OR location_id IS NULL OR event_time IS NULL
       OR TRY_CAST(event_time AS TIMESTAMPTZ) IS NULL"""))
def q_stream_dead_letter(spark, d):
    """Messages the streaming query routed to the dead-letter table
    (none on well-formed input; see tests for the rejected shapes)."""
    paths = SF.run_stream(spark, d, scratch_path(spark, "stream"))
    dl = SS.read_dead_letters(spark, paths)
    return dl.select("value", F.lit("rejected").alias("reject_reason"))


@register("stream_reject_reasons", O.with_ctes("""
    SELECT CASE id % 7 WHEN 0 THEN 'missing_or_mistyped:location_id'
                       WHEN 1 THEN 'missing_or_mistyped:raw_force_reading'
                       WHEN 2 THEN 'bad_event_time' WHEN 3 THEN 'malformed' ELSE 'silver' END AS outcome,
           count(*) AS messages, CAST(sum(CASE WHEN id % 7 > 3 THEN id END) AS BIGINT) AS sum_of_ids
    FROM stream_records GROUP BY 1"""))
def q_stream_reject_reasons(spark, d):
    """I2 / I3 on messages of which four in seven break the contract: each reason's
    dead letters counted, the rest in silver."""
    paths = SF.run_faulty(spark, d, scratch_path(spark, "stream-faulty"))
    dead = SS.read_dead_letters(spark, paths).select(F.col("reject_reason").alias("outcome"), F.lit(None).cast("long").alias("id"))
    good = SS.read_silver(spark, paths, bindings.STREAM_RECORD).select(F.lit("silver").alias("outcome"), F.col("event_id").alias("id"))
    return dead.unionByName(good).groupBy("outcome").agg(
        F.count("*").alias("messages"), F.sum("id").alias("sum_of_ids"))


@register("stream_silver", O.with_ctes(_SILVER_CORE))
def q_stream_silver(spark, d):
    """The continuous transform run to completion; silver without the
    processing stamp."""
    paths = SF.run_stream(spark, d, scratch_path(spark, "stream"))
    return SF.silver_core(SS.read_silver(spark, paths, bindings.STREAM_RECORD))


@register("stream_silver_partitions", O.with_ctes(
    "SELECT event_id, observed_at, CAST(observed_at AS DATE) AS observed_date FROM stg_telemetry_stream"))
def q_stream_silver_partitions(spark, d):
    """Silver is partitioned by event day; the day column comes from the folders."""
    paths = SF.run_stream(spark, d, scratch_path(spark, "stream"))
    return (SS.read_silver(spark, paths, bindings.STREAM_RECORD)
            .select("event_id", "observed_at", "observed_date"))


@register("stream_restart_once", O.with_ctes(_SILVER_CORE))
def q_stream_restart_once(spark, d):
    """Two deliveries and a late one, restarts from the checkpoint and an idle run: every
    message lands in silver exactly once."""
    paths = SF.run_with_restart(spark, d, scratch_path(spark, "stream-restart"))
    return SF.silver_core(SS.read_silver(spark, paths, bindings.STREAM_RECORD))


@register("stream_new_checkpoint", O.with_ctes(_SILVER_CORE))
def q_stream_new_checkpoint(spark, d):
    """A second query with a checkpoint of its own on the same sink adds its rows
    and replaces none of the first query's."""
    paths = SF.run_with_new_checkpoint(spark, d, scratch_path(spark, "stream-two"))
    return SF.silver_core(SS.read_silver(spark, paths, bindings.STREAM_RECORD))


@register("stream_compaction", O.with_ctes(f"""
    SELECT p.phase, s.* FROM ({_SILVER_CORE}) s
    CROSS JOIN (VALUES ('before'), ('compacted'), ('replayed'), ('cleaned')) p(phase)"""))
def q_stream_compaction(spark, d):
    """The sink's rows before its batch folders are merged, after it, after the replay of
    a merged batch, and without the replaced folders: the same rows each time."""
    return SF.run_compacted(spark, d, scratch_path(spark, "stream-compact"))


@register("stream_delivery_attempts", O.with_ctes("""
    SELECT CASE WHEN id % 7 IN (0, 4, 5, 6) THEN 'silver'
                WHEN id % 7 = 1 THEN 'missing_or_mistyped:raw_force_reading'
                WHEN id % 7 = 2 THEN 'bad_event_time' ELSE 'malformed' END AS outcome,
           CASE WHEN id % 7 IN (1, 2, 3) THEN 5 END AS attempts,
           count(*) AS messages, CAST(sum(CASE WHEN id % 7 IN (0, 4, 5, 6) THEN id END) AS BIGINT) AS sum_of_ids
    FROM stream_records GROUP BY 1, 2"""))
def q_stream_delivery_attempts(spark, d):
    """Rejected records are tried again; a mended contract rescues those without a
    location, the rest is given up after five attempts, and nothing stays pending."""
    paths = SF.run_redelivery(spark, d, scratch_path(spark, "stream-redelivery"))
    none = F.lit(None).cast("long").alias("id")
    dead = SD.read_undeliverable(spark, paths).select(F.col("reject_reason").alias("outcome"), "attempts", none)
    left = SD.pending(spark, paths).select(F.lit("pending").alias("outcome"), "attempts", none)
    good = SS.read_silver(spark, paths, bindings.STREAM_RECORD).select(
        F.lit("silver").alias("outcome"), F.lit(None).cast("int").alias("attempts"), F.col("event_id").alias("id"))
    return (dead.unionByName(left).unionByName(good).groupBy("outcome", "attempts")
            .agg(F.count("*").alias("messages"), F.sum("id").alias("sum_of_ids")))


@register("feed_append_stream", O.with_ctes(f"SELECT {_API_SILVER_COLS} FROM api_silver"))
def q_feed_append_stream(spark, d):
    """The append feed of a stored table: two commits streamed, a third one after a
    restart from the checkpoint, an idle run; the sink has every row once."""
    root = scratch_path(spark, "feed")
    table = tables.VersionedTable(spark, f"{root}/table")
    full = _api_silver_full(spark, d).select(*_API_SILVER_COLS.split(", "))
    third = F.col("event_id").cast("long") % 3
    for part in range(3):
        table.append(full.where(third == part))
        if part:
            feed.copy_available(spark, table.path, f"{root}/sink", f"{root}/_checkpoint")
    feed.copy_available(spark, table.path, f"{root}/sink", f"{root}/_checkpoint")
    return spark.read.schema(full.schema).parquet(f"{root}/sink")


@register("fact_stream_sink", O.table("fact_unified"))
def q_fact_stream_sink(spark, d):
    """Batch gold over the streaming sink (Lambda-style unification)."""
    paths = SF.run_stream(spark, d, scratch_path(spark, "stream"))
    sink = SS.read_silver(spark, paths, bindings.STREAM_RECORD)
    return medallion.fact_unified(spark, d, stream_silver=sink)


@register("fact_literal_fanout", O.table("fact_unified"))
def q_fact_literal_fanout(spark, d):
    """E1 in its literal form: the fan-out join to every researcher of the
    vessel, then the top-1 per (event_id, ingestion_mode).  Same rows as the
    lead-first plan of ``fact_unified``; kept as the cross-check of R1."""
    g = medallion.build_gold(spark, d, lead_first=False)
    return g.fact
