"""Domain tables derived from the driver's TPC-H-style parquet.

Every binding is a lazy DataFrame over the *whole* input table; Catalyst
prunes the columns each query needs down to the parquet scan.  Keys stay
integers (equi-joins behave the same as with the domain's string keys).

Mapping (fixed values of the test binding):
  raw_telemetry   <- events: id=event_id, vessel_id=user_id,
                     raw_force_reading=value % 19 (0 to 1.94 g), location_id=event_id % 30,
                     event_time=ts
  stream records  <- events, same columns, event_time as ISO-8601 text with Z
  raw_vessels     <- supplier + first l_shipdate per supplier:
                     vessel_type = 'T' || s_nationkey % 5
  raw_locations   <- nation + region: facility_type = 'F' || n_nationkey % 4
  raw_researchers <- customer + first o_orderdate per customer:
                     name split on '#', email = upper(c_name) || '@X.ORG',
                     assigned_vessel_id = 4 * c_custkey div 50 (four vessels in five have
                     researchers, 12 or 13 each, at every scale)
  API log         <- all events, their five types error / view / click / signup / purchase
                     as streams fraud / audit / access / members / sales; pos = event_id
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pyspark.sql import types as T

from tessera.functions.temporal import epoch_seconds, iso_utc_text
from tessera.operators.silver import to_g
from tessera.schemas import stream_record_schema

LOCATION_BUCKETS = 30
VESSEL_TYPE_BUCKETS = 5
FACILITY_BUCKETS = 4
READING_RANGE = 19.0

# Event type -> API stream name.
API_STREAMS = {"error": "fraud", "view": "audit", "click": "access", "signup": "members",
               "purchase": "sales"}
# The topic contract with this binding's integer keys.
STREAM_RECORD = stream_record_schema(T.LongType())
# Fixed value: the reporting date used for ages and tenures.
AS_OF = "2026-04-01"


# Declared schemas of the input tables (no footer sampling on every read).
SOURCE_SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": ("c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, "
                 "c_mktsegment STRING"),
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "orders": ("o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
               "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"),
    "lineitem": ("l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
                 "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
                 "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ"),
    "events": ("event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
               "value DOUBLE, props STRING"),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in SOURCE_SCHEMAS:
        reader = reader.schema(SOURCE_SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _mod_tag(prefix: str, c: Column, n: int) -> Column:
    return F.concat(F.lit(prefix), (c % n).cast("string"))


def raw_telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("event_id").alias("id"),
        F.col("user_id").alias("vessel_id"),
        (F.col("value") % READING_RANGE).alias("raw_force_reading"),
        (F.col("event_id") % LOCATION_BUCKETS).alias("location_id"),
        F.col("ts").alias("event_time"),
    )


def stream_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The topic's records (typed, before JSON encoding): every event again."""
    return stream_records_from(raw_telemetry(spark, sf_dir))


def stream_records_from(raw: DataFrame) -> DataFrame:
    return raw.withColumn("event_time", iso_utc_text("event_time"))


def stream_silver_table(spark: SparkSession, sf_dir: str, processed_at=None) -> DataFrame:
    """Stream silver as the streaming sink holds it: typed rows, one per topic
    record.  Gold reads this table; it never re-parses the topic's text."""
    raw = raw_telemetry(spark, sf_dir)
    stamp = F.lit(processed_at).cast("timestamp_ntz") if processed_at is not None \
        else F.current_timestamp().cast("timestamp_ntz")
    return raw.select(
        F.col("id").alias("event_id"), "vessel_id", "location_id",
        to_g("raw_force_reading").alias("gravity_g"),
        F.col("event_time").alias("observed_at"), stamp.alias("processed_at"))


def stream_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The topic's payloads: one JSON text per record, in a ``value`` column."""
    rec = stream_records(spark, sf_dir)
    return rec.select(F.to_json(F.struct(*rec.columns)).alias("value"))


def raw_vessels(spark: SparkSession, sf_dir: str) -> DataFrame:
    first_ship = (table(spark, sf_dir, "lineitem")
                  .groupBy("l_suppkey")
                  .agg(F.min("l_shipdate").alias("commissioned_at")))
    s = table(spark, sf_dir, "supplier")
    return (s.join(first_ship, s.s_suppkey == first_ship.l_suppkey, "left")
            .select(F.col("s_suppkey").alias("vessel_id"),
                    F.col("s_name").alias("vessel_name"),
                    _mod_tag("T", F.col("s_nationkey"), VESSEL_TYPE_BUCKETS).alias("vessel_type"),
                    F.col("commissioned_at")))


def raw_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return (n.join(r, n.n_regionkey == r.r_regionkey, "left")
            .select(F.col("n_nationkey").alias("location_id"),
                    F.col("n_name").alias("location_name"),
                    F.col("r_name").alias("region"),
                    _mod_tag("F", F.col("n_nationkey"), FACILITY_BUCKETS).alias("facility_type")))


def raw_researchers(spark: SparkSession, sf_dir: str) -> DataFrame:
    first_order = (table(spark, sf_dir, "orders")
                   .groupBy("o_custkey")
                   .agg(F.min("o_orderdate").alias("joined_at")))
    c = table(spark, sf_dir, "customer")
    return (c.join(first_order, c.c_custkey == first_order.o_custkey, "left")
            .select(F.col("c_custkey").alias("researcher_id"),
                    F.split_part(F.col("c_name"), F.lit("#"), F.lit(1)).alias("first_name"),
                    F.split_part(F.col("c_name"), F.lit("#"), F.lit(2)).alias("last_name"),
                    F.concat(F.upper("c_name"), F.lit("@X.ORG")).alias("email"),
                    F.col("c_mktsegment").alias("specialization"),
                    F.expr("4 * c_custkey div 50").alias("assigned_vessel_id"),
                    F.col("joined_at")))


def _stream_name(event_type: Column) -> Column:
    expr = None
    for etype, stream in API_STREAMS.items():
        expr = (F.when(event_type == etype, F.lit(stream)) if expr is None
                else expr.when(event_type == etype, F.lit(stream)))
    return expr


def api_log(spark: SparkSession, sf_dir: str, streams: list[str] | None = None) -> DataFrame:
    """The vendor API's event log: every event of a mapped type, tagged with its
    stream and its monotonic offset ``pos`` within the stream.  ``streams``
    restricts the log to some streams with a predicate on the stored event
    type, which the parquet scan receives."""
    types = [t for t, s_ in API_STREAMS.items() if streams is None or s_ in streams]
    ev = table(spark, sf_dir, "events").where(F.col("event_type").isin(*types))
    return ev.select(
        _stream_name(F.col("event_type")).alias("stream_name"),
        F.col("event_id").alias("pos"),
        F.col("event_id").cast("string").alias("event_id"),
        F.col("event_type").alias("stream_type"),
        F.col("props").alias("data"),
        epoch_seconds("ts").alias("timestamp"),
        F.col("ts").alias("event_ts"),
    )


def api_raw(spark: SparkSession, sf_dir: str, streams: list[str] | None = None) -> DataFrame:
    """Raw API landing rows as loaded: ingestion stamp = day of the event."""
    log = api_log(spark, sf_dir, streams)
    return log.select(
        F.date_trunc("day", F.col("event_ts")).cast("timestamp_ntz").alias("ingested_at"),
        F.col("stream_name").alias("source_stream"),
        "event_id", "stream_type", "data", "timestamp",
    )
