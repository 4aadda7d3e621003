"""Declared schemas.  Nothing in the library infers a schema from data."""

from __future__ import annotations

from pyspark.sql import types as T

# --- domain schemas (string keys, as declared by the source system) --------
RAW_TELEMETRY = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("vessel_id", T.StringType()),
    T.StructField("raw_force_reading", T.DoubleType()),
    T.StructField("location_id", T.StringType()),
    T.StructField("event_time", T.TimestampNTZType()),
])

RAW_VESSELS = T.StructType([
    T.StructField("vessel_id", T.StringType()),
    T.StructField("vessel_name", T.StringType()),
    T.StructField("vessel_type", T.StringType()),
    T.StructField("commissioned_at", T.TimestampNTZType()),
])

RAW_LOCATIONS = T.StructType([
    T.StructField("location_id", T.StringType()),
    T.StructField("location_name", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("facility_type", T.StringType()),
])

RAW_RESEARCHERS = T.StructType([
    T.StructField("researcher_id", T.LongType()),
    T.StructField("first_name", T.StringType()),
    T.StructField("last_name", T.StringType()),
    T.StructField("email", T.StringType()),
    T.StructField("specialization", T.StringType()),
    T.StructField("assigned_vessel_id", T.StringType()),
    T.StructField("joined_at", T.TimestampNTZType()),
])

# Topic message contract: five required fields, event time as ISO-8601 text.
STREAM_RECORD = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("vessel_id", T.StringType(), False),
    T.StructField("raw_force_reading", T.DoubleType(), False),
    T.StructField("location_id", T.StringType(), False),
    T.StructField("event_time", T.StringType(), False),
])

# Raw API landing row; ``data`` keeps the JSON object as text.
API_RAW = T.StructType([
    T.StructField("ingested_at", T.TimestampNTZType()),
    T.StructField("source_stream", T.StringType()),
    T.StructField("event_id", T.StringType()),
    T.StructField("stream_type", T.StringType()),
    T.StructField("data", T.StringType()),
    T.StructField("timestamp", T.DoubleType()),
])

WATERMARKS = T.StructType([
    T.StructField("stream_name", T.StringType(), False),
    T.StructField("current_cursor", T.StringType()),
    T.StructField("updated_at", T.TimestampNTZType(), False),
])

# The five columns both silvers must share for the batch/stream union.
CORE_TELEMETRY_COLUMNS = ("event_id", "vessel_id", "location_id", "gravity_g", "observed_at")


def with_key_type(schema: T.StructType, key_type: T.DataType,
                  keys: tuple[str, ...]) -> T.StructType:
    """Copy of ``schema`` with the named key columns retyped (bindings use integer keys)."""
    return T.StructType([
        T.StructField(f.name, key_type if f.name in keys else f.dataType, f.nullable)
        for f in schema.fields
    ])


def stream_record_schema(key_type: T.DataType = T.StringType()) -> T.StructType:
    return with_key_type(STREAM_RECORD, key_type, ("vessel_id", "location_id"))
