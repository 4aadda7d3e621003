"""Silver models: cleaned, typed projections of one raw source each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.json import json_scalar
from tessera.functions.temporal import parse_iso_timestamp, seconds_to_timestamp, to_ntz
from tessera.functions.text import title_case

# Fixed value: standard gravity in m/s^2.
STANDARD_GRAVITY = 9.80665


def _ts(df: DataFrame, name: str):
    return to_ntz(F.col(name), df.schema[name].dataType)


def to_g(force) -> F.Column:
    """Local force reading -> multiples of standard gravity (double division)."""
    return F.col(force).cast("double") / F.lit(STANDARD_GRAVITY)


def stg_telemetry(raw: DataFrame) -> DataFrame:
    """B1: rename, convert force to g, type the event time."""
    return raw.select(
        F.col("id").alias("event_id"),
        "vessel_id",
        "location_id",
        to_g("raw_force_reading").alias("gravity_g"),
        _ts(raw, "event_time").alias("observed_at"),
    )


def stg_telemetry_stream(records: DataFrame, processed_at=None) -> DataFrame:
    """I4: the same conversion over validated stream records (batch or streaming).

    ``event_time`` is ISO text; ``processed_at`` is the micro-batch stamp
    (``current_timestamp()`` unless injected).
    """
    stamp = processed_at if processed_at is not None else F.current_timestamp()
    if not isinstance(stamp, F.Column):
        stamp = F.lit(stamp)
    return records.select(
        F.col("id").alias("event_id"),
        "vessel_id",
        "location_id",
        to_g("raw_force_reading").alias("gravity_g"),
        parse_iso_timestamp("event_time").alias("observed_at"),
        stamp.cast("timestamp_ntz").alias("processed_at"),
    )


def stg_locations(raw: DataFrame) -> DataFrame:
    """B2: column subset."""
    return raw.select("location_id", "location_name", "region", "facility_type")


def stg_vessels(raw: DataFrame) -> DataFrame:
    """Typed projection."""
    return raw.select("vessel_id", "vessel_name", "vessel_type",
                      _ts(raw, "commissioned_at").alias("commissioned_at"))


def stg_researchers(raw: DataFrame, titlecase: bool = True) -> DataFrame:
    """Title-case names (primary warehouse target only), lower-case email."""
    first = title_case("first_name") if titlecase else F.col("first_name")
    last = title_case("last_name") if titlecase else F.col("last_name")
    return raw.select(
        "researcher_id",
        first.alias("first_name"),
        last.alias("last_name"),
        F.lower("email").alias("email"),
        "specialization",
        "assigned_vessel_id",
        _ts(raw, "joined_at").alias("joined_at"),
    )


def tag_stream(df: DataFrame, stream_name: str, column: str = "source_stream") -> DataFrame:
    """Constant provenance tag on every row of one branch."""
    return df.withColumn(column, F.lit(stream_name))


def union_tagged(branches: dict[str, DataFrame], column: str = "source_stream") -> DataFrame:
    """G1: UNION ALL by column name, each branch tagged with its key."""
    out = None
    for name, df in branches.items():
        tagged = tag_stream(df, name, column)
        out = tagged if out is None else out.unionByName(tagged)
    if out is None:
        raise ValueError("union_tagged needs at least one branch")
    return out


def api_silver_projection(raw: DataFrame, value_path: str = "$.value",
                          message_path: str = "$.message") -> DataFrame:
    """K5 projection: flatten the JSON payload, type the event time.

    ``raw`` carries ``source_stream`` (one DataFrame for all streams, the
    stream being a column rather than a separate table per stream).
    """
    return raw.select(
        "event_id",
        "stream_type",
        "source_stream",
        json_scalar("data", value_path).alias("measure_value"),
        json_scalar("data", message_path).alias("event_message"),
        seconds_to_timestamp("timestamp").alias("observed_at"),
        F.col("ingested_at").cast("timestamp_ntz").alias("ingested_at"),
    )
