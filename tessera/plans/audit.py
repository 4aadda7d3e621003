"""Hourly audit (P5): the declared check suite over every model."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.operators import silver
from tessera.operators.audit_history import AuditHistory, AuditRun, StoredModel
from tessera.operators.quality import Check, ModelChecks, audit
from tessera.plans import medallion
from tessera.sources import bindings
from tessera.plans.api_ingest import ApiTables
from tessera.sources.tables import Releases
from tessera.streaming.silver import DAY_COL, StreamPaths, read_silver, silver_schema
from tessera.streaming.sink import visible

# The declared suite.  The fact's grain is (event_id, ingestion_mode), so its
# uniqueness is checked on the pair; researcher_id may be NULL after the LEFT
# JOIN, so that check only warns.
SUITE: list[ModelChecks] = [
    ModelChecks("stg_telemetry", [Check("unique", "event_id"), Check("not_null", "event_id")]),
    ModelChecks("stg_researchers", [Check("unique", "researcher_id"),
                                    Check("not_null", "researcher_id")]),
    ModelChecks("stg_vessels", [Check("unique", "vessel_id"), Check("not_null", "vessel_id")]),
    ModelChecks("stg_locations", [Check("unique", "location_id"),
                                  Check("not_null", "location_id")]),
    ModelChecks("stg_telemetry_stream", [
        Check("not_null", "event_id"), Check("not_null", "vessel_id"),
        Check("not_null", "location_id"), Check("not_null", "gravity_g"),
        Check("between", "gravity_g", low=-2, high=10),
        Check("not_null", "observed_at"), Check("not_null", "processed_at")]),
    ModelChecks("stg_api_telemetry", [Check("unique", "event_id"), Check("not_null", "event_id")]),
    ModelChecks("dim_researchers", [Check("unique", "researcher_id"),
                                    Check("not_null", "researcher_id"),
                                    Check("min_rows", min_rows=3)]),
    ModelChecks("fct_events", [
        Check("unique", ("event_id", "ingestion_mode")), Check("not_null", "event_id"),
        Check("not_null", "vessel_id"), Check("not_null", "location_id"),
        Check("not_null", "researcher_id", severity="warn"),
        Check("between", "gravity_g", low=-1, high=2)]),
    ModelChecks("dim_vessels", [Check("unique", "vessel_id"), Check("not_null", "vessel_id"),
                                Check("non_negative", "age_days")]),
    ModelChecks("dim_locations", [Check("unique", "location_id"),
                                  Check("not_null", "location_id")]),
]

PROCESSED_AT = "2024-02-01 00:00:00"


_STG_RESEARCHERS = ["researcher_id", "first_name", "last_name", "email", "specialization",
                    "assigned_vessel_id", "joined_at"]
_STG_VESSELS = ["vessel_id", "vessel_name", "vessel_type", "commissioned_at"]


def models(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Every audited model.  The gold ones come from one build (dimensions
    written once, the fact over them); each dimension is its silver model plus
    derived columns, so the silver researcher / vessel / location models are
    checked as projections of the stored dimensions instead of aggregating
    orders and lineitem again."""
    g = medallion.build_gold(spark, sf_dir)
    d = g.dims
    return {
        "stg_telemetry": medallion.stg_telemetry(spark, sf_dir),
        "stg_researchers": d.researchers.select(*_STG_RESEARCHERS),
        "stg_vessels": d.vessels.select(*_STG_VESSELS),
        "stg_locations": silver.stg_locations(d.locations),
        # the stream silver *table* (typed rows as the sink holds them)
        "stg_telemetry_stream": bindings.stream_silver_table(spark, sf_dir, PROCESSED_AT),
        "stg_api_telemetry": silver.api_silver_projection(bindings.api_raw(spark, sf_dir), "$.k"),
        "dim_researchers": d.researchers,
        "fct_events": g.fact,
        "dim_vessels": d.vessels,
        "dim_locations": d.locations,
    }


def stored_models(spark: SparkSession, gold_root: str, api_root: str | None = None,
                  stream_root: str | None = None, record=bindings.STREAM_RECORD) -> dict[str, DataFrame]:
    """The audited models as they are stored: the live gold release, the API
    silver table and the stream sink.  Nothing is rebuilt."""
    found = {name: spark.read.parquet(path) for name, path in Releases(spark, gold_root).paths().items()}
    if api_root is not None:
        found["stg_api_telemetry"] = ApiTables(api_root.rstrip("/")).silver(spark).read()
    if stream_root is not None:
        found["stg_telemetry_stream"] = read_silver(spark, StreamPaths(stream_root.rstrip("/")), record)
    return found


def stored_audit(spark: SparkSession, gold_root: str, api_root: str | None = None,
                 stream_root: str | None = None, history: str | None = None) -> DataFrame:
    """The declared suite over the stored models (those that are given).  With ``history`` (a
    folder) only days and tables that changed since the last audit are read."""
    if history is not None:
        return incremental_audit(spark, history, gold_root, stream_root).results
    found = stored_models(spark, gold_root, api_root, stream_root)
    return audit(found, [s for s in SUITE if s.model in found])


def incremental_audit(spark: SparkSession, history: str, gold_root: str, stream_root: str | None = None,
                      record=bindings.STREAM_RECORD) -> AuditRun:
    """The suite over the live gold release and the stream sink, against the audit history."""
    paths = Releases(spark, gold_root).paths()
    found = {name: StoredModel(path, spark.read.parquet(path).schema, "observed_date" if name == "fct_events" else None)
             for name, path in paths.items()}
    if stream_root is not None:
        sink = StreamPaths(stream_root.rstrip("/"))
        found["stg_telemetry_stream"] = StoredModel(sink.silver, silver_schema(record), DAY_COL,
                                                    visible(spark, sink.root, sink.silver, DAY_COL))
    return AuditHistory(spark, history).run(found, SUITE)


def quality_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(models(spark, sf_dir), SUITE)
