"""Gold star schema: three dimensions and the unified event fact."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.temporal import days_between
from tessera.functions.text import full_name
from tessera.operators.sizing import DEFAULT_BROADCAST_MAX_ROWS, broadcast_if_bounded
from tessera.schemas import CORE_TELEMETRY_COLUMNS

LOW_G_THRESHOLD = 0.1  # fixed value: at or below this many g an event is flagged

FACT_COLUMNS = (
    "event_id", "vessel_id", "location_id", "gravity_g", "observed_at", "ingestion_mode",
    "vessel_name", "vessel_type", "vessel_age_days", "location_name", "region",
    "researcher_id", "lead_researcher", "specialization", "is_low_g",
)


# ---------------------------------------------------------------- dimensions
def dim_locations(stg_locations: DataFrame) -> DataFrame:
    return stg_locations.select("location_id", "location_name", "region", "facility_type")


def dim_vessels(stg_vessels: DataFrame, as_of: _dt.date | str) -> DataFrame:
    return stg_vessels.select("vessel_id", "vessel_name", "vessel_type", "commissioned_at",
                              days_between(as_of, "commissioned_at").alias("age_days"))


def dim_researchers(stg_researchers: DataFrame, as_of: _dt.date | str) -> DataFrame:
    return stg_researchers.select(
        "researcher_id", "first_name", "last_name", "email", "specialization",
        "assigned_vessel_id", "joined_at",
        full_name("first_name", "last_name").alias("full_name"),
        days_between(as_of, "joined_at").alias("tenure_days"),
    )


# -------------------------------------------------------------- flag / union
def low_g_flag(gravity) -> F.Column:
    """``gravity <= 0.1``, NULL counted as FALSE."""
    g = F.col(gravity) if isinstance(gravity, str) else gravity
    return F.coalesce(g <= F.lit(LOW_G_THRESHOLD), F.lit(False))


def check_union_compatible(left: DataFrame, right: DataFrame,
                           columns=CORE_TELEMETRY_COLUMNS) -> None:
    """Both inputs must carry the core columns with equal types."""
    problems = []
    for c in columns:
        lt = left.schema[c].dataType if c in left.columns else None
        rt = right.schema[c].dataType if c in right.columns else None
        if lt is None or rt is None:
            problems.append(f"{c}: missing on {'left' if lt is None else 'right'}")
        elif lt != rt:
            problems.append(f"{c}: {lt.simpleString()} vs {rt.simpleString()}")
    if problems:
        raise ValueError("batch and stream silver are not union compatible: " + "; ".join(problems))


def unified_telemetry(batch: DataFrame, stream: DataFrame | None = None) -> DataFrame:
    """Batch silver, plus stream silver when given, tagged by mode."""
    core = list(CORE_TELEMETRY_COLUMNS)
    out = batch.select(*core, F.lit("batch").alias("ingestion_mode"))
    if stream is not None:
        check_union_compatible(batch, stream)
        out = out.unionByName(stream.select(*core, F.lit("stream").alias("ingestion_mode")))
    return out


# ---------------------------------------------------------------- top-1 rule
def _lead_order(tenure: str = "tenure_days", rid: str = "researcher_id"):
    """Most tenured first, NULL tenure last; ties to the smallest researcher id."""
    return [F.col(tenure).desc_nulls_last(), F.col(rid).asc_nulls_last()]


def top1(df: DataFrame, partition_cols, order_cols) -> DataFrame:
    """One row per partition by ``row_number() = 1``.

    Written as a filter on ``row_number`` so Catalyst infers a
    ``WindowGroupLimit``: each map task already keeps only its best row per
    group before the shuffle, so a hot group costs one row per task, not all
    of its rows in one task.
    """
    w = Window.partitionBy(*partition_cols).orderBy(*order_cols)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def lead_researchers(researchers: DataFrame) -> DataFrame:
    """The lead (most tenured) researcher of every vessel, one row per vessel."""
    r = researchers.select("assigned_vessel_id", "researcher_id", "full_name",
                           "specialization", "tenure_days")
    return top1(r, ["assigned_vessel_id"], _lead_order())


# ---------------------------------------------------------------------- fact
def enrich(telemetry: DataFrame, vessels: DataFrame, locations: DataFrame,
           researchers: DataFrame, broadcast_max_rows: int | None = DEFAULT_BROADCAST_MAX_ROWS,
           ) -> DataFrame:
    """LEFT joins of events to the three dimensions.

    ``researchers`` may be the full dimension (fan-out, C3 literal form) or the
    one-per-vessel leads (R1).  Each dimension is broadcast only when its row
    count is proven under ``broadcast_max_rows``.
    """
    v = broadcast_if_bounded(vessels.select(
        "vessel_id", "vessel_name", "vessel_type", F.col("age_days").alias("vessel_age_days")),
        broadcast_max_rows)
    lo = broadcast_if_bounded(locations.select("location_id", "location_name", "region"),
                              broadcast_max_rows)
    r = broadcast_if_bounded(researchers.select(
        "assigned_vessel_id", "researcher_id", F.col("full_name").alias("lead_researcher"),
        "specialization", "tenure_days"), broadcast_max_rows)
    return (telemetry
            .join(v, "vessel_id", "left")
            .join(lo, "location_id", "left")
            .join(r, telemetry.vessel_id == r.assigned_vessel_id, "left")
            .drop("assigned_vessel_id"))


def describe(narrow: DataFrame, vessels: DataFrame, locations: DataFrame, researchers: DataFrame,
             broadcast_max_rows: int | None = DEFAULT_BROADCAST_MAX_ROWS) -> DataFrame:
    """Descriptive columns of the three dimensions, joined by their unique keys."""
    v = broadcast_if_bounded(vessels.select(
        "vessel_id", "vessel_name", "vessel_type", F.col("age_days").alias("vessel_age_days")),
        broadcast_max_rows)
    lo = broadcast_if_bounded(locations.select("location_id", "location_name", "region"), broadcast_max_rows)
    who = broadcast_if_bounded(researchers.select(
        "researcher_id", F.col("full_name").alias("lead_researcher"), "specialization"), broadcast_max_rows)
    return (narrow.join(v, "vessel_id", "left").join(lo, "location_id", "left")
            .join(who, "researcher_id", "left"))


def fact_events(telemetry: DataFrame, vessels: DataFrame, locations: DataFrame,
                researchers: DataFrame, lead_first: bool = True, dedupe: bool = True,
                broadcast_max_rows: int | None = DEFAULT_BROADCAST_MAX_ROWS) -> DataFrame:
    """The gold fact, one row per ``(event_id, ingestion_mode)``.

    ``lead_first`` (R1) reduces researchers to one per vessel before the join,
    so the join never multiplies event rows; the final top-1 then only
    collapses redelivered events within a mode, with the same ordering as the
    literal fan-out form (``lead_first=False``), which gives the same rows.
    """
    r = lead_researchers(researchers) if lead_first else researchers
    if not dedupe:
        joined = enrich(telemetry, vessels, locations, r, broadcast_max_rows)
    else:
        # reduce narrow rows: keys, readings and what the order needs; no
        # descriptive text goes through the shuffle
        keys = broadcast_if_bounded(r.select("assigned_vessel_id", "researcher_id", "tenure_days"),
                                    broadcast_max_rows)
        narrow = (telemetry.join(keys, telemetry.vessel_id == keys.assigned_vessel_id, "left")
                  .drop("assigned_vessel_id"))
        order = _lead_order() + [F.col(c).asc_nulls_last() for c in
                                 ("vessel_id", "location_id", "observed_at", "gravity_g")]
        narrow = top1(narrow, ["event_id", "ingestion_mode"], order)
        # descriptions are functions of the surviving keys (each dimension's key is unique)
        joined = describe(narrow, vessels, locations, r, broadcast_max_rows)
    return joined.select(*[c for c in FACT_COLUMNS if c != "is_low_g"],
                         low_g_flag("gravity_g").alias("is_low_g"))
