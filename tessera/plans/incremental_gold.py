"""Incremental build of the gold fact (P1, P2): only the days that a change can reach.

Silver is stored by day, one table for each ingestion mode.  A release of the fact names the
build folder of every day, the dimensions and leads of the build, and the fingerprints of the silver
days it was built from.  The next build takes

1. the days whose silver files changed, appeared or went,
2. the days with rows of a vessel or location whose description or lead changed (found in
   silver: the row that a changed lead makes the winner need not be in the fact yet),
3. the other days that hold a further delivery of one of their events,

computes those days anew, with all deliveries of their events wherever they are, and
publishes them beside the untouched days as one release.  The result is that of a full build
with the same as-of date.  (Ages and tenures are part of the fact, so another as-of date
changes every vessel, and every day is built again.)
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import gold
from tessera.operators.audit_history import StoredModel, _days, _read
from tessera.operators.sizing import DEFAULT_BROADCAST_MAX_ROWS
from tessera.plans.medallion import Dims, _join_side
from tessera.schemas import CORE_TELEMETRY_COLUMNS
from tessera.sources import fs
from tessera.sources.layout import write_clustered_table
from tessera.sources.tables import Releases, materialize, materialize_counted

DAY = "observed_date"
FACT, STATE = "fct_events", "_days"
#: Build folders that a release may refer to; beyond it every day is built again into one.
MAX_BUILDS = 50
_EVENT = ["ingestion_mode", "event_id"]
#: The columns of each dimension that reach the fact, its key first.
_USED = {"dim_vessels": ["vessel_id", "vessel_name", "vessel_type", "age_days"],
         "dim_locations": ["location_id", "location_name", "region"],
         "lead_researchers": ["assigned_vessel_id", "researcher_id", "full_name", "specialization", "tenure_days"]}


@dataclass
class Build:
    release: int
    days_built: list[str]
    days_kept: list[str]


def read_fact(spark: SparkSession, gold_root: str) -> DataFrame:
    """The live fact: each day from the build that the release names for it."""
    paths = Releases(spark, gold_root).paths()
    builds: dict[str, list[str]] = {}
    for name, folder in paths.items():
        if name.startswith(f"{FACT}/"):
            builds.setdefault(folder, []).append(f"{folder}/{DAY}={name.split('/', 1)[1]}")
    if not builds:
        raise ValueError(f"{gold_root} has no fact yet")
    parts = [spark.read.option("basePath", folder).parquet(*days) for folder, days in sorted(builds.items())]
    return reduce(DataFrame.unionByName, parts)


def _telemetry(spark: SparkSession, silver: dict[str, StoredModel], days: dict[str, list[str]]) -> DataFrame:
    """Unified silver of some days of each mode, with ``_day``."""
    parts = [_read(spark, m, days[mode]).select(*CORE_TELEMETRY_COLUMNS, F.lit(mode).alias("ingestion_mode"), "_day")
             for mode, m in silver.items() if days[mode]]
    return reduce(DataFrame.unionByName, parts)


def _changed_keys(new: DataFrame, old: DataFrame, columns: list[str]) -> DataFrame:
    """Keys (first column) of rows that only one of two versions of a dimension has."""
    a, b = new.select(*columns), old.select(*columns)
    return a.exceptAll(b).union(b.exceptAll(a)).select(F.col(columns[0]).alias("key")).distinct()


def _days_of(rows: DataFrame) -> set[str]:
    return {r["_day"] for r in rows.select("_day").distinct().collect()}  # bounded by the days


def incremental_build(spark: SparkSession, gold_root: str, silver: dict[str, StoredModel], dims: Dims,
                      broadcast_max_rows: int | None = DEFAULT_BROADCAST_MAX_ROWS) -> Build:
    """Build what changed since the live release and publish it; see the module's text."""
    releases = Releases(spark, gold_root)
    base, before, folder = releases.version, releases.paths(), releases.new_folder()
    now = {mode: _days(spark, m) for mode, m in silver.items()}
    there = {mode: sorted(days) for mode, days in now.items()}
    old = json.loads(fs.read_text(spark, before[STATE])) if before else {}
    every = {d for days in [*now.values(), *old.values()] for d in days}
    changed = {d for d in every if any(now.get(m, {}).get(d) != old.get(m, {}).get(d) for m in {*now, *old})}

    stored = {"dim_vessels": dims.vessels, "dim_locations": dims.locations, "dim_researchers": dims.researchers}
    done = {name: materialize_counted(df, name, f"{folder}/{name}") for name, df in stored.items()}
    done["lead_researchers"] = materialize_counted(gold.lead_researchers(done["dim_researchers"][0]), "leads", f"{folder}/lead_researchers")
    builds = {p for n, p in before.items() if n.startswith(f"{FACT}/")}
    if not before or len(builds) >= MAX_BUILDS:
        changed = every
    elif any(there.values()):
        rows = _telemetry(spark, silver, there)
        for name, column in (("dim_vessels", "vessel_id"), ("lead_researchers", "vessel_id"), ("dim_locations", "location_id")):
            keys = materialize(_changed_keys(done[name][0], spark.read.parquet(before[name]), _USED[name]), "gold-keys")
            if not keys.isEmpty():
                changed |= _days_of(rows.join(keys, F.col(column) == F.col("key"), "left_semi"))
        if changed and changed != every:
            events = rows.where(F.col("_day").isin(*changed)).select(*_EVENT)
            if built := [n for n in before if n.startswith(f"{FACT}/") and n.split("/", 1)[1] in changed]:
                was = read_fact(spark, gold_root).withColumn("_day", F.coalesce(F.col(DAY).cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__")))
                events = events.union(was.where(F.col("_day").isin(*[n.split("/", 1)[1] for n in built])).select(*_EVENT))
            others = rows.where(~F.col("_day").isin(*changed))
            changed |= _days_of(others.join(events.distinct(), _EVENT, "left_semi"))

    names = {n: p for n, p in before.items() if n.startswith(f"{FACT}/") and n.split("/", 1)[1] not in changed}
    kept = sorted(n.split("/", 1)[1] for n in names)
    if changed and any(there.values()):
        rows = _telemetry(spark, silver, there)
        mine = rows.where(F.col("_day").isin(*changed))
        if changed != every:  # further deliveries of the same events take part, but are not written
            mine = mine.unionByName(rows.where(~F.col("_day").isin(*changed)).join(mine.select(*_EVENT).distinct(), _EVENT, "left_semi")
                                    .select(*mine.columns))
        side = {k: _join_side(df, n, broadcast_max_rows) for k, (df, n) in done.items()}
        fact = gold.fact_events(mine.drop("_day"), side["dim_vessels"], side["dim_locations"], side["lead_researchers"],
                                lead_first=False, dedupe=True, broadcast_max_rows=None)
        day = F.coalesce(F.to_date("observed_at").cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__"))
        path = f"{folder}/{FACT}"
        write_clustered_table(fact.where(day.isin(*changed)), path, "observed_at", DAY,
                              ["location_id", "vessel_id", "vessel_type"], tiebreak=["event_id"])
        names |= {f"{FACT}/{d}": path for d in fs.list_partition_values(spark, path, DAY)}
    fs.publish_new(spark, f"{folder}/days.json", json.dumps(now))
    paths = names | {n: f"{folder}/{n}" for n in done} | {STATE: f"{folder}/days.json"}
    return Build(releases.publish(paths, base), sorted(changed), kept)
