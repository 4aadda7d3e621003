import datetime as dt

import pytest
from pyspark.sql import functions as F

from tessera.operators import gold, silver
from tessera.operators.audit_history import StoredModel
from tessera.plans import incremental_gold as I
from tessera.plans.medallion import Dims
from tessera.schemas import RAW_LOCATIONS, RAW_RESEARCHERS, RAW_VESSELS
from tessera.sources import fs

T0 = dt.datetime(2026, 3, 1)
CORE = "event_id long, vessel_id string, location_id string, gravity_g double, observed_at timestamp_ntz"


def dims(spark, region="north", joined=(5, 9, 3), as_of="2026-04-01"):
    v = spark.createDataFrame([(f"V{i}", f"n{i}", "t", T0) for i in range(3)], RAW_VESSELS)
    lo = spark.createDataFrame([("L0", "a", region, "x"), ("L1", "b", "south", "x")], RAW_LOCATIONS)
    r = spark.createDataFrame([(i, "A", f"B{i}", "a@b", "s", f"V{i % 3}", T0 - dt.timedelta(days=d)) for i, d in enumerate(joined)], RAW_RESEARCHERS)
    return Dims(gold.dim_vessels(silver.stg_vessels(v), as_of), gold.dim_locations(silver.stg_locations(lo)),
                gold.dim_researchers(silver.stg_researchers(r), as_of))


class World:
    def __init__(self, spark, root):
        self.spark, self.root, self.rows = spark, root, {"batch": [], "stream": []}

    def add(self, mode, day, events):
        rows = [(e, v, loc, 0.5, None if day is None else T0 + dt.timedelta(days=day, minutes=e)) for e, v, loc in events]
        self.rows[mode] += rows
        (self.spark.createDataFrame(rows, CORE).withColumn("day", F.to_date("observed_at")).coalesce(1)
         .write.mode("append").partitionBy("day").parquet(f"{self.root}/{mode}"))

    def drop(self, mode, day):
        at = T0 + dt.timedelta(days=day)
        fs.delete(self.spark, f"{self.root}/{mode}/day={at:%Y-%m-%d}")
        self.rows[mode] = [r for r in self.rows[mode] if r[4] is None or r[4].date() != at.date()]

    def build(self, d):
        models = {m: StoredModel(f"{self.root}/{m}", self.spark.read.parquet(f"{self.root}/{m}").schema, "day") for m in self.rows}
        done = I.incremental_build(self.spark, f"{self.root}/gold", models, d)
        frames = [self.spark.createDataFrame(rows, CORE).withColumn("ingestion_mode", F.lit(m)) for m, rows in self.rows.items()]
        full = gold.fact_events(frames[0].unionByName(frames[1]), d.vessels, d.locations, d.researchers)
        got = I.read_fact(self.spark, f"{self.root}/gold")
        assert got.columns[:-1] == list(gold.FACT_COLUMNS)
        assert sorted(map(repr, (tuple(r) for r in got.drop(I.DAY).collect()))) == sorted(map(repr, (tuple(r) for r in full.collect())))
        return [int(x[-2:]) - 1 if x[0] == "2" else None for x in done.days_built]


@pytest.fixture
def world(spark, scratch):
    w = World(spark, scratch("gold"))
    for day in range(5):
        w.add("batch", day, [(10 * day + k, f"V{k % 2}", "L1") for k in range(6)])
    w.add("stream", 1, [(10, "V0", "L0"), (99, "V2", "L0")])
    assert w.build(dims(spark)) == [0, 1, 2, 3, 4]
    return w


def test_late_rows_new_days_and_nothing(spark, world):
    assert world.build(dims(spark)) == []
    world.add("batch", 2, [(27, "V1", "L1")])
    world.add("batch", 6, [(60, "V0", "L1")])
    assert world.build(dims(spark)) == [2, 6]
    world.add("batch", None, [(70, "V0", "L1")])                 # no time: a day of its own
    assert world.build(dims(spark)) == [None]
    world.drop("batch", 3)
    assert world.build(dims(spark)) == [3]


def test_changed_descriptions_and_leads_reach_their_days(spark, world):
    assert world.build(dims(spark, region="east")) == [1]        # only day 1 has a row at L0
    assert world.build(dims(spark, region="east", joined=(5, 9, 4))) == [1]   # V2's lead, one event
    assert world.build(dims(spark, region="east", joined=(5, 9, 4, 20))) == [0, 1, 2, 3, 4]   # V0 has another lead
    assert world.build(dims(spark, as_of="2026-04-02")) == [0, 1, 2, 3, 4]


def test_an_event_delivered_on_two_days_is_there_once(spark, world):
    world.add("batch", 4, [(0, "V1", "L1")])                     # event 0 of day 0 again: V1's lead is longer there
    assert world.build(dims(spark)) == [0, 4]
    assert world.build(dims(spark, joined=(30, 9, 3))) == [0, 1, 2, 3, 4]     # now V0's is
    world.drop("batch", 0)
    assert world.build(dims(spark, joined=(30, 9, 3))) == [0, 4]
    world.add("stream", 4, [(99, "V1", "L1")])
    assert world.build(dims(spark, joined=(30, 9, 3))) == [1, 4]
