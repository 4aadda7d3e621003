import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tessera.sources import layout


def table(spark, n=60_000):
    return spark.range(n).select(
        F.col("id").alias("event_id"), F.format_string("V%03d", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(40))).alias("vessel_id"),
        F.pmod(F.xxhash64("id", F.lit(2)), F.lit(30)).alias("location_id"),
        F.when(F.col("id") % 50 != 0, F.format_string("T%d", F.pmod(F.xxhash64("id", F.lit(3)), F.lit(8)))).alias("vessel_type"),
        F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id % 172800)").alias("t"))


CLUSTER = ["location_id", "vessel_id", "vessel_type"]


def groups_read(path, column, value):
    """Row groups whose footer statistics allow the value."""
    hit = 0
    for f in glob.glob(f"{path}/**/*.parquet", recursive=True):
        meta = pq.ParquetFile(f).metadata
        at = meta.schema.names.index(column)
        for g in range(meta.num_row_groups):
            s = meta.row_group(g).column(at).statistics
            hit += s is not None and s.has_min_max and s.min <= value <= s.max
    return hit


def test_fewer_row_groups_for_the_second_and_third_column(spark, scratch):
    df, paths = table(spark), {}
    for order in ("sorted", "z"):
        paths[order] = scratch(order)
        report = layout.write_clustered_table(df, paths[order], "t", "day", CLUSTER, ["event_id"], target_bytes=8_000, order=order)
        assert report["rows"] == 60_000 and report["ranges"] == -(-report["bytes"] // 8_000)
        assert sorted(r.event_id for r in spark.read.parquet(paths[order]).collect()) == list(range(60_000))
    read = {(o, c): groups_read(paths[o], c, v) for o in paths
            for c, v in (("location_id", 17), ("vessel_id", "V021"), ("vessel_type", "T5"))}
    assert read["z", "vessel_id"] < 0.6 * read["sorted", "vessel_id"]
    assert read["z", "vessel_type"] < 0.6 * read["sorted", "vessel_type"]
    files = len(glob.glob(f"{paths['z']}/**/*.parquet", recursive=True))
    assert read["z", "location_id"] < 0.6 * files


def test_ranges_follow_the_values(spark):
    df = table(spark, 5_000)
    bounds = layout.range_bounds(df, CLUSTER, 5_000, bits=3)
    assert all(len(b) <= 7 and b == sorted(b) for b in bounds.values())
    for c in CLUSTER:
        got = df.select(c, layout.range_of(c, bounds[c], 3).alias("r")).distinct().collect()
        for r in got:
            below = 0 if r[c] is None else sum(b <= r[c] for b in bounds[c])
            assert r.r == below * 8 // (len(bounds[c]) + 1)


def test_bits_are_interleaved(spark):
    df = spark.createDataFrame([(0b101, 0b011)], "a long, b long")
    assert df.select(layout.interleaved(["a", "b"], 3).alias("z")).first().z == 0b100111


def test_bounds_of_any_type(spark):
    import datetime as dt
    from decimal import Decimal
    rows = [("it's", 1.5, dt.date(2024, 1, 1), Decimal("1.50"), True, dt.datetime(2024, 1, 1, 2)),
            ("a\\b", float("inf"), dt.date(2024, 2, 1), Decimal("9.25"), False, dt.datetime(2024, 1, 2, 2)), (None,) * 6]
    df = spark.createDataFrame(rows, "s string, x double, d date, m decimal(9,2), b boolean, t timestamp_ntz")
    for c in df.columns:
        values = sorted(r[c] for r in df.collect() if r[c] is not None)
        got = [r.r for r in df.orderBy(F.col(c).asc_nulls_first()).select(layout.range_of(c, values, 4).alias("r")).collect()]
        assert got == [0, 5, 10], c


@pytest.mark.parametrize("cluster", [[], ["v"]])
def test_an_empty_and_an_unclustered_table(spark, scratch, cluster):
    p, q = scratch("none"), scratch("one")
    df = spark.createDataFrame([], "k long, v string, t timestamp_ntz")
    assert layout.write_clustered_table(df, p, "t", "day", cluster)["rows"] == 0
    df = spark.createDataFrame([(1, None)], "k long, v string").withColumn("t", F.lit(None).cast("timestamp_ntz"))
    layout.write_clustered_table(df, q, "t", "day", cluster)
    assert spark.read.parquet(q).count() == 1
