import datetime as dt
from decimal import Decimal

import pytest

from tessera.sources.keyed import KeyedTable
from tessera.sources.tables import VersionedTable
from tessera.streaming import feed

SCHEMA = "k long, v string, t timestamp_ntz, d date, x double, m decimal(9,2), a array<int>, b boolean"


def rows(spark, ks):
    return spark.createDataFrame([(k, None if k % 3 == 0 else f"é{k}", dt.datetime(2024, 1, 1, 0, 0, 0, k), dt.date(2024, 1, 1), k / 2,
                                   Decimal("1.25"), [k, None], k % 2 == 0) for k in ks], SCHEMA)


def test_commits_are_streamed_once_over_a_restart(spark, scratch):
    root = scratch("feed")
    t = VersionedTable(spark, f"{root}/t")
    t.append(rows(spark, range(5)))
    t.append(rows(spark, range(5, 9)))
    args = (spark, t.path, f"{root}/sink", f"{root}/cp")
    feed.copy_available(*args)
    assert spark.read.parquet(f"{root}/sink").count() == 9
    t.append(rows(spark, range(9, 12)))
    t.append(rows(spark, []))
    feed.copy_available(*args)
    feed.copy_available(*args)
    got = spark.read.schema(SCHEMA).parquet(f"{root}/sink")
    assert sorted(got.collect()) == sorted(rows(spark, range(12)).collect())


def test_a_keyed_table_is_streamed_until_rows_are_replaced(spark, scratch):
    root = scratch("keyed")
    t = KeyedTable(spark, f"{root}/t", "k", buckets=3)
    t.merge(rows(spark, range(6)))
    t.merge(rows(spark, range(6, 10)))
    args = (spark, t.path, f"{root}/sink", f"{root}/cp")
    feed.copy_available(*args)
    assert sorted(r.k for r in spark.read.parquet(f"{root}/sink").collect()) == list(range(10))
    t.merge(rows(spark, [2]))
    with pytest.raises(Exception, match="replaced rows"):
        feed.copy_available(*args)
    assert spark.read.parquet(f"{root}/sink").count() == 10


def test_one_task_for_each_file_and_no_table(spark, scratch):
    t = VersionedTable(spark, scratch("files"))
    with pytest.raises(Exception, match="no committed version"):
        feed.appended(spark, t.path)
    t.append(rows(spark, range(40)).repartition(4))
    reader = feed.FeedReader(t.path, t.schema())
    parts = reader.partitions(reader.initialOffset(), reader.latestOffset())
    assert len(parts) == 4 and reader.partitions({"version": 1}, {"version": 1}) == []
    assert sum(b.num_rows for p in parts for b in reader.read(p)) == 40
