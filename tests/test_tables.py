import glob
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.sources import tables


def test_typed_csv_fails_fast_on_bad_value(spark, scratch):
    p = scratch("csv")
    os.makedirs(p)
    with open(f"{p}/a.csv", "w") as fh:
        fh.write('"id","x"\n"1","2.5"\n"two","3"\n')
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("x", T.DoubleType())])
    with pytest.raises(Exception):
        tables.read_csv_typed(spark, p, schema).collect()


def test_landing_caps_rows_per_file(spark, scratch):
    p = scratch("land")
    df = spark.range(120).select(F.lit("fraud").alias("source_stream"),
                                 F.lit("2024-01-01").cast("date").alias("dt"),
                                 F.col("id").cast("string").alias("event_id"),
                                 F.lit('{"k": 1}').alias("data")).coalesce(1)
    tables.write_landing(df, p, rows_per_file=50)
    files = glob.glob(f"{p}/source_stream=fraud/dt=2024-01-01/*.txt")
    assert len(files) == 3
    with open(sorted(files)[0]) as fh:
        assert '"data":{"k": 1}' in fh.readline()


def test_landed_payloads_come_back_byte_for_byte(spark, scratch):
    p = scratch("payloads")
    texts = ['{"value": 1.0, "b": 2, "a": 1}', '{"k":1,"k":2}', "not json", '"text"', "5", "", None, '{"a":\n1}',
             "[1, 2.50]", '{"k": 12345678901234567890123456789012345678901}', '{"é": "\\u00e9"}', "{", "null"]
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("data", T.StringType())])
    tables.write_landing(spark.createDataFrame(list(enumerate(texts)), schema), p, partition_cols=())
    got = {r.id: r.data for r in tables.read_ndjson(spark, p, schema).collect()}
    assert got == dict(enumerate(texts))


def test_two_writers_from_one_version_and_a_lost_pointer(spark, scratch):
    from tessera.sources import fs
    path = scratch("versions")
    a = tables.VersionedTable(spark, path)
    a.append(spark.range(3))
    base = a.version
    a.commit_rewrite(spark.range(5), base=base)
    with pytest.raises(tables.StaleVersion):
        tables.VersionedTable(spark, path).commit_rewrite(spark.range(9), base=base)
    assert a.read().count() == 5
    # the pointer of the next version exists already: the second of two commits fails
    fs.publish_new(spark, f"{a.pointers}/v{a.version + 1:012d}.json", '{"version": 3, "segments": []}')
    assert not fs.publish_new(spark, f"{a.pointers}/v{3:012d}.json", "{}")
    for name in fs.list_files(spark, a.pointers):
        fs.delete(spark, f"{a.pointers}/{name}")
    with pytest.raises(tables.LostPointer):
        a.append(spark.range(1))


def test_retention_has_no_depth_limit(spark, scratch):
    p = scratch("deep")
    df = spark.createDataFrame([("2024-01-01",), ("2024-01-12",)], "d string").selectExpr(
        "1 a", "1 b", "1 c", "1 e", "1 f", "to_date(d) dt", "d")
    df.write.partitionBy("a", "b", "c", "e", "f", "dt").parquet(p)
    assert len(tables.expire_partitions(spark, p, "dt", "2024-01-12")) == 1
    assert spark.read.parquet(p).count() == 1


def test_retention_drops_old_day_folders(spark, scratch):
    p = scratch("ret")
    df = spark.createDataFrame([("a", "2024-01-01"), ("a", "2024-01-10"), ("b", "2024-01-12")],
                               "source_stream string, d string").withColumn("dt", F.to_date("d"))
    df.write.partitionBy("source_stream", "dt").parquet(p)
    dropped = tables.expire_partitions(spark, p, "dt", "2024-01-12", keep_days=7)
    assert [os.path.basename(x) for x in dropped] == ["dt=2024-01-01"]
    assert spark.read.parquet(p).count() == 2


def test_partitioned_table_prunes_days(spark, scratch):
    p = scratch("gold")
    df = spark.createDataFrame([(1, "2024-01-01 10:00:00"), (2, "2024-01-02 10:00:00")],
                               "k long, t string").withColumn("t", F.col("t").cast("timestamp_ntz"))
    tables.write_partitioned_table(df, p, "t", "day", ("k",))
    got = tables.read_day_range(spark, p, "t", "day", "2024-01-02", "2024-01-03")
    assert [r.k for r in got.collect()] == [2]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "day" in plan
