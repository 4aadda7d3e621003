import importlib


def test_entry_runs_on_smallest_scale(spark):
    entry = importlib.import_module("__spark_entry__")
    df = entry.entry(spark)
    assert df.count() > 0
    assert "is_low_g" in df.columns and "ingestion_mode" in df.columns


def test_every_oracle_has_a_query():
    entry = importlib.import_module("__spark_entry__")
    qs, sqls = entry.queries(), entry.oracle_sql()
    assert set(sqls) <= set(qs)
    assert len(qs) >= 40


def test_fact_plan_stays_in_the_jvm(spark):
    from tessera.plans import medallion
    plan = medallion.fact_unified(spark, "/root/testdata/sf0.001")._jdf.queryExecution() \
        .executedPlan().toString()
    assert "WindowGroupLimit" in plan
    assert plan.count("BroadcastHashJoin") == 4
    assert "Python" not in plan and "ArrowEval" not in plan


def test_incremental_filter_reaches_the_scan(spark, scratch):
    from tessera.operators import incremental as inc
    p = scratch("raw")
    df = spark.createDataFrame([("2024-01-01 00:00:00",), ("2024-01-03 00:00:00",)], "t string") \
        .selectExpr("cast(t as timestamp_ntz) as ingested_at", "to_date(t) as _ingest_date")
    df.write.partitionBy("_ingest_date").parquet(p)
    target = spark.createDataFrame([("2024-01-02 00:00:00",)], "t string") \
        .selectExpr("cast(t as timestamp_ntz) as ingested_at")
    got = inc.incremental_filter(spark.read.parquet(p), target, partition_col="_ingest_date")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ingested_at), GreaterThan(ingested_at" in plan
    assert "PartitionFilters" in plan
    assert got.count() == 1


def test_per_stream_marks_prune_day_folders(spark, scratch):
    import datetime as dt
    from tessera.operators import incremental as inc
    p = scratch("raw2")
    df = spark.createDataFrame([("a", "2024-01-01 00:00:00"), ("b", "2024-01-05 00:00:00")],
                               "s string, t string") \
        .selectExpr("s as source_stream", "cast(t as timestamp_ntz) as ingested_at",
                    "to_date(t) as _ingest_date")
    df.write.partitionBy("_ingest_date").parquet(p)
    marks = {"a": dt.datetime(2024, 1, 3), "b": dt.datetime(2024, 1, 4)}
    got = inc.incremental_filter(spark.read.parquet(p), None, scope="per_stream",
                                 partition_col="_ingest_date", marks=marks, streams=["a", "b"])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_ingest_date" in plan and "2024-01-03" in plan
    assert [r.source_stream for r in got.collect()] == ["b"]
