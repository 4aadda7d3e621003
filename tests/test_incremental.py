import datetime as dt

import pytest
from pyspark.sql import functions as F

from tessera.operators import incremental as inc
from tessera.plans.api_ingest import ApiTables, merge_into, run_cycle
from tessera.sources.keyed import KeyedTable
from tessera.sources.tables import VersionedTable

T0 = dt.datetime(2024, 1, 1)


def test_upsert_updates_inserts_and_keeps(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    source = spark.createDataFrame([(2, "B"), (3, "C")], "k long, v string")
    got = sorted(tuple(r) for r in inc.upsert(target, source, "k").collect())
    assert got == [(1, "a"), (2, "B"), (3, "C")]


def test_upsert_rejects_duplicate_source_keys(spark):
    source = spark.createDataFrame([(2, "B"), (2, "b")], "k long, v string")
    with pytest.raises(ValueError, match="more than once"):
        inc.upsert(None, source, "k")


def test_upsert_latest_keeps_newest(spark):
    source = spark.createDataFrame([(2, "old", 1), (2, "new", 2)], "k long, v string, t int")
    got = inc.upsert(None, source, "k", on_duplicate="latest", order_col="t").collect()
    assert [(r.k, r.v) for r in got] == [(2, "new")]


def test_high_water_mark_global_vs_per_stream(spark):
    target = spark.createDataFrame(
        [("fraud", T0 + dt.timedelta(days=5)), ("audit", T0 + dt.timedelta(days=1))],
        "source_stream string, ingested_at timestamp_ntz")
    raw = spark.createDataFrame(
        [("fraud", T0 + dt.timedelta(days=3)), ("audit", T0 + dt.timedelta(days=3)),
         ("access", T0), ("fraud", T0 + dt.timedelta(days=6))],
        "source_stream string, ingested_at timestamp_ntz")
    glob = inc.incremental_filter(raw, target, scope="global").collect()
    assert [r.source_stream for r in glob] == ["fraud"]
    per = sorted(r.source_stream for r in inc.incremental_filter(raw, target, scope="per_stream").collect())
    assert per == ["access", "audit", "fraud"]
    empty = inc.incremental_filter(raw, None, scope="global").count()
    assert empty == 4


def test_extract_and_advance(spark):
    log = spark.createDataFrame(
        [("fraud", 1), ("fraud", 5), ("audit", 2), ("audit", 7), ("other", 9)],
        "stream_name string, pos long")
    wm = spark.createDataFrame([("fraud", "cursor_fraud_1", T0)],
                               "stream_name string, current_cursor string, updated_at timestamp_ntz")
    cursors = inc.watermark_lookup(spark, ["fraud", "audit", "access"], wm)
    got = sorted((r.stream_name, r.pos) for r in inc.extract_new(log, cursors).collect())
    assert got == [("audit", 2), ("audit", 7), ("fraud", 5)]
    adv = inc.advance_cursors(spark, ["fraud", "audit", "access"],
                              inc.extract_new(log, cursors), T0)
    assert sorted((r.stream_name, r.current_cursor) for r in adv.collect()) == \
        [("audit", "cursor_audit_7"), ("fraud", "cursor_fraud_5")]


def test_unparsable_cursor_is_an_error(spark):
    wm = spark.createDataFrame([("fraud", "garbage", T0)],
                               "stream_name string, current_cursor string, updated_at timestamp_ntz")
    with pytest.raises(ValueError, match="unparsable"):
        inc.watermark_lookup(spark, ["fraud"], wm)


def test_versioned_table_append_then_rewrite(spark, scratch):
    t = KeyedTable(spark, scratch("vt"), "k")
    assert not t.exists()
    a = spark.createDataFrame([(1, "a")], "k long, v string")
    assert merge_into(t, a, "k") == "append"
    assert merge_into(t, spark.createDataFrame([(2, "b")], "k long, v string"), "k") == "append"
    assert merge_into(t, spark.createDataFrame([(1, "A")], "k long, v string"), "k") == "rewrite"
    assert sorted(tuple(r) for r in t.read().collect()) == [(1, "A"), (2, "b")]
    assert t.version == 3


def test_cycle_is_safe_to_rerun(spark, scratch):
    log = spark.createDataFrame(
        [("fraud", i, str(i), "error", '{"value": %d}' % i, float(i)) for i in range(1, 7)],
        "stream_name string, pos long, event_id string, stream_type string, data string, "
        "timestamp double")
    tabs = ApiTables(scratch("cycle"))
    run_cycle(spark, log.where(F.col("pos") <= 3), tabs, ["fraud"], "2024-01-01 00:00:00", "1")
    run_cycle(spark, log, tabs, ["fraud"], "2024-01-02 00:00:00", "2")
    run_cycle(spark, log, tabs, ["fraud"], "2024-01-03 00:00:00", "3")  # nothing new
    silver = tabs.silver(spark).read()
    assert silver.count() == 6
    assert sorted(r.measure_value for r in silver.collect()) == [str(i) for i in range(1, 7)]
    wm = tabs.watermarks(spark).read().collect()
    assert [(r.stream_name, r.current_cursor) for r in wm] == [("fraud", "cursor_fraud_6")]


def test_merge_records_high_water_marks(spark, scratch):
    t = KeyedTable(spark, scratch("marks"), "k")
    rows = [(1, "fraud", T0), (2, "audit", T0 + dt.timedelta(days=2))]
    df = spark.createDataFrame(rows, "k long, source_stream string, ingested_at timestamp_ntz")
    merge_into(t, df, "k", mark_col="ingested_at", mark_by="source_stream")
    later = spark.createDataFrame([(1, "fraud", T0 + dt.timedelta(days=1))],
                                  "k long, source_stream string, ingested_at timestamp_ntz")
    assert merge_into(t, later, "k", mark_col="ingested_at", mark_by="source_stream") == "rewrite"
    from tessera.plans.api_ingest import marks_as_timestamps
    assert marks_as_timestamps(t.marks()) == {"fraud": T0 + dt.timedelta(days=1),
                                             "audit": T0 + dt.timedelta(days=2)}
    # the stored marks give the same filter as scanning the table
    raw = spark.createDataFrame([("fraud", T0 + dt.timedelta(days=1, hours=1)),
                                 ("audit", T0 + dt.timedelta(days=1))],
                                "source_stream string, ingested_at timestamp_ntz")
    a = inc.incremental_filter(raw, None, scope="per_stream", marks=marks_as_timestamps(t.marks()))
    b = inc.incremental_filter(raw, t.read(), scope="per_stream")
    assert sorted(a.collect()) == sorted(b.collect()) and a.count() == 1


def test_retried_raw_load_replaces_its_own_rows(spark, scratch):
    from tessera.sources.tables import append_raw
    p = scratch("raw")
    df = spark.createDataFrame([(T0, "a")], "ingested_at timestamp_ntz, event_id string")
    append_raw(df, p, run_id="7")
    append_raw(df, p, run_id="7")   # retry of the same run
    append_raw(df, p, run_id="8")   # a later run
    assert spark.read.parquet(p).count() == 2


def test_vacuum_keeps_only_live_segments(spark, scratch):
    t = VersionedTable(spark, scratch("vac"))
    t.append(spark.createDataFrame([(1, "a")], "k long, v string"))
    t.rewrite(spark.createDataFrame([(1, "b")], "k long, v string"))
    assert len(t.vacuum()) == 1
    assert [tuple(r) for r in t.read().collect()] == [(1, "b")]


def test_crash_before_cursor_commit_is_harmless(spark, scratch, monkeypatch):
    log = spark.createDataFrame(
        [("fraud", i, str(i), "error", '{"value": %d}' % i, float(i)) for i in range(1, 9)],
        "stream_name string, pos long, event_id string, stream_type string, data string, "
        "timestamp double")
    tabs = ApiTables(scratch("crash"))
    run_cycle(spark, log.where(F.col("pos") <= 4), tabs, ["fraud"], "2024-01-01 00:00:00", "1")

    def boom(*a, **k):
        raise RuntimeError("driver lost before the cursor commit")

    monkeypatch.setattr(inc, "cursors_from_metrics", boom)
    with pytest.raises(RuntimeError):
        run_cycle(spark, log, tabs, ["fraud"], "2024-01-02 00:00:00", "2")
    monkeypatch.undo()
    # silver already holds run 2's rows, the cursor still says 4: the retry
    # re-reads offsets 5..8 and the keyed merge absorbs them
    assert tabs.silver(spark).read().count() == 8
    run_cycle(spark, log, tabs, ["fraud"], "2024-01-02 00:00:00", "2")
    silver = tabs.silver(spark).read()
    assert silver.count() == 8 and silver.select("event_id").distinct().count() == 8
    assert [r.current_cursor for r in tabs.watermarks(spark).read().collect()] == ["cursor_fraud_8"]


def _log(spark, n):
    return spark.createDataFrame(
        [("fraud", i, str(i), "error", '{"value": %d}' % i, float(i)) for i in range(1, n + 1)],
        "stream_name string, pos long, event_id string, stream_type string, data string, timestamp double")


def _state(spark, tabs):
    import glob
    cursors = [r.current_cursor for r in tabs.watermarks(spark).read().collect()]
    raw = spark.read.parquet(tabs.raw).count()
    landed = sum(1 for f in glob.glob(f"{tabs.landing}/**/*.txt", recursive=True) for _ in open(f))
    return tabs.silver(spark).read().count(), raw, landed, cursors


def test_same_and_older_stamps_lose_no_row(spark, scratch):
    tabs = ApiTables(scratch("stamps"))
    for run, n, stamp in (("1", 4, "2024-01-02"), ("2", 8, "2024-01-02"), ("3", 12, "2023-06-01")):
        run_cycle(spark, _log(spark, n), tabs, ["fraud"], f"{stamp} 00:00:00", run)
    assert _state(spark, tabs) == (12, 12, 12, ["cursor_fraud_12"])


@pytest.mark.parametrize("step", ["land", "raw", "silver", "cursors"])
def test_crash_at_a_commit_point_then_retry_across_midnight(spark, scratch, step):
    tabs = ApiTables(scratch("points"))

    def stop(done):
        if done == step:
            raise RuntimeError("lost")

    with pytest.raises(RuntimeError, match="lost"):
        run_cycle(spark, _log(spark, 4), tabs, ["fraud"], "2024-01-02 23:59:00", "1", after_step=stop)
    run_cycle(spark, _log(spark, 8), tabs, ["fraud"], "2024-01-03 00:04:00", "1")
    run_cycle(spark, _log(spark, 9), tabs, ["fraud"], "2024-01-03 01:00:00", "2")
    assert _state(spark, tabs) == (9, 9, 9, ["cursor_fraud_9"])


def test_a_finished_run_started_again_changes_nothing(spark, scratch):
    tabs = ApiTables(scratch("again"))
    run_cycle(spark, _log(spark, 4), tabs, ["fraud"], "2024-01-02 00:00:00", "1")
    before = _state(spark, tabs)
    report = run_cycle(spark, _log(spark, 4), tabs, ["fraud"], "2024-01-02 00:00:00", "1")
    assert report["silver_write"] == "finished before" and _state(spark, tabs) == before


def test_catalog_merge_needs_a_row_level_format(spark):
    name = "tessera_merge_probe"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.createDataFrame([(1, "a")], "k long, v string").write.format("parquet").saveAsTable(name)
    try:
        with pytest.raises(Exception, match="MERGE"):
            inc.merge_into_catalog_table(
                spark.createDataFrame([(1, "b")], "k long, v string"), name, "k")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
