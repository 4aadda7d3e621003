from pyspark.sql import functions as F

from tessera.streaming import silver as S
from tessera.streaming.bronze import parse_contract, topic_source

GOOD = ('{"id": %d, "vessel_id": "V1", "raw_force_reading": 0.5, "location_id": "L1", '
        '"event_time": "2026-03-18T10:00:00Z", "unknown": true}')
BAD = ['{"id":"x"}', "junk",
       '{"id": 9, "vessel_id": "V1", "raw_force_reading": 9.8, "location_id": "L1", '
       '"event_time": "yesterday"}']


def _drop(spark, folder, lines):
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1) \
        .write.mode("append").text(folder)


def test_contract_split(spark):
    df = spark.createDataFrame([(GOOD % 1,)] + [(b,) for b in BAD], "value string")
    parsed = parse_contract(df).collect()
    assert sum(r.reject_reason is None for r in parsed) == 1
    assert sum(r.reject_reason is not None for r in parsed) == 3


def test_restart_neither_loses_nor_replays(spark, scratch):
    root = scratch("stream")
    paths, topic = S.StreamPaths(root), f"{root}/topic"
    _drop(spark, topic, [GOOD % 1] + BAD)
    S.run_available(spark, topic_source(spark, topic), paths)
    counts = [(S.read_silver(spark, paths).count(), S.read_dead_letters(spark, paths).count())]
    _drop(spark, topic, [GOOD % 2])
    S.run_available(spark, topic_source(spark, topic), paths)
    counts.append((S.read_silver(spark, paths).count(), S.read_dead_letters(spark, paths).count()))
    S.run_available(spark, topic_source(spark, topic), paths)
    counts.append((S.read_silver(spark, paths).count(), S.read_dead_letters(spark, paths).count()))
    assert counts == [(1, 3), (2, 3), (2, 3)]
    row = S.read_silver(spark, paths).where(F.col("event_id") == 1).first()
    assert row.gravity_g == 0.5 / 9.80665 and row.processed_at is not None


def test_replayed_batch_overwrites_itself(spark, scratch):
    paths = S.StreamPaths(scratch("replay"))
    batch = parse_contract(spark.createDataFrame([(GOOD % 1,), ("junk",)], "value string"))
    write = S.micro_batch_writer(paths)
    write(batch, 0)
    write(batch, 0)
    assert S.read_silver(spark, paths).count() == 1
    assert S.read_dead_letters(spark, paths).count() == 1


def test_time_only_and_year_only_texts_are_rejected(spark):
    texts = ["12:30", "2024", "2024-05", "2024-05-01", "2024-13-01T00:00:00Z", "2024-05-01T10:00:00Z",
             "2024-05-01 10:00", "2024-05-01T10:00:00.5+02:00"]
    lines = [('{"id": 1, "vessel_id": "V", "raw_force_reading": 1.0, "location_id": "L", "event_time": "%s"}' % t,)
             for t in texts]
    got = {r.event_time: r.reject_reason for r in parse_contract(spark.createDataFrame(lines, "value string")).collect()}
    assert [t for t in texts if got[t] is None] == texts[-3:]
    assert {got[t] for t in texts[:5]} == {"bad_event_time"}


def test_new_checkpoint_on_an_old_sink_keeps_its_rows(spark, scratch):
    root = scratch("two")
    for name, ids in (("a", (1, 2, 3)), ("b", (4,))):
        _drop(spark, f"{root}/topic-{name}", [GOOD % i for i in ids])
        S.run_available(spark, topic_source(spark, f"{root}/topic-{name}"), S.StreamPaths(root, f"_checkpoint-{name}"))
    assert sorted(r.event_id for r in S.read_silver(spark, S.StreamPaths(root)).collect()) == [1, 2, 3, 4]
    assert S.read_bronze(spark, S.StreamPaths(root)).count() == 4


def test_long_running_query_picks_up_new_deliveries(spark, scratch):
    root = scratch("live")
    paths, topic = S.StreamPaths(root), f"{root}/topic"
    _drop(spark, topic, [GOOD % 1])
    q = S.start_silver(spark, topic_source(spark, topic), paths,
                       trigger={"processingTime": "1 second"}, query_name="live_silver_test")
    try:
        q.processAllAvailable()
        assert S.read_silver(spark, paths).count() == 1
        _drop(spark, topic, [GOOD % 2, GOOD % 3, "junk"])
        q.processAllAvailable()
        assert S.read_silver(spark, paths).count() == 3
        assert S.read_dead_letters(spark, paths).count() == 1
        assert q.isActive and q.exception() is None
    finally:
        q.stop()
    # restarted from the same checkpoint: nothing is replayed
    S.run_available(spark, topic_source(spark, topic), paths)
    assert S.read_silver(spark, paths).count() == 3


def test_empty_dead_letter_table_reads_as_empty(spark, scratch):
    root = scratch("clean")
    paths, topic = S.StreamPaths(root), f"{root}/topic"
    _drop(spark, topic, [GOOD % 1])
    S.run_available(spark, topic_source(spark, topic), paths)
    assert S.read_dead_letters(spark, paths).count() == 0
    assert S.read_silver(spark, paths).count() == 1


def test_topic_payloads_follow_the_contract(spark):
    import json

    from tessera.sources import bindings
    msgs = [json.loads(r.value) for r in
            bindings.stream_messages(spark, "/root/testdata/sf0.001").limit(50).collect()]
    assert msgs
    for m in msgs:
        assert set(m) == {"id", "vessel_id", "raw_force_reading", "location_id", "event_time"}
        assert isinstance(m["id"], int) and isinstance(m["raw_force_reading"], float)
        assert m["event_time"].endswith("Z") and "T" in m["event_time"]
    parsed = parse_contract(bindings.stream_messages(spark, "/root/testdata/sf0.001"),
                            bindings.STREAM_RECORD)
    assert parsed.where(F.col("reject_reason").isNotNull()).count() == 0
