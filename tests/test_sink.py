import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tessera.sources import fs
from tessera.sources.tables import StaleVersion
from tessera.streaming import delivery, sink
from tessera.streaming import silver as S
from tessera.streaming.bronze import parse_contract, topic_source

LINE = '{"id": %d, "vessel_id": "V1", "raw_force_reading": 0.5, "location_id": "L1", "event_time": "2026-03-%02dT10:00:00Z"}'


def batch(spark, ids, day=18, junk=0):
    return parse_contract(spark.createDataFrame([(LINE % (i, day),) for i in ids] + [(f"junk {i}",) for i in range(junk)], "value string"))


def ids(spark, paths):
    return sorted(r.event_id for r in S.read_silver(spark, paths).collect())


def folders(paths, day):
    found = []
    for root, _, names in os.walk(f"{paths.silver}/{S.DAY_COL}={day}"):
        found += [os.path.relpath(root, paths.silver) for n in names if n.startswith("part-")]
    return found


@pytest.mark.parametrize("stop", ["silver", "dead_letters", "commit"])
def test_a_batch_that_stopped_half_way_is_not_seen_and_then_seen_once(spark, scratch, monkeypatch, stop):
    paths = S.StreamPaths(scratch("half"))
    S.micro_batch_writer(paths)(batch(spark, [1], junk=1), 0)
    real, real_commit = S._overwrite_own_partitions, sink.commit_batch

    def fail(df, path, cols):
        if path.endswith(stop):
            raise RuntimeError("lost")
        real(df, path, cols)

    def no_commit(*a):
        raise RuntimeError("lost")

    monkeypatch.setattr(S, "_overwrite_own_partitions", fail)
    if stop == "commit":
        monkeypatch.setattr(sink, "commit_batch", no_commit)
    with pytest.raises(RuntimeError, match="lost"):
        S.micro_batch_writer(paths)(batch(spark, [2, 3], junk=2), 1)
    monkeypatch.setattr(S, "_overwrite_own_partitions", real)
    monkeypatch.setattr(sink, "commit_batch", real_commit)
    assert os.path.isdir(f"{paths.bronze}")
    seen = (ids(spark, paths), S.read_bronze(spark, paths).count(), S.read_dead_letters(spark, paths).count())
    assert seen == ([1], 1, 1)
    S.micro_batch_writer(paths)(batch(spark, [2, 3], junk=2), 1)
    assert (ids(spark, paths), S.read_bronze(spark, paths).count(), S.read_dead_letters(spark, paths).count()) == ([1, 2, 3], 3, 3)


def test_compaction_streams_its_rows_into_files_without_a_sort(spark, scratch, monkeypatch):
    from pyspark.sql import DataFrameWriter
    writers = "spark.sql.maxConcurrentOutputFileWriters"
    paths, real, seen = S.StreamPaths(scratch("streamed")), DataFrameWriter.parquet, []
    for b in range(2):
        for day in (18, 19):
            S.micro_batch_writer(paths)(batch(spark, [100 * day + b], day), 2 * b + day - 18)

    def write(self, path, *args, **kwargs):
        seen.append(int(spark.conf.get(writers, "0")))           # 0: sorted by folder first
        real(self, path, *args, **kwargs)

    before = spark.conf.get(writers, "0")
    monkeypatch.setattr(DataFrameWriter, "parquet", write)
    S.compact(spark, paths, "9999-12-31")
    assert len(seen) == 2 and min(seen) > 1
    assert spark.conf.get(writers, "0") == before
    assert [len(folders(paths, f"2026-03-{d}/query_id=compacted")) for d in (18, 19)] == [1, 1]
    assert ids(spark, paths) == [1800, 1801, 1900, 1901]


def test_compaction_merges_closed_days_and_late_rows_follow(spark, scratch):
    paths, write = S.StreamPaths(scratch("compact")), None
    write = S.micro_batch_writer(paths)
    for b in range(4):
        write(batch(spark, [10 * b, 10 * b + 1], 18), b)
    write(batch(spark, [99], 20), 4)
    done = S.compact(spark, paths, "2026-03-20")["silver"]
    assert (done.number, done.days, done.files) == (1, ["2026-03-18"], 1)
    assert ids(spark, paths) == [0, 1, 10, 11, 20, 21, 30, 31, 99]
    write(batch(spark, [10, 11], 18), 1)                        # a replay of a batch that was merged
    assert ids(spark, paths) == [0, 1, 10, 11, 20, 21, 30, 31, 99]
    write(batch(spark, [40], 18), 5)                            # late rows of a compacted day
    assert 40 in ids(spark, paths)
    got = S.read_silver(spark, paths)
    read = {r.f for r in got.select(F.col("_metadata.file_path").alias("f")).collect()}
    assert sum(f"{sink.QUERY_COL}={sink.COMPACTED}" in f for f in read) == 1 and not any("batch_id=2/" in f for f in read)
    plan = got._jdf.queryExecution().executedPlan().toString()  # replaced folders are pruned, not read and filtered
    assert "batch_id" in plan[plan.index("PartitionFilters"):].splitlines()[0]
    assert sink.compact(spark, paths.root, paths.silver, S.silver_schema(), S.DAY_COL, "2026-03-20", "event_id").number == 2
    gone = sink.drop_superseded(spark, paths.root, paths.silver, S.DAY_COL)
    assert len(gone) == 6 and len(folders(paths, "2026-03-18")) == 1
    assert ids(spark, paths) == [0, 1, 10, 11, 20, 21, 30, 31, 40, 99]
    assert S.compact(spark, paths, "2026-03-20")["silver"].days == []    # nothing left to merge


def test_a_compaction_that_stops_before_its_pointer_leaves_no_trace(spark, scratch, monkeypatch):
    paths = S.StreamPaths(scratch("stop"))
    for b in range(3):
        S.micro_batch_writer(paths)(batch(spark, [b]), b)
    publish = fs.publish_new
    monkeypatch.setattr(sink.fs, "publish_new", lambda *a: False)
    with pytest.raises(StaleVersion):
        S.compact(spark, paths, "9999-01-01")
    monkeypatch.setattr(sink.fs, "publish_new", publish)
    assert ids(spark, paths) == [0, 1, 2]
    assert sink.drop_superseded(spark, paths.root, paths.silver, S.DAY_COL) == []
    S.micro_batch_writer(paths)(batch(spark, [7]), 3)
    assert S.compact(spark, paths, "9999-01-01")["silver"].number == 1
    assert ids(spark, paths) == [0, 1, 2, 7]


def test_files_are_sized_by_bytes(spark, scratch):
    paths = S.StreamPaths(scratch("sized"))
    for b in range(2):
        S.micro_batch_writer(paths)(batch(spark, range(1000 * b, 1000 * b + 1000)), b)
    size = fs.total_bytes(spark, paths.silver)
    done = S.compact(spark, paths, "9999-01-01", target_bytes=size // 4)["silver"]
    assert 4 <= done.files <= 5 and len(folders(paths, "2026-03-18")) > done.files
    assert len(ids(spark, paths)) == 2000


def test_five_attempts_then_undeliverable(spark, scratch):
    paths = S.StreamPaths(scratch("attempts"))
    S.micro_batch_writer(paths)(batch(spark, [1], junk=2), 0)
    for run in range(1, 4):
        assert delivery.redeliver(spark, paths) == run
        assert {r.attempts for r in delivery.pending(spark, paths).collect()} == {run + 1}
        assert delivery.read_undeliverable(spark, paths).count() == 0
    S.micro_batch_writer(paths)(batch(spark, [2], junk=1), 1)   # a new one joins with its first attempt
    assert delivery.redeliver(spark, paths) == 4
    dead = delivery.read_undeliverable(spark, paths).collect()
    assert [r.attempts for r in dead] == [5, 5]
    assert [r.attempts for r in delivery.pending(spark, paths).collect()] == [2]
    assert ids(spark, paths) == [1, 2]


def test_a_mended_contract_rescues_once(spark, scratch, monkeypatch):
    paths = S.StreamPaths(scratch("rescue"))
    bad = parse_contract(spark.createDataFrame([('{"id": 5, "vessel_id": "V", "raw_force_reading": 1.0, "event_time": "2026-03-18T10:00:00Z"}',),
                                                ("junk",)], "value string"))
    S.micro_batch_writer(paths)(bad, 0)
    commit = sink.commit_batch
    monkeypatch.setattr(sink, "commit_batch", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    names = ["id", "vessel_id", "raw_force_reading", "event_time"]
    with pytest.raises(RuntimeError):
        delivery.redeliver(spark, paths, required=names)
    monkeypatch.setattr(sink, "commit_batch", commit)
    assert ids(spark, paths) == []                              # written, not yet shown
    delivery.redeliver(spark, paths, required=names)
    rows = S.read_silver(spark, paths).collect()
    assert [(r.event_id, r.location_id) for r in rows] == [(5, None)]
    assert [r.attempts for r in delivery.pending(spark, paths).collect()] == [3]


def test_a_streaming_query_replays_a_merged_batch(spark, scratch):
    from tessera.plans.stream_flow import replay_last_batch
    root = scratch("replayed")
    paths, topic = S.StreamPaths(root), f"{root}/topic"
    for i in (1, 2):
        spark.createDataFrame([(LINE % (i, 18),)], "value string").coalesce(1).write.mode("append").text(topic)
        S.run_available(spark, topic_source(spark, topic), paths)
    S.compact(spark, paths, "9999-01-01")
    from tessera.sources import bindings
    record, bindings.STREAM_RECORD = bindings.STREAM_RECORD, S.STREAM_RECORD
    try:
        replay_last_batch(spark, topic, paths)
    finally:
        bindings.STREAM_RECORD = record
    assert ids(spark, paths) == [1, 2]
    assert S.read_silver(spark, paths).where(F.col(sink.QUERY_COL) == sink.COMPACTED).count() == 2


def events(spark, folder, days=(14, 15, 16, 17), each=30):
    """Events around the first delivery's cut, one of them twice, one without a time."""
    from tessera.sources import bindings
    rows = [(100 * d + i, dt.datetime(2024, 1, d, i % 24, i), i, "view", 1.0, "{}") for d in days for i in range(each)]
    rows += [rows[0], (1, None, 1, "view", 1.0, "{}")]
    spark.createDataFrame(rows, bindings.SOURCE_SCHEMAS["events"]).write.parquet(f"{folder}/events.parquet")
    return sorted(r[0] for r in rows if r[1])


def test_the_restarted_flow_compacts_all_days_and_replays_a_merged_batch(spark, scratch, monkeypatch):
    from tessera.plans import stream_flow as flow
    root, days = scratch("flow"), [f"2024-01-{d}" for d in (14, 15, 16, 17)]
    data = scratch("events")
    want = events(spark, data)
    paths, done, dropped, shown = S.StreamPaths(root), {}, {}, []
    compact, drop, replay = S.compact, sink.drop_superseded, flow.replay_last_batch

    def replayed(spark, topic, paths):
        taken = sink._state(spark, paths.silver)[1]
        last = sink.committed(spark, paths.root)
        shown.extend(taken[d]["upto"] == last for d in days)    # the batch that comes again is in every merged day
        replay(spark, topic, paths)

    monkeypatch.setattr(S, "compact", lambda *a: done.update(compact(*a)))
    monkeypatch.setattr(sink, "drop_superseded", lambda *a: dropped.update({a[2]: drop(*a)}))
    monkeypatch.setattr(flow, "replay_last_batch", replayed)
    rows = flow.run_compacted(spark, data, root).collect()
    for phase in ("before", "compacted", "replayed", "cleaned"):
        assert sorted(r.event_id for r in rows if r.phase == phase) == want
    assert (done["silver"].days, len(done["bronze"].days)) == (days, 1) and shown == [True] * 4
    assert [sum(f.startswith(d) for f in dropped[paths.silver]) for d in days] == [2] * 4   # late rows beside each day's own
    assert len(dropped[paths.bronze]) == 3
    for d in days:
        assert {f.split("/")[1] for f in folders(paths, d)} == {f"{sink.QUERY_COL}={sink.COMPACTED}"}
    assert S.read_bronze(spark, paths).count() == len(want)
    assert S.read_dead_letters(spark, paths).count() == 1       # the one without a time was delivered


def test_an_idle_run_that_commits_stops_the_restarted_flow(spark, scratch, monkeypatch):
    from tessera.plans import stream_flow as flow
    root, data, runs, real = scratch("idle"), scratch("events"), [], S.run_available
    events(spark, data, days=(15, 16), each=8)

    def run(spark, messages, paths, **kwargs):
        real(spark, messages, paths, **kwargs)
        runs.append(sink.committed(spark, paths.root))
        if len(runs) == 4:
            sink.commit_batch(spark, paths.root, *[(q, n + 1) for q, n in runs[-1].items()][0])

    monkeypatch.setattr(S, "run_available", run)
    with pytest.raises(RuntimeError, match="without new messages"):
        flow.run_with_restart(spark, data, root)
    assert [list(r.values()) for r in runs] == [[0], [1], [2], [2]]


def test_the_compacted_flow_stops_if_bronze_loses_records(spark, scratch, monkeypatch):
    from tessera.plans import stream_flow as flow
    root, data, compact = scratch("lost"), scratch("events"), S.compact
    events(spark, data, days=(15, 16), each=8)

    def lose(spark, paths, *args):
        compact(spark, paths, *args)
        for day in fs.list_partition_values(spark, paths.bronze, S.ARRIVED_COL):
            fs.delete(spark, f"{paths.bronze}/{S.ARRIVED_COL}={day}")

    monkeypatch.setattr(S, "compact", lose)
    with pytest.raises(RuntimeError, match="compacted: 0 records in bronze, 17 rows in silver"):
        flow.run_compacted(spark, data, root)


def test_the_view_lasts_and_follows_the_flow(spark, scratch):
    paths = S.StreamPaths(scratch("view"))
    write, columns = S.micro_batch_writer(paths), ["event_id", "gravity_g"]
    for b in range(3):
        write(batch(spark, [b]), b)
    S.publish_view(spark, paths, "sink_view", columns)
    other = spark.newSession()                                  # not a temporary view of one session
    assert sorted(r.event_id for r in other.table("sink_view").collect()) == [0, 1, 2]
    write(batch(spark, [3]), 3)
    S.compact(spark, paths, "9999-01-01")
    S.publish_view(spark, paths, "sink_view", columns)
    assert sorted(r.event_id for r in other.table("sink_view").collect()) == [0, 1, 2, 3]
    assert other.table("sink_view").columns == columns
    spark.sql("DROP VIEW sink_view")
    spark.sql("DROP TABLE sink_view_sink")
    assert ids(spark, paths) == [0, 1, 2, 3]
