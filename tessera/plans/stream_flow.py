"""Stream bronze -> silver -> dead letters (P3) over a file-drop topic."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources import bindings, fs
from tessera.sources.tables import materialize_counted
from tessera.streaming import delivery, sink
from tessera.streaming import silver as S
from tessera.streaming.bronze import topic_source

# Two deliveries: the topic's messages up to FIRST_DELIVERY_CUT arrive first,
# the rest later (used by the restart scenario).
FIRST_DELIVERY_CUT = "2024-01-16 00:00:00"
# One message in LATE_SHARE misses the restart scenario's delivery of its day and arrives
# after all others, so that the sink's days have rows of two batches.
LATE_SHARE = 4


def drop_messages(spark: SparkSession, sf_dir: str, folder: str,
                  where: F.Column | None = None) -> None:
    """Publish topic messages (one JSON record per line) into a drop folder."""
    rec = bindings.raw_telemetry(spark, sf_dir)
    if where is not None:
        rec = rec.where(where)
    msgs = bindings.stream_records_from(rec)
    msgs.select(F.to_json(F.struct(*msgs.columns)).alias("value")).write.mode("append").text(folder)


def faulty_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The topic's messages, four in seven spoilt in a way of their own: a field left
    out, a text for a number, a time without a date, no JSON at all."""
    rec = bindings.stream_records(spark, sf_dir)
    way = F.col("id") % 7
    whole = F.to_json(F.struct(*rec.columns))
    value = (F.when(way == 0, F.to_json(F.struct(*[c for c in rec.columns if c != "location_id"])))
             .when(way == 1, F.to_json(F.struct(*[F.lit("x").alias(c) if c == "raw_force_reading" else F.col(c)
                                                  for c in rec.columns])))
             .when(way == 2, F.to_json(F.struct(*[F.lit("12:30").alias(c) if c == "event_time" else F.col(c)
                                                  for c in rec.columns])))
             .when(way == 3, F.concat(F.lit("junk "), F.col("id").cast("string"))).otherwise(whole))
    return rec.select(value.alias("value"))


def run_faulty(spark: SparkSession, sf_dir: str, root: str) -> S.StreamPaths:
    paths = S.StreamPaths(root)
    topic = f"{root}/topic"
    faulty_messages(spark, sf_dir).write.mode("append").text(topic)
    S.run_available(spark, topic_source(spark, topic), paths, record=bindings.STREAM_RECORD)
    return paths


def run_stream(spark: SparkSession, sf_dir: str, root: str, processed_at=None) -> S.StreamPaths:
    paths = S.StreamPaths(root)
    topic = f"{root}/topic"
    drop_messages(spark, sf_dir, topic)
    S.run_available(spark, topic_source(spark, topic), paths, processed_at, record=bindings.STREAM_RECORD)
    return paths


def run_with_restart(spark: SparkSession, sf_dir: str, root: str) -> S.StreamPaths:
    """Deliver, run, deliver more, restart from the checkpoint, deliver late messages of all
    days (and those without a time), restart, run an idle last time that commits no batch."""
    paths = S.StreamPaths(root)
    topic = f"{root}/topic"
    time = F.col("event_time")
    first = time < F.lit(FIRST_DELIVERY_CUT).cast("timestamp_ntz")
    late = F.pmod(F.xxhash64("id", "event_time"), F.lit(LATE_SHARE)) == 0
    for part in (first & ~late, ~first & ~late, late | time.isNull()):
        drop_messages(spark, sf_dir, topic, part)
        S.run_available(spark, topic_source(spark, topic), paths, record=bindings.STREAM_RECORD)
    done = sink.committed(spark, paths.root)
    S.run_available(spark, topic_source(spark, topic), paths, record=bindings.STREAM_RECORD)
    if (now := sink.committed(spark, paths.root)) != done:
        raise RuntimeError(f"{root}: a run without new messages took the sink from batches {done} to {now}")
    return paths


def run_with_new_checkpoint(spark: SparkSession, sf_dir: str, root: str) -> S.StreamPaths:
    """Half of the topic with one checkpoint, then the other half as a new topic with
    a fresh checkpoint on the same sink: the second query adds to the first one's rows."""
    cut = F.lit(FIRST_DELIVERY_CUT).cast("timestamp_ntz")
    paths = S.StreamPaths(root)
    for name, part in (("a", F.col("event_time") < cut), ("b", F.col("event_time") >= cut)):
        topic = f"{root}/topic-{name}"
        drop_messages(spark, sf_dir, topic, part)
        own = S.StreamPaths(root, checkpoint_name=f"_checkpoint-{name}")
        S.run_available(spark, topic_source(spark, topic), own, record=bindings.STREAM_RECORD)
    return paths


def replay_last_batch(spark: SparkSession, topic: str, paths: S.StreamPaths) -> None:
    """Run the query again after the loss of its checkpoint's last commit: Spark hands the
    last batch to the sink once more."""
    commits = f"{paths.checkpoint}/commits"
    fs.delete(spark, f"{commits}/{max(fs.list_files(spark, commits), key=int)}")
    S.run_available(spark, topic_source(spark, topic), paths, record=bindings.STREAM_RECORD)


def run_compacted(spark: SparkSession, sf_dir: str, root: str) -> DataFrame:
    """Sink rows of a restarted query, labelled with the phase that they were read in: before a
    compaction of all days, after it, after the replay of a batch that it holds, and with
    the replaced folders deleted.  Bronze goes through the same phases and must keep a
    record for each of silver's rows."""
    paths = run_with_restart(spark, sf_dir, root)
    seen = []

    def look(phase: str) -> None:
        rows = silver_core(S.read_silver(spark, paths, bindings.STREAM_RECORD))
        rows, n = materialize_counted(rows.select(F.lit(phase).alias("phase"), *rows.columns), f"sink-{phase}")
        if (records := S.read_bronze(spark, paths, bindings.STREAM_RECORD).count()) != n:
            raise RuntimeError(f"{root}, {phase}: {records} records in bronze, {n} rows in silver")
        seen.append(rows)

    look("before")
    S.compact(spark, paths, "9999-12-31", bindings.STREAM_RECORD)
    look("compacted")
    replay_last_batch(spark, f"{root}/topic", paths)
    look("replayed")
    sink.drop_superseded(spark, paths.root, paths.silver, S.DAY_COL)
    sink.drop_superseded(spark, paths.root, paths.bronze, S.ARRIVED_COL)
    look("cleaned")
    return reduce(DataFrame.unionByName, seen)


def run_redelivery(spark: SparkSession, sf_dir: str, root: str) -> S.StreamPaths:
    """The faulty topic, one redelivery under the same contract, then a mended contract that
    does without a location, until nothing is pending."""
    paths = run_faulty(spark, sf_dir, root)
    delivery.redeliver(spark, paths, bindings.STREAM_RECORD)
    mended = [n for n in bindings.STREAM_RECORD.names if n != "location_id"]
    while delivery.redeliver(spark, paths, bindings.STREAM_RECORD, required=mended) < delivery.MAX_ATTEMPTS - 1:
        pass
    return paths


def silver_core(df: DataFrame) -> DataFrame:
    return df.select("event_id", "vessel_id", "location_id", "gravity_g", "observed_at")
