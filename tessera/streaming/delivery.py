"""Delivery attempts of rejected records.

A record that breaks the contract is a dead letter of its batch: its first attempt.  Each
redelivery run tries the pending ones again under the contract as it stands then: records
that pass now go to bronze and silver, the others wait for the next run, and after
``MAX_ATTEMPTS`` they are undeliverable for good.

The ledger is a versioned table of the pending records; its version is the run's number,
and it also keeps how far the stream's batches were taken in.  A run writes its sink
partitions first (as query ``redelivery``, batch = run), then commits the ledger, then
makes the partitions visible; a run that stopped in between is completed by the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.schemas import STREAM_RECORD
from tessera.sources.tables import VersionedTable
from tessera.streaming import sink
from tessera.streaming.bronze import parse_contract
from tessera.streaming.silver import DEAD_LETTER_SCHEMA, StreamPaths, write_valid

#: Fixed value: attempts before a record is given up.
MAX_ATTEMPTS = 5
REDELIVERY = "redelivery"
LEDGER = T.StructType([T.StructField("value", T.StringType()), T.StructField("reject_reason", T.StringType()),
                       T.StructField("attempts", T.IntegerType())])
UNDELIVERABLE = T.StructType([*LEDGER.fields, T.StructField(sink.QUERY_COL, T.StringType()),
                              T.StructField(sink.BATCH_COL, T.LongType())])


def ledger(spark: SparkSession, paths: StreamPaths) -> VersionedTable:
    return VersionedTable(spark, f"{paths.root}/delivery")


def undeliverable_path(paths: StreamPaths) -> str:
    return f"{paths.root}/undeliverable"


def read_undeliverable(spark: SparkSession, paths: StreamPaths) -> DataFrame:
    """Records that failed ``MAX_ATTEMPTS`` times, with the reason of the last attempt."""
    return sink.read_visible(spark, paths.root, undeliverable_path(paths), UNDELIVERABLE)


def pending(spark: SparkSession, paths: StreamPaths) -> DataFrame:
    """Records that wait for another attempt (those the ledger has taken in)."""
    return ledger(spark, paths).read(LEDGER)


def redeliver(spark: SparkSession, paths: StreamPaths, record: T.StructType = STREAM_RECORD, processed_at=None,
              required: list[str] | None = None, max_attempts: int = MAX_ATTEMPTS) -> int:
    """One attempt for every pending record; returns the run's number.

    ``record`` and ``required`` (fields that must be there, by default all) are the contract
    of today.  Dead letters of batches committed since the last run are taken in first.
    """
    table = ledger(spark, paths)
    run = table.version + 1
    if run > 1 and sink.last_batch(spark, paths.root, REDELIVERY) < run - 1:  # the last run stopped before its rows were shown
        sink.commit_batch(spark, paths.root, REDELIVERY, run - 1)
    taken = {q: int(n) for q, n in (table.marks() or {}).items()}
    last = {q: n for q, n in sink.committed(spark, paths.root).items() if q != REDELIVERY}
    fresh = F.lit(False)
    for query, batch in last.items():
        fresh = fresh | ((F.col(sink.QUERY_COL) == query) & F.col(sink.BATCH_COL).between(taken.get(query, -1) + 1, batch))
    letters = spark.read.schema(DEAD_LETTER_SCHEMA).parquet(paths.dead_letters).where(fresh)
    again = table.read(LEDGER).select("value", "attempts").unionByName(letters.select("value", F.lit(1).alias("attempts")))
    tried = parse_contract(again, record, required=required, keep=["attempts"]).withColumn("attempts", F.col("attempts") + 1)
    tried = tried.persist()
    try:
        own = {sink.QUERY_COL: F.lit(REDELIVERY), sink.BATCH_COL: F.lit(run).cast("long")}
        write_valid(tried.where(F.col("reject_reason").isNull()), paths, own, record, processed_at)
        failed = tried.where(F.col("reject_reason").isNotNull()).select(*LEDGER.fieldNames())
        (failed.where(F.col("attempts") >= max_attempts).withColumns(own).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy(*own).parquet(undeliverable_path(paths)))
        table.commit_rewrite(failed.where(F.col("attempts") < max_attempts), last, run - 1, f"{REDELIVERY}-{run}")
    finally:
        tried.unpersist()
    sink.commit_batch(spark, paths.root, REDELIVERY, run)
    return run
