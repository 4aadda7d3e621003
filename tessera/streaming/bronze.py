"""Topic source and message contract."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.temporal import parse_iso_timestamp
from tessera.schemas import STREAM_RECORD

CORRUPT_COL = "_corrupt"


def kafka_available(spark: SparkSession) -> bool:
    try:
        spark.sparkContext._jvm.java.lang.Class.forName(
            "org.apache.spark.sql.kafka010.KafkaSourceProvider")
        return True
    except Exception:  # noqa: BLE001 - connector jar absent
        return False


def topic_source(spark: SparkSession, path: str | None = None, *, kafka: dict | None = None,
                 max_files_per_trigger: int | None = None,
                 max_offsets_per_trigger: int | None = 50_000_000) -> DataFrame:
    """Streaming DataFrame of raw message payloads in a ``value`` column.

    With ``kafka`` options (``kafka.bootstrap.servers``, ``subscribe``) the
    Kafka connector is used from the earliest offset — everything written since
    the topic was created, offsets then owned by the checkpoint; each
    micro-batch is capped at ``max_offsets_per_trigger`` records so a backlog
    is worked off in bounded batches (the rest follows in the next ones; no
    record is skipped).  Otherwise a folder of newline-delimited JSON files is
    the topic (tests, file drops).
    """
    if kafka is not None:
        if not kafka_available(spark):
            raise RuntimeError("the Kafka connector is not on the classpath")
        opts = {"startingOffsets": "earliest", "failOnDataLoss": "true", **kafka}
        if max_offsets_per_trigger:
            opts.setdefault("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
        return (spark.readStream.format("kafka").options(**opts).load()
                .select(F.col("value").cast("string").alias("value")))
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def _parse_schema(record: T.StructType) -> T.StructType:
    fields = [T.StructField(f.name, f.dataType, True) for f in record.fields]
    return T.StructType(fields + [T.StructField(CORRUPT_COL, T.StringType(), True)])


def parse_contract(messages: DataFrame, record: T.StructType = STREAM_RECORD,
                   time_field: str = "event_time", required: list[str] | None = None,
                   keep: list[str] | None = None) -> DataFrame:
    """Parse payloads against the record schema and mark each row valid or
    not, with a reason.  Unknown fields are ignored; every declared field is
    required (or those in ``required``); the event time must parse as ISO-8601.  Works on
    batch and streaming DataFrames alike.  ``keep`` names columns beside ``value`` to carry on."""
    schema = _parse_schema(record)
    keep = keep or []
    parsed = messages.select(
        "value", *keep,
        F.from_json("value", schema, {"mode": "PERMISSIVE",
                                      "columnNameOfCorruptRecord": CORRUPT_COL}).alias("r"))
    names = [f.name for f in record.fields]
    must = names if required is None else [n for n in names if n in required]
    missing = F.array_compact(F.array(*[
        F.when(F.col(f"r.{n}").isNull(), F.lit(n)) for n in must]))
    nothing = F.coalesce(*[F.col(f"r.{n}").cast("string") for n in names]).isNull()
    unreadable = F.col("r").isNull() | (F.col(f"r.{CORRUPT_COL}").isNotNull() & nothing)
    reason = (F.when(unreadable, F.lit("malformed"))
              .when(F.size(missing) > 0, F.concat(F.lit("missing_or_mistyped:"),
                                                  F.array_join(missing, ",")))
              .when(parse_iso_timestamp(F.col(f"r.{time_field}")).isNull(),
                    F.lit("bad_" + time_field)))
    return parsed.select("value", *keep, *[F.col(f"r.{n}").alias(n) for n in names],
                         reason.alias("reject_reason"))


def valid_records(parsed: DataFrame, record: T.StructType = STREAM_RECORD) -> DataFrame:
    return parsed.where(F.col("reject_reason").isNull()).select(*record.fieldNames())


def dead_letters(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("reject_reason").isNotNull()).select("value", "reject_reason")
