"""Frame helpers shared by the operators: safe narrowing and written intermediates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import scratch_path, ship_package


def position(names: list[str], wanted: str) -> int:
    """Index of a column: by its exact name, else by the first that differs in case only."""
    if wanted in names:
        return names.index(wanted)
    lowered = [n.lower() for n in names]
    if wanted.lower() in lowered:
        return lowered.index(wanted.lower())
    raise ValueError(f"column {wanted!r} is missing; the table has {names}")


def tag(df: DataFrame) -> DataFrame:
    """Columns renamed to ``c0 .. cn``; every operator begins here or in ``pick``, so
    here the package is made known to the workers."""
    ship_package(df.sparkSession)
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))])


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """``pick(df, out=name)``: the named columns only, found by position.

    Extra columns may carry any name, also one that differs from a wanted
    column by case only or that an operator uses internally; a plain
    ``select`` would call such a name ambiguous.
    """
    names = df.columns
    tagged = tag(df)
    return tagged.select(*[F.col(f"c{position(names, src)}").alias(out)
                           for out, src in columns.items()])


def written(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Cuts the lineage at a table that every executor can reach: a lost executor
    costs the tasks that ran there, not the steps before this table.
    """
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Ids (8 bytes each) that may be broadcast to pick rows out of a table of texts.
MAX_BROADCAST_IDS = 2_000_000


def rows_of(texts: DataFrame, column: str, ids: DataFrame, how: str = "left_semi") -> DataFrame:
    """Rows of ``texts`` whose ``column`` is (``left_anti``: is not) among ``ids``.

    ``ids`` must be a written one-column table: it is counted first, and up to
    ``MAX_BROADCAST_IDS`` of them are broadcast, so that the texts stay where they
    are.  More ids make it a shuffle join.
    """
    few = ids.count() <= MAX_BROADCAST_IDS
    wanted = ids.toDF("wanted_id")
    return texts.join(F.broadcast(wanted) if few else wanted, F.col(column) == F.col("wanted_id"), how)


def remainder_of_five(doc_id: Column) -> Column:
    """crc32 of the id's decimal text, modulo 5; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5


def held_out(doc_id: Column) -> Column:
    """True for the fifth of all ids whose labels are never learned from."""
    return remainder_of_five(doc_id) == 0
