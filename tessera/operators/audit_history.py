"""Incremental audit of stored, day-partitioned tables.

The checks of a model are sums over its days, except uniqueness, which compares keys of
all days.  The history keeps, as one versioned table,

* ``state`` rows: per day its fingerprint (names, sizes and times of its files), its rows
  and the violations of each row-wise check;
* ``keys`` rows: per day and key bucket the rows it has there;
* ``dups`` rows: per key bucket the keys that occur more than once.

An audit lists the days' files, reads the days whose fingerprint changed, and nothing else
if there are no unique checks.  Key buckets that a changed day has, or had, are compared
again: their keys are read from the days that have rows in them.  Buckets of integer keys
are ranges, so that ids which grow with time touch few of them and the comparison reaches
the scan as a range predicate; other keys are dealt by hash.  The result is that of a full
audit, and each version of the history tells which days an audit read.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.quality import RESULT_SCHEMA, ModelChecks, _violations
from tessera.sources import fs
from tessera.sources.tables import VersionedTable, materialize

#: Integer keys in a bucket; buckets of other keys.
KEY_SPAN, HASH_BUCKETS = 1 << 20, 64
#: Day of a table that is not partitioned.
WHOLE = "*"
HISTORY = T.StructType([T.StructField("model", T.StringType()), T.StructField("kind", T.StringType()),
                        T.StructField("day", T.StringType()), T.StructField("bucket", T.LongType()),
                        T.StructField("metric", T.StringType()), T.StructField("value", T.LongType()),
                        T.StructField("fingerprint", T.StringType())])


@dataclass
class StoredModel:
    """A stored table: its path, schema, day column (none: audited as a whole) and, for a stream
    sink, the predicate of its visible folders."""

    path: str
    schema: T.StructType
    day_col: str | None = None
    where: Column | None = None


@dataclass
class AuditRun:
    results: DataFrame
    days_read: dict[str, list[str]] = field(default_factory=dict)
    days_compared: dict[str, list[str]] = field(default_factory=dict)


def _days(spark: SparkSession, m: StoredModel) -> dict[str, str]:
    """Fingerprint of every day's files, from listings alone."""
    if m.day_col is None:
        return {WHOLE: fs.fingerprint(spark, m.path)}
    visible = "" if m.where is None else str(m.where)
    return {d: fs.fingerprint(spark, f"{m.path}/{m.day_col}={d}") + visible for d in fs.list_partition_values(spark, m.path, m.day_col)}


def _read(spark: SparkSession, m: StoredModel, days: list[str]) -> DataFrame:
    """Rows of some days, by their folders, with ``_day``."""
    if m.day_col is None:
        df, day = spark.read.schema(m.schema).parquet(m.path), F.lit(WHOLE)
    else:
        df = spark.read.schema(m.schema).option("basePath", m.path).parquet(*[f"{m.path}/{m.day_col}={d}" for d in days])
        day = F.col(m.day_col).cast("string")
    if m.where is not None:
        df = df.where(m.where)
    return df.withColumn("_day", F.coalesce(day, F.lit("__HIVE_DEFAULT_PARTITION__")))


def _bucket(schema: T.StructType, keys: list[str], span: int) -> Column:
    if isinstance(schema[keys[0]].dataType, T.IntegralType):
        return F.floor(F.col(keys[0]) / F.lit(span)).cast("long")
    return F.pmod(F.xxhash64(*keys), F.lit(HASH_BUCKETS)).cast("long")


def _rows(df: DataFrame, model: str, kind: str, **columns: Column) -> DataFrame:
    given = {"model": F.lit(model), "kind": F.lit(kind)} | columns
    return df.select(*[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in HISTORY])


class AuditHistory:
    """Audits against the history at ``root``; ``key_span`` is fixed when the history begins."""

    def __init__(self, spark: SparkSession, root: str, key_span: int = KEY_SPAN):
        self.spark, self.table, self.span = spark, VersionedTable(spark, root), key_span

    def run(self, models: dict[str, StoredModel], suite: list[ModelChecks]) -> AuditRun:
        """Audit the given models and commit their new states."""
        base = self.table.version
        old = self.table.read(HISTORY)
        specs = [s for s in suite if s.model in models]
        done, parts = AuditRun(None), [old.where(~F.col("model").isin(*[s.model for s in specs]))] if base else []
        for spec in specs:
            parts.append(self._model(models[spec.model], spec, old.where(F.col("model") == spec.model), done))
        if any(done.days_read.values()) or any(done.days_compared.values()) or not base:
            self.table.commit_rewrite(reduce(DataFrame.unionByName, parts), None, base)
        done.results = self.results(specs)
        return done

    def _model(self, m: StoredModel, spec: ModelChecks, old: DataFrame, done: AuditRun) -> DataFrame:
        spark, now = self.spark, _days(self.spark, m)
        before = {r.day: r.fingerprint for r in old.where("kind = 'state' AND metric = 'rows'").select("day", "fingerprint").collect()}
        changed = sorted(d for d, f in now.items() if before.get(d) != f)
        gone = sorted(set(before) - set(now))
        done.days_read[spec.model], done.days_compared[spec.model] = changed, []
        if not changed and not gone:
            return old
        stale = [*changed, *gone]
        kept = old.where((F.col("kind") != "dups") & ~F.col("day").isin(*stale))
        rowwise = [c for c in spec.checks if c.kind in ("not_null", "between", "non_negative")]
        unique = next((c for c in spec.checks if c.kind == "unique"), None)
        out = [kept]
        if changed:
            counts = [F.count(F.lit(1)).alias("rows")] + [F.count_if(_violations(F.col(c.column), c)).alias(f"v{i}") for i, c in enumerate(rowwise)]
            per_day = _read(spark, m, changed).groupBy("_day").agg(*counts)
            known = spark.createDataFrame([(d, now[d]) for d in changed], "_day string, fingerprint string")
            per_day = materialize(F.broadcast(known).join(per_day, "_day", "left").fillna(0), "audit-days")
            out += [_rows(per_day, spec.model, "state", day=F.col("_day"), metric=F.lit(c), value=F.col(c), fingerprint=F.col("fingerprint"))
                    for c in per_day.columns if c not in ("_day", "fingerprint")]
        if unique is not None:
            out += self._unique(m, spec.model, unique.column, old, kept, changed, stale, done)
        return reduce(DataFrame.unionByName, out)

    def _unique(self, m: StoredModel, model: str, column, old: DataFrame, kept: DataFrame, changed: list[str],
                stale: list[str], done: AuditRun) -> list[DataFrame]:
        keys = list(column) if isinstance(column, tuple) else [column]
        bucket = _bucket(m.schema, keys, self.span)
        there = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
        new = self.spark.createDataFrame([], HISTORY)
        if changed:
            new = _rows(_read(self.spark, m, changed).where(there).groupBy("_day", bucket.alias("b")).agg(F.count("*").alias("n")),
                        model, "keys", day=F.col("_day"), bucket=F.col("b"), metric=F.lit("rows"), value=F.col("n"))
        new = materialize(new, "audit-keys")
        touched = materialize(new.select("bucket").union(
            old.where((F.col("kind") == "keys") & F.col("day").isin(*stale)).select("bucket")).distinct(), "audit-touched")
        have = kept.where("kind = 'keys'").unionByName(new)
        days = [r.day for r in have.join(touched, "bucket", "left_semi").select("day").distinct().collect()]
        done.days_compared[model] = sorted(days)
        dups = self.spark.createDataFrame([], HISTORY)
        if days:
            rows = _read(self.spark, m, days).where(there)
            if isinstance(m.schema[keys[0]].dataType, T.IntegralType):  # reaches the scan
                lo, hi = touched.agg(F.min("bucket"), F.max("bucket")).first()
                rows = rows.where((F.col(keys[0]) >= lo * self.span) & (F.col(keys[0]) < (hi + 1) * self.span))
            twice = (rows.withColumn("bucket", bucket).join(touched, "bucket", "left_semi")
                     .groupBy("bucket", *keys).agg(F.count("*").alias("n")).where("n > 1").groupBy("bucket").agg(F.count("*").alias("n")))
            dups = _rows(twice, model, "dups", bucket=F.col("bucket"), metric=F.lit("keys"), value=F.col("n"))
        others = old.where("kind = 'dups'").join(touched, "bucket", "left_anti").select(*HISTORY.names)
        return [new, dups, others]

    def results(self, specs: list[ModelChecks], version: int | None = None) -> DataFrame:
        """The audit's result rows from the states alone, of the newest or an older audit."""
        found = {(r.model, r.kind, r.metric): r.value for r in
                 (self.table.read(HISTORY, version).where("kind <> 'keys'").groupBy("model", "kind", "metric")
                  .agg(F.sum("value").alias("value")).collect())}
        rows = []
        for spec in specs:
            rowwise = [c for c in spec.checks if c.kind in ("not_null", "between", "non_negative")]
            for c in spec.checks:
                if c.kind == "unique":
                    n = found.get((spec.model, "dups", "keys")) or 0
                elif c.kind == "min_rows":
                    n = found.get((spec.model, "state", "rows")) or 0
                else:
                    n = found.get((spec.model, "state", f"v{rowwise.index(c)}")) or 0
                rows.append((spec.model, "*" if c.kind == "min_rows" else c.label, c.kind, n, n >= c.min_rows if c.kind == "min_rows" else n == 0))
        return self.spark.createDataFrame(rows, RESULT_SCHEMA)
