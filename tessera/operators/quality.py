"""Data-quality checks (J1-J4, J7) as aggregates.

Every model is checked in ONE pass: when the model declares a unique key,
rows are first grouped by that key (map-side partial aggregation keeps a hot
key at one row per task) and the per-key partial counts are summed into the
other checks; otherwise a single global aggregate is used.  The result is a
tidy table ``(model, column_name, check_name, observed, passed)``.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RESULT_SCHEMA = T.StructType([
    T.StructField("model", T.StringType(), False),
    T.StructField("column_name", T.StringType(), False),
    T.StructField("check_name", T.StringType(), False),
    T.StructField("observed", T.LongType(), True),
    T.StructField("passed", T.BooleanType(), True),
])


@dataclass(frozen=True)
class Check:
    """``kind`` is one of unique / not_null / between / min_rows / non_negative.

    ``column`` is a column name, or for ``unique`` a tuple of names (a
    composite key); ``severity="warn"`` checks are reported but never gate."""
    kind: str
    column: str | tuple[str, ...] = "*"
    low: float | None = None
    high: float | None = None
    min_rows: int | None = None
    severity: str = "error"

    @property
    def label(self) -> str:
        return ",".join(self.column) if isinstance(self.column, tuple) else self.column


@dataclass
class ModelChecks:
    model: str
    checks: list[Check] = field(default_factory=list)


def _violations(df_col: F.Column, chk: Check) -> F.Column:
    """Predicate that is TRUE for a violating row (NULL counts as passing,
    except for not_null)."""
    if chk.kind == "not_null":
        return df_col.isNull()
    if chk.kind == "between":
        return ~df_col.between(F.lit(chk.low), F.lit(chk.high))
    if chk.kind == "non_negative":
        return df_col < F.lit(0)
    raise ValueError(chk.kind)


def run_checks(df: DataFrame, spec: ModelChecks) -> DataFrame:
    """All checks of one model in one pass; one output row per check."""
    uniques = [c for c in spec.checks if c.kind == "unique"]
    if len(uniques) > 1:
        raise ValueError("one unique key per pass; split the spec")
    rowwise = [c for c in spec.checks if c.kind in ("not_null", "between", "non_negative")]
    metrics: list[tuple[Check, str]] = []

    if uniques:
        key = uniques[0].column
        keys = list(key) if isinstance(key, tuple) else [key]
        parts = [F.count(F.lit(1)).alias("_n")]
        for i, chk in enumerate(rowwise):
            parts.append(F.count_if(_violations(F.col(chk.column), chk)).alias(f"_v{i}"))
        per_key = df.groupBy(*keys).agg(*parts)
        key_present = F.lit(True)
        for k in keys:
            key_present = key_present & F.col(k).isNotNull()
        finals = [F.sum("_n").alias("_rows"),
                  F.count_if(key_present & (F.col("_n") > 1)).alias("_dups")]
        finals += [F.sum(f"_v{i}").alias(f"_v{i}") for i in range(len(rowwise))]
        agg = per_key.agg(*finals)
        metrics.append((uniques[0], "_dups"))
    else:
        parts = [F.count(F.lit(1)).alias("_rows")]
        for i, chk in enumerate(rowwise):
            parts.append(F.count_if(_violations(F.col(chk.column), chk)).alias(f"_v{i}"))
        agg = df.agg(*parts)
    metrics += [(chk, f"_v{i}") for i, chk in enumerate(rowwise)]

    rows = []
    for chk, metric in metrics:
        observed = F.coalesce(F.col(metric).cast("long"), F.lit(0).cast("long"))
        rows.append(F.struct(F.lit(chk.label).alias("column_name"),
                             F.lit(chk.kind).alias("check_name"),
                             observed.alias("observed"),
                             (observed == 0).alias("passed")))
    for chk in (c for c in spec.checks if c.kind == "min_rows"):
        observed = F.coalesce(F.col("_rows").cast("long"), F.lit(0).cast("long"))
        rows.append(F.struct(F.lit("*").alias("column_name"),
                             F.lit(chk.kind).alias("check_name"),
                             observed.alias("observed"),
                             (observed >= F.lit(chk.min_rows)).alias("passed")))
    if not rows:  # a model declared without checks has nothing to report
        return df.sparkSession.createDataFrame([], RESULT_SCHEMA)
    return (agg.select(F.explode(F.array(*rows)).alias("r"))
            .select(F.lit(spec.model).alias("model"), "r.column_name", "r.check_name",
                    "r.observed", "r.passed"))


def audit(models: dict[str, DataFrame], suite: list[ModelChecks],
          max_parallel: int = 8) -> DataFrame:
    """The whole suite as one result table.

    Each model's one-pass check job runs on its own (up to ``max_parallel``
    submitted concurrently from the driver, so small models overlap instead of
    queueing); what comes back is one row per declared check — bounded by the
    suite, not by the data — and is returned as a DataFrame.
    """
    specs = [s for s in suite if s.model in models]
    if not specs:
        raise ValueError("no model of the suite was given")
    spark = models[specs[0].model].sparkSession

    def one(spec: ModelChecks):
        return run_checks(models[spec.model], spec).collect()

    job = inheritable_thread_target(spark)(one)
    with ThreadPoolExecutor(max_workers=max(1, min(max_parallel, len(specs)))) as pool:
        results = list(pool.map(job, specs))
    rows = [tuple(r) for res in results for r in res]
    return spark.createDataFrame(rows, RESULT_SCHEMA)


def audit_plan(models: dict[str, DataFrame], suite: list[ModelChecks]) -> DataFrame:
    """Lazy variant of :func:`audit`: one UNION ALL plan, nothing runs until an action."""
    out = None
    for spec in suite:
        if spec.model in models:
            res = run_checks(models[spec.model], spec)
            out = res if out is None else out.unionByName(res)
    if out is None:
        raise ValueError("no model of the suite was given")
    return out


def gate(results: DataFrame, suite: list[ModelChecks]) -> None:
    """Raise when an error-severity check failed (warn-severity ones only report)."""
    severity = {(s.model, c.label, c.kind): c.severity for s in suite for c in s.checks}
    failed = [r for r in results.where(~F.col("passed")).collect()
              if severity.get((r.model, r.column_name, r.check_name), "error") == "error"]
    if failed:
        raise AssertionError("quality gate failed: " + "; ".join(
            f"{r.model}.{r.column_name} {r.check_name} observed={r.observed}" for r in failed))


def duplicate_keys(df: DataFrame, key: str | tuple[str, ...]) -> DataFrame:
    """D4 failing rows: each non-NULL key held by more than one row, with its count."""
    keys = list(key) if isinstance(key, tuple) else [key]
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return (df.where(cond).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
            .where(F.col("n_rows") > 1))


def null_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """J2 over every column in one aggregate: ``(column_name, null_rows)``."""
    cols = columns or df.columns
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    pairs = [F.struct(F.lit(c).alias("column_name"), F.col(c).cast("long").alias("null_rows"))
             for c in cols]
    return agg.select(F.explode(F.array(*pairs)).alias("r")).select("r.*")
