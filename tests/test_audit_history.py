import pytest
from pyspark.sql import functions as F

from tessera.operators.audit_history import AuditHistory, StoredModel
from tessera.operators.quality import Check, ModelChecks, run_checks
from tessera.sources import fs

SPEC = ModelChecks("m", [Check("unique", ("k", "mode")), Check("not_null", "v"), Check("between", "v", low=0, high=50), Check("min_rows", min_rows=10)])


def write(spark, path, rows):
    (spark.createDataFrame(rows, "k long, mode string, v double, day string").withColumn("day", F.col("day").cast("date"))
     .coalesce(1).write.mode("append").partitionBy("day").parquet(path))


def same(run, spark, path, spec=SPEC):
    full = sorted(tuple(r) for r in run_checks(spark.read.parquet(path), spec).collect())
    assert sorted(tuple(r) for r in run.results.collect()) == full


def day(n, ks, v=1.0):
    return [(k, "batch", v, f"2024-01-{n:02d}") for k in ks]


def test_only_changed_days_and_buckets_are_read(spark, scratch):
    root = scratch("audit")
    path, model = f"{root}/t", None
    for n in range(1, 6):
        write(spark, path, day(n, range(100 * n, 100 * n + 20)))
    model = StoredModel(path, spark.read.parquet(path).schema, "day")
    history = AuditHistory(spark, f"{root}/h", key_span=100)
    run = history.run({"m": model}, [SPEC])
    assert run.days_read["m"] == [f"2024-01-{n:02d}" for n in range(1, 6)]
    same(run, spark, path)
    run = history.run({"m": model}, [SPEC])
    assert run.days_read["m"] == [] and run.days_compared["m"] == [] and history.table.version == 1
    same(run, spark, path)
    write(spark, path, day(6, range(600, 630), 99.0) + [(7, "batch", None, "2024-01-06")])   # a new day
    run = history.run({"m": model}, [SPEC])
    assert run.days_read["m"] == ["2024-01-06"] and run.days_compared["m"] == ["2024-01-06"]
    same(run, spark, path)
    write(spark, path, day(7, [305, 306, 700]))                       # keys that an older day has
    run = history.run({"m": model}, [SPEC])
    assert run.days_read["m"] == ["2024-01-07"] and run.days_compared["m"] == ["2024-01-03", "2024-01-07"]
    same(run, spark, path)
    assert {r.check_name: r.observed for r in run.results.collect()}["unique"] == 2
    write(spark, path, day(3, [399]))                                 # late rows of an old day
    run = history.run({"m": model}, [SPEC])
    assert run.days_read["m"] == ["2024-01-03"]
    same(run, spark, path)
    fs.delete(spark, f"{path}/day=2024-01-07")                        # a day is dropped: its duplicates go
    run = history.run({"m": model}, [SPEC])
    assert run.days_read["m"] == [] and run.days_compared["m"] == ["2024-01-03"]
    same(run, spark, path)
    assert {r.check_name: r.observed for r in run.results.collect()}["unique"] == 0
    assert {r.check_name: r.observed for r in history.results([SPEC], version=3).collect()}["unique"] == 2   # an older audit


@pytest.mark.parametrize("key", [("mode", "k"), "k"])
def test_text_keys_null_keys_and_unpartitioned_tables(spark, scratch, key):
    root = scratch("plain")
    spec = ModelChecks("m", [Check("unique", key), Check("not_null", "k")])
    spark.createDataFrame([(1, "a"), (1, "a"), (None, "a"), (None, "a"), (2, None), (2, None), (3, "c")], "k long, mode string").write.parquet(f"{root}/t")
    model = StoredModel(f"{root}/t", spark.read.parquet(f"{root}/t").schema)
    history = AuditHistory(spark, f"{root}/h")
    for _ in range(2):
        same(history.run({"m": model}, [spec]), spark, f"{root}/t", spec)
    spark.createDataFrame([(3, "c")], "k long, mode string").write.mode("append").parquet(f"{root}/t")
    run = history.run({"m": model}, [spec])
    assert run.days_read["m"] == ["*"]
    same(run, spark, f"{root}/t", spec)


def test_an_empty_table(spark, scratch):
    root = scratch("none")
    spark.createDataFrame([], "k long, mode string, v double").write.parquet(f"{root}/t")
    run = AuditHistory(spark, f"{root}/h").run({"m": StoredModel(f"{root}/t", spark.read.parquet(f"{root}/t").schema)}, [SPEC])
    assert {(r.check_name, r.observed, r.passed) for r in run.results.collect()} == {
        ("unique", 0, True), ("not_null", 0, True), ("between", 0, True), ("min_rows", 0, False)}
