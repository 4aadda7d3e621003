import pytest

from tessera.operators.quality import Check, ModelChecks, audit, duplicate_keys, gate, run_checks


def test_one_pass_checks(spark):
    df = spark.createDataFrame([(1, 0.5), (1, 3.0), (2, None), (None, -5.0)], "k long, g double")
    spec = ModelChecks("m", [Check("unique", "k"), Check("not_null", "k"),
                             Check("between", "g", low=-1, high=2), Check("min_rows", min_rows=3),
                             Check("non_negative", "g")])
    got = {(r.column_name, r.check_name): (r.observed, r.passed) for r in run_checks(df, spec).collect()}
    assert got == {("k", "unique"): (1, False), ("k", "not_null"): (1, False),
                   ("g", "between"): (2, False), ("*", "min_rows"): (4, True),
                   ("g", "non_negative"): (1, False)}


def test_composite_unique_key(spark):
    df = spark.createDataFrame([(1, "batch"), (1, "stream"), (1, "stream")], "e long, m string")
    assert duplicate_keys(df, ("e", "m")).count() == 1
    res = run_checks(df, ModelChecks("f", [Check("unique", ("e", "m"))])).first()
    assert (res.column_name, res.observed) == ("e,m", 1)


def test_gate_ignores_warnings(spark):
    df = spark.createDataFrame([(1, None)], "k long, r long")
    suite = [ModelChecks("f", [Check("not_null", "k"), Check("not_null", "r", severity="warn")])]
    gate(audit({"f": df}, suite), suite)
    suite_err = [ModelChecks("f", [Check("not_null", "r")])]
    with pytest.raises(AssertionError):
        gate(audit({"f": df}, suite_err), suite_err)


def test_model_without_checks_reports_nothing(spark):
    df = spark.createDataFrame([(1,)], "k long")
    assert run_checks(df, ModelChecks("m", [])).count() == 0
