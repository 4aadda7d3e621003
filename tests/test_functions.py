import datetime as dt

from pyspark.sql import functions as F

from tessera.functions import (cursor_position, days_between, format_cursor, full_name,
                               json_scalar, seconds_to_timestamp, title_case)


def test_title_case_splits_on_punctuation(spark):
    df = spark.createDataFrame([("mary-jane o'neil",), ("ALICE",), ("a.b_c d",), ("",), (None,)],
                               "s string")
    got = [r[0] for r in df.select(title_case("s")).collect()]
    assert got == ["Mary-Jane O'neil", "Alice", "A.B_C D", "", None]


def test_full_name_is_null_propagating(spark):
    df = spark.createDataFrame([("John", "Doe"), ("Ann", None)], "f string, l string")
    assert [r[0] for r in df.select(full_name("f", "l")).collect()] == ["John Doe", None]


def test_json_scalar_only_returns_scalars(spark):
    docs = ['{"v": "{x"}', '{"v": {"a": 1}}', '{"v": [1, 2]}', '{"v": null}', '{"v": 1.50}',
            '{"v": true}', '{"w": 1}', '{"v": ', None]
    df = spark.createDataFrame([(d,) for d in docs], "d string")
    got = [r[0] for r in df.select(json_scalar("d", "$.v")).collect()]
    assert got == ["{x", None, None, None, "1.5", "true", None, None, None]


def test_json_scalar_numbers_and_repeated_keys(spark):
    docs = {'{"v": 12345678901234567890123456789012345678901}': "12345678901234567890123456789012345678901",
            '{"v": 1e5}': "100000.0", '{"v": 0.1000}': "0.1", '{"v": -0}': "0", '{"v": "1.50"}': "1.50",
            '{"v": "[1]"}': "[1]", '{"v": "{\\"a\\": 1}"}': '{"a": 1}', '{"v": 1, "v": 2}': "1",
            '{"v": {"a": 1}, "v": 2}': None, '{"v": "[x", "v": 2}': "[x", '{"v": ""}': ""}
    df = spark.createDataFrame([(d,) for d in docs], "d string")
    assert {r.d: r.x for r in df.select("d", json_scalar("d", "$.v").alias("x")).collect()} == docs


def test_the_variant_is_parsed_in_a_branch_only(spark):
    df = spark.createDataFrame([('{"v": 1}',)], "d string").select(json_scalar("d", "$.v").alias("x"))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert 0 <= plan.find("CASE WHEN") < plan.find("parseJson")


def test_seconds_round_half_away_from_zero(spark):
    df = spark.createDataFrame([(1.5,), (-0.5,), (2.5,)], "x double")
    got = [r[0] for r in df.select(seconds_to_timestamp("x")).collect()]
    epoch = dt.datetime(1970, 1, 1)
    assert got == [epoch + dt.timedelta(seconds=s) for s in (2, -1, 3)]


def test_cursor_round_trip_and_junk(spark):
    df = spark.createDataFrame([("fraud", 42)], "s string, p long")
    cur = df.select(format_cursor("s", "p").alias("c")).first()["c"]
    assert cur == "cursor_fraud_42"
    df2 = spark.createDataFrame([(cur,), ("cursor_x_abc",), (None,)], "c string")
    assert [r[0] for r in df2.select(cursor_position("c")).collect()] == [42, None, None]


def test_days_between_counts_calendar_days(spark):
    df = spark.createDataFrame([(dt.datetime(2026, 3, 31, 23, 0),), (dt.datetime(2026, 4, 1, 1, 0),)],
                               "t timestamp_ntz")
    got = [r[0] for r in df.select(days_between("2026-04-01", F.col("t"))).collect()]
    assert got == [1, 0]
