"""Property tests: the Spark operators against small pure-Python models."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Row
from pyspark.sql import functions as F

from tessera.operators import incremental as inc
from tessera.operators.gold import top1

SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])
keys = st.integers(min_value=0, max_value=6)
T0 = dt.datetime(2024, 1, 1)


@SETTINGS
@given(target=st.dictionaries(keys, st.text(max_size=3), max_size=6),
       source=st.dictionaries(keys, st.text(max_size=3), max_size=6))
def test_upsert_matches_dict_update(spark, target, source):
    schema = "k long, v string"
    t = spark.createDataFrame(list(target.items()), schema)
    s = spark.createDataFrame(list(source.items()), schema)
    expected = dict(target)
    expected.update(source)
    got = {r.k: r.v for r in inc.upsert(t, s, "k").collect()}
    assert got == expected


@SETTINGS
@given(rows=st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 10)), max_size=12),
       done=st.lists(st.tuples(st.sampled_from(["a", "b"]), st.integers(0, 10)), max_size=6))
def test_per_stream_high_water_mark(spark, rows, done):
    schema = "source_stream string, ingested_at timestamp_ntz"
    conv = lambda xs: [(s, T0 + dt.timedelta(hours=h)) for s, h in xs]
    raw = spark.createDataFrame(conv(rows), schema)
    target = spark.createDataFrame(conv(done), schema)
    marks = {}
    for s, h in done:
        marks[s] = max(marks.get(s, h), h)
    expected = sorted((s, h) for s, h in rows if s not in marks or h > marks[s])
    got = sorted((r.source_stream, int((r.ingested_at - T0).total_seconds() // 3600))
                 for r in inc.incremental_filter(raw, target, scope="per_stream").collect())
    assert got == expected


@SETTINGS
@given(rows=st.lists(st.tuples(st.integers(0, 3), st.one_of(st.none(), st.integers(0, 5)),
                               st.integers(0, 50)), max_size=15, unique_by=lambda r: r[2]))
def test_top1_matches_sorted_pick(spark, rows):
    df = spark.createDataFrame(rows, "g long, tenure long, rid long")
    got = {r.g: r.rid for r in top1(df, ["g"], [F.col("tenure").desc_nulls_last(),
                                                  F.col("rid").asc_nulls_last()]).collect()}
    expected = {}
    for g in {r[0] for r in rows}:
        cands = [r for r in rows if r[0] == g]
        cands.sort(key=lambda r: (r[1] is None, -(r[1] or 0), r[2]))
        expected[g] = cands[0][2]
    assert got == expected


@SETTINGS
@given(rows=st.lists(st.tuples(st.sampled_from(["a", "b"]), st.integers(0, 10)), max_size=12),
       done=st.lists(st.tuples(st.sampled_from(["a", "b"]), st.integers(0, 10)), max_size=6))
def test_configured_streams_filter_equals_open_filter(spark, rows, done):
    schema = "source_stream string, ingested_at timestamp_ntz"
    conv = lambda xs: [(s, T0 + dt.timedelta(hours=h)) for s, h in xs]
    raw = spark.createDataFrame(conv(rows), schema)
    target = spark.createDataFrame(conv(done), schema)
    a = inc.incremental_filter(raw, target, scope="per_stream")
    b = inc.incremental_filter(raw, target, scope="per_stream", streams=["a", "b"])
    assert sorted(a.collect()) == sorted(b.collect())


def _title_case_model(s):
    from tessera.functions.text import INITCAP_DELIMITERS
    delims = set(INITCAP_DELIMITERS) | {" ", "\t", "\n"}
    out, start = [], True
    for ch in s:
        if ch in delims:
            out.append(ch)
            start = True
        else:
            out.append(ch.upper() if start else ch.lower())
            start = False
    return "".join(out)


@SETTINGS
@given(words=st.lists(st.text(alphabet="abcXYZ09'-_. @#/(", min_size=0, max_size=12),
                      min_size=1, max_size=8))
def test_title_case_matches_model(spark, words):
    from tessera.functions.text import title_case
    df = spark.createDataFrame([(w,) for w in words], "s string")
    got = [r[0] for r in df.select(title_case("s")).collect()]
    assert got == [_title_case_model(w) for w in words]


@SETTINGS
@given(log=st.lists(st.tuples(st.sampled_from(["fraud", "audit", "access"]), st.integers(0, 3000)),
                    max_size=20, unique=True),
       cursors=st.dictionaries(st.sampled_from(["fraud", "audit", "access"]),
                               st.one_of(st.none(), st.integers(0, 3000))))
def test_extract_matches_model(spark, log, cursors):
    streams = ["fraud", "audit", "access"]
    df = spark.createDataFrame(log, "stream_name string, pos long")
    rows = [(s, cursors.get(s)) for s in streams]
    got = sorted((r.stream_name, r.pos, r.page) for r in
                 inc.extract_new(df, [Row(stream_name=s, cursor_pos=c)
                                      for s, c in rows]).collect())
    expected = []
    for s, p in log:
        c = cursors.get(s)
        if c is None or p > c:
            base = -1 if c is None else c
            expected.append((s, p, (p - base - 1) // 1000))
    assert got == sorted(expected)


@SETTINGS
@given(xs=st.lists(st.floats(min_value=-1e6, max_value=1e6, allow_nan=False)
                   .map(lambda v: round(v * 2) / 2), min_size=1, max_size=10))
def test_float_seconds_round_half_away_from_zero(spark, xs):
    import decimal
    from tessera.functions.temporal import seconds_to_timestamp
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = [r[0] for r in df.select(seconds_to_timestamp("x")).collect()]
    epoch = dt.datetime(1970, 1, 1)
    want = [epoch + dt.timedelta(seconds=int(decimal.Decimal(repr(x)).quantize(
        decimal.Decimal(1), rounding=decimal.ROUND_HALF_UP))) for x in xs]
    assert got == want
