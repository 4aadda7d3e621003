import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tessera.sources.keyed import BUCKET, KeyedTable
from tessera.sources.tables import Rewritten, StaleVersion


def rows(spark, keys, v="a", text=False):
    return spark.createDataFrame([(str(k) if text else k, v) for k in keys], "k string, v string" if text else "k long, v string")


def content(t):
    return sorted(tuple(r) for r in t.read().collect())


def files(t):
    return {os.path.basename(f): f for f in t.read().inputFiles()}


@pytest.mark.parametrize("text", [False, True])
def test_one_redelivered_row_rewrites_one_bucket(spark, scratch, text):
    t = KeyedTable(spark, scratch("kt"), "k", filter_rows=1, buckets=8)
    assert t.merge(rows(spark, range(400), text=text)).mode == "append"
    before = files(t)
    done = t.merge(rows(spark, [17], "b", text))
    assert done.mode == "rewrite" and len(done.rewritten) == 1 and done.probed == 1
    after = files(t)
    bucket = f"{BUCKET}={done.rewritten[0]}/"
    assert {f for f in before if bucket not in before[f]} == {f for f in after if bucket not in after[f]}
    assert not {f for f in before if bucket in before[f]} & set(after)
    want = {(str(k) if text else k): "b" if k == 17 else "a" for k in range(400)}
    assert content(t) == sorted(want.items())


def test_new_keys_read_no_old_file(spark, scratch):
    t = KeyedTable(spark, scratch("new"), "k", filter_rows=1, buckets=4)
    t.merge(rows(spark, range(100)))
    done = t.merge(rows(spark, range(1000, 1050), "b"))       # beyond every key range
    assert (done.mode, done.probed, done.rewritten) == ("append", 0, [])
    # inside the ranges: the filters decide
    done = t.merge(rows(spark, [500], "c"))
    assert (done.mode, done.probed) == ("append", 0)
    assert t.read().count() == 151
    state = t._state()
    plan = t._read_entries([e for e in t.entries(state) if e["bucket"] == 2], t.schema()).inputFiles()
    assert plan and all(f"{BUCKET}=2/" in f for f in plan)


def test_filters_have_no_false_misses_and_few_false_hits(spark, scratch):
    t = KeyedTable(spark, scratch("bloom"), "k", filter_rows=1, buckets=4)
    t.merge(spark.range(0, 20_000, 2).select(F.col("id").alias("k"), F.lit("a").alias("v")))
    entries = t.entries()

    def keys(df):
        return df.select(t._bucket(4).alias(BUCKET), "k")

    for k in (0, 19_998, 7_000):
        assert len(t.may_match(keys(rows(spark, [k])), entries)) == 1
    assert KeyedTable(spark, t.path, "k", buckets=4).may_match(keys(rows(spark, [1])), [e | {"blocks": 0} for e in entries])
    misses = [bool(t.may_match(keys(rows(spark, [k])), entries)) for k in range(1, 40, 2)]
    assert sum(misses) <= 1


def test_files_of_a_bucket_are_compacted_and_buckets_double(spark, scratch):
    t = KeyedTable(spark, scratch("grow"), "k", filter_rows=1, buckets=2, rows_per_bucket=50, max_files=3)
    reports = [t.merge(rows(spark, range(20 * i, 20 * i + 20), str(i))) for i in range(9)]
    assert any(r.compacted for r in reports) and all(r.mode in ("append", "rewrite") for r in reports)
    assert t.bucket_count() == 4
    per_bucket = {}
    for e in t.entries():
        per_bucket[e["bucket"]] = per_bucket.get(e["bucket"], 0) + 1
    assert max(per_bucket.values()) <= 3
    assert content(t) == [(k, str(k // 20)) for k in range(180)]
    assert sum(e["rows"] for e in t.entries()) == 180


def test_random_merges_equal_a_dict(spark, scratch):
    import random
    rng = random.Random(4)
    t, want = KeyedTable(spark, scratch("dict"), ["k", "v"], filter_rows=7, buckets=3, rows_per_bucket=60, max_files=2), {}
    for step in range(8):
        batch = {(rng.randint(0, 120), rng.choice("xy")): step for _ in range(rng.randint(0, 40))}
        want |= batch
        df = spark.createDataFrame([(*k, n) for k, n in batch.items()], "k long, v string, n int")
        mode = t.merge(df).mode
        assert (mode == "noop") == (not batch)
    assert sorted(tuple(r) for r in t.read().collect()) == sorted((*k, n) for k, n in want.items())


def test_null_keys_match_nothing_and_repeated_keys_fail(spark, scratch):
    t = KeyedTable(spark, scratch("null"), "k", filter_rows=1, buckets=2)
    t.merge(rows(spark, [1, None]))
    assert t.merge(rows(spark, [None, 2], "b")).mode == "append"
    assert t.read().count() == 4
    with pytest.raises(ValueError, match="more than once"):
        t.merge(rows(spark, [5, 5]))
    with pytest.raises(ValueError, match="differs"):
        t.merge(spark.createDataFrame([(9, 1)], "k long, v int"))
    assert t.read().count() == 4


def test_the_loser_of_two_commits_merges_again(spark, scratch, monkeypatch):
    t = KeyedTable(spark, scratch("race"), "k", filter_rows=1, buckets=2)
    t.merge(rows(spark, range(10)))
    other, publish, lost = KeyedTable(spark, t.path, "k", filter_rows=1, buckets=2), KeyedTable._publish, []

    def first_let_the_other_win(self, *a, **k):
        if not lost:
            lost.append(1)
            other.merge(rows(spark, [3, 20], "other"))
        return publish(self, *a, **k)

    monkeypatch.setattr(KeyedTable, "_publish", first_let_the_other_win)
    done = t.merge(rows(spark, [3, 21], "mine"))
    monkeypatch.undo()
    assert done.mode == "rewrite" and done.version == 3
    got = dict(content(t))
    assert got[3] == "mine" and got[20] == "other" and got[21] == "mine" and len(got) == 12
    monkeypatch.setattr(KeyedTable, "_publish", lambda *a, **k: (_ for _ in ()).throw(StaleVersion("always")))
    with pytest.raises(StaleVersion):
        t.merge(rows(spark, [1], "x"))


def test_versions_are_read_added_and_forgotten_by_age(spark, scratch):
    t = KeyedTable(spark, scratch("old"), "k", filter_rows=1, buckets=2)
    t.merge(rows(spark, range(5)))
    t.merge(rows(spark, range(10, 13)))
    assert sorted(r.k for r in t.added(1).collect()) == [10, 11, 12]
    assert t.added(2).count() == 0 and t.added(0).count() == 8
    t.merge(rows(spark, [0], "new"))
    with pytest.raises(Rewritten):
        t.added(1)
    old = t.read(version=2)                                   # an old reader
    assert t.version_at(t.history()[1]["committed_at"]) == 2
    assert t.vacuum(older_than=t.history()[0]["committed_at"]) == []     # nothing was superseded by then
    assert sorted(r.v for r in old.collect()) == ["a"] * 8
    later = str(dt.datetime.fromisoformat(t.history()[-1]["committed_at"]) + dt.timedelta(seconds=1))
    t.vacuum(older_than=later, keep=frozenset({2}))
    assert [h["version"] for h in t.history()] == [2, 3]
    assert len(content(t)) == 8
    with pytest.raises(KeyError):
        t.read(version=1)
