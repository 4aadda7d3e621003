import duckdb
import pytest

from tessera.llm import op5_mixing as m

from .conftest import prose


def corpus():
    rows = []
    for s, n in (("a", 60), ("b", 40), ("ç", 30), (None, 30), ("tiny", 2)):
        rows += [(len(rows) + k, " ".join(prose(len(rows) + k, 1 + (37 * k) % 90)), s) for k in range(n)]
    rows += [(900, None, "a"), (901, "", "b"), (902, " \t", "void")]
    return rows


@pytest.mark.parametrize("broadcast", [10_000, 0])
def test_equals_sql(spark, documents, monkeypatch, broadcast):
    monkeypatch.setattr(m, "MAX_BROADCAST_SOURCES", broadcast)
    rows = corpus()
    got = {r.doc_id: tuple(r)[1:] for r in m.mix(spark, documents(rows)).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", [list(r) for r in rows])
    assert got == {r[0]: r[1:] for r in con.sql(m.ORACLE).fetchall()}
    source = {i: s for i, _, s in rows}
    for s in set(source.values()):
        mine = [v for i, v in got.items() if source[i] == s]
        target, taken = mine[0][2], sum(v[3] for v in mine)
        assert all(v[3] <= 2 * v[0] for v in mine)
        assert abs(taken - target) <= max(v[0] for v in mine) / 2 + 1e-6
    total = sum(v[0] for v in got.values())
    assert sum({source[i]: v[2] for i, v in got.items()}.values()) == pytest.approx(1.5 * total)


def test_targets_share_the_excess_again(spark):
    sizes = spark.createDataFrame([(1, "a", 10), (2, "b", 100), (3, "c", 90)], "doc_id bigint, source string, size bigint")
    got = {r.source: r.target for r in m.targets(sizes).collect()}
    # a (weight 3) stops at 20; the other 280 are shared 1 : 2, c stops at 180, b gets 100
    assert got == {"a": 20.0, "b": 100.0, "c": 180.0}


def test_stage_repeats_rows_by_copies(spark, documents):
    rows = corpus()
    docs = documents(rows)
    taken = {r.doc_id: r.taken // r.size for r in m.mix(spark, docs).collect() if r.size}
    out = m.mixed_documents(spark, docs)
    assert out.columns == [*docs.columns, "copy"]
    copies = {}
    for r in out.collect():
        copies[r[0]] = copies.get(r[0], 0) + 1
    assert {i: copies.get(i, 0) for i in taken} == taken


def test_empty_table_and_repeated_rows(spark, documents):
    assert m.mix(spark, documents([])).count() == 0
    got = m.mix(spark, documents([(1, "a b c", "s"), (1, "a b c", "s"), (None, "a b", None)])).collect()
    assert len(got) == 3 and all(r.taken in (3, 6) for r in got if r.doc_id == 1)


@pytest.mark.parametrize("ids, broadcast", [("null", 10_000), ("one", 10_000), ("pairs", 0)])
def test_rows_that_are_alike_are_drawn_one_by_one(spark, documents, monkeypatch, ids, broadcast):
    monkeypatch.setattr(m, "MAX_BROADCAST_IDS", broadcast)
    rows = [(None if ids == "null" else 7 if ids == "one" else i // 2, " ".join(prose(i if ids == "null" else 3, 10)), "ab"[i % 3 == 0])
            for i in range(150)]
    def taken(parts):
        got = m.mix(spark, documents(rows).repartition(parts)).collect()
        assert len(got) == 150 and all(r.taken in (0, 10, 20) for r in got)
        for size in {r.source_size for r in got}:
            mine = [r for r in got if r.source_size == size]
            assert abs(sum(r.taken for r in mine) - mine[0].target) <= 5
        return sorted((r.doc_id or -1, r.source_size, r.taken) for r in got)
    assert taken(3) == taken(7)
    out = m.mixed_documents(spark, documents(rows))
    assert out.count() == sum(t for _, _, t in taken(2)) // 10


def test_plan_has_no_python(spark):
    from conftest import SF_SMALL
    plan = m.op5_mixing(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
