import duckdb
import pytest

from tessera.llm import op9_decontaminate as m

from .conftest import prose


def fixture_rows():
    passage = prose(1, 25)
    items = [("i2", " ".join(passage)), ("i10", " ".join(prose(2, 30))), ("i3", "short one"), (None, " ".join(prose(3, 12))),
             ("i4", None), ("i5", ""), ("i6", " ".join(passage[5:20])), ("i7", "Élan vital, ÉLAN")]
    docs = [(1, " ".join(prose(10, 50)) + "\n" + " ".join(passage).upper() + ". End", "s"),
            (2, " ".join(prose(11, 500)), "s"), (3, None, "s"), (4, "", None), (5, "A SHORT, one-short ONE", "s"),
            (6, " ".join(passage[:9]), "s"), (7, " ".join(passage[8:18]), "s"), (8, " ".join(prose(3, 12)), "s"),
            (9, " ".join([*passage, *passage]) * 40, "s"), (10, "élan VITAL Élan", "s"), (11, "Élan-vital É", "s"),
            (12, "Élan vital ÉLAN", "s"), (7, " ".join(passage[8:18]), "s"), (None, "x short one y", "s")]
    return items, docs


@pytest.mark.parametrize("max_set", [m.MAX_SET, 40])
def test_equals_sql(spark, documents, max_set):
    items, rows = fixture_rows()
    bench = spark.createDataFrame(items, "item_id string, text string")
    got = m.decontaminate(spark, documents(rows), bench, max_set).toPandas()
    con = duckdb.connect()
    unique = list({(i, t): None for i, t, _ in rows if i is not None})
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", [list(u) for u in unique])
    con.execute("CREATE TABLE benchmark (item_id VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO benchmark VALUES (?, ?)", [list(i) for i in items if i[0]])
    want = {r[0]: r[1:] for r in con.sql(m.ORACLE).fetchall()}
    named = got[got.doc_id.notna() & (got.doc_id != 8)]   # 8: the item without an id
    assert {int(r.doc_id): tuple(r[1:]) for r in named.itertuples(index=False)} == {k: v for k, v in want.items() if k != 8}
    eight = got[got.doc_id == 8].iloc[0]
    assert (eight.n_hit, eight.n_items, eight.contaminated) == (12, 0, True)
    assert len(got) == len(rows) and got[got.doc_id.isna()].n_hit.tolist() == [2]


def test_stage_drops_contaminated_rows_only(spark, documents):
    items, rows = fixture_rows()
    docs = documents(rows)
    kept = m.clean_documents(spark, docs, spark.createDataFrame(items, "item_id string, text string"))
    assert kept.columns == docs.columns
    assert sorted(r[0] for r in kept.collect()) == [2, 3, 4, 6, 10, 11]


def test_every_length_and_place_of_a_window(spark, documents):
    """Items of 1 to 12 words, in texts at every offset around the ends of a chunk."""
    items = [(f"i{n}", " ".join(prose(100 + n, n))) for n in range(1, 13)]
    docs, want = [], {}
    for n in range(1, 13):
        for before in [*range(12), *range(m.CHUNK - 13, m.CHUNK + 3), 2 * m.CHUNK - 1]:
            for after in (0, 7):
                i = len(docs)
                docs.append((i, " ".join([*prose(200, before), *prose(100 + n, n), *prose(201, after)]), "s"))
                want[i] = (before + n + after, n, n)
    got = m.decontaminate(spark, documents(docs), spark.createDataFrame(items, "item_id string, text string")).collect()
    assert len(got) == len(docs) and all(r.contaminated for r in got)
    from hashlib import sha256
    assert {r.doc_id: (r.n_words, r.n_hit) for r in got} == {i: w[:2] for i, w in want.items()}
    assert all(r.items_sha256 == sha256(f"i{want[r.doc_id][2]}".encode()).hexdigest() for r in got)


def test_empty_tables(spark, documents):
    none = spark.createDataFrame([], "item_id string, text string")
    got = m.decontaminate(spark, documents([(1, "a b", "s"), (2, None, "s")]), none).collect()
    assert sorted((r.doc_id, r.n_words, r.n_hit, r.contaminated) for r in got) == [(1, 2, 0, False), (2, 0, 0, False)]
    assert m.decontaminate(spark, documents([]), none).count() == 0


def test_plan_has_no_python(spark):
    from conftest import SF_SMALL
    plan = m.op9_decontaminate(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
