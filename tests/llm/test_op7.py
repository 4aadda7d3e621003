import duckdb

from tessera.llm import op7_licences as m

from .conftest import prose


def rows():
    return [(1, " ".join(prose(1, 40)) + ".\nReleased under the MIT License.", "s"),
            (2, "Some words. LICENSED under the apache license, version 2.0! More words", "s"),
            (3, "This work is licensed under the GNU General Public License, version 3", "s"),
            (4, "This work is licensed under the GNU Lesser General Public License, version 3.\nLicensed under CC BY-NC 4.0.", None),
            (5, " ".join(prose(2, 5000)), "s"), (6, None, "s"), (7, "", "s"), (8, "Released under the MIT", "s"),
            (9, "MIT License. " * 500, "s"), (10, "Released under the MIT License. " * 300, "s"),
            (11, "released under\nthe MIT License", "s"), (12, "one", "s"), (13, ".\n.\n!", "s")]


def test_equals_sql(spark, documents):
    got = {r.doc_id: tuple(r)[1:] for r in m.scan(spark, documents(rows())).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", [list(r[:2]) for r in rows()])
    assert got == {r[0]: r[1:] for r in con.sql(m.ORACLE).fetchall()}
    assert got[1][1:3] == got[10][1:3] == ("MIT", "MIT") and got[2][2] == "Apache-2.0" and got[5] == (0, "", None, 0.0)
    assert {"CC-BY-NC-4.0", "LGPL-3.0"} <= set(got[4][1].split(",")) and got[11][0] == 1


def test_repeated_rows_null_ids_other_templates_and_no_rows(spark, documents):
    docs = documents([(1, "Free for all uses", "s"), (1, "Free for all uses", "s"), (None, "Free for all uses", None)])
    got = m.scan(spark, docs, [("X", "free for all uses"), ("Y", "word"), (None, "a b"), ("Z", None)]).collect()
    assert [(r.n_matches, r.licences, r.best_score) for r in got] == [(1, "X", 1.0)] * 3
    assert m.scan(spark, docs, [("Y", "word")]).filter("n_matches > 0").count() == 0
    assert m.scan(spark, documents([])).count() == 0


def test_notices_across_line_and_sentence_ends(spark, documents):
    a, b = " ".join(prose(1, 300)), " ".join(prose(2, 300))
    texts = {1: f"{a}\nLicensed under the Apache\nLicense, Version 2.0.\n{b}",
             2: f"{a}\n# This work is licensed under\n# the GNU General Public License, version 3.\n{b}",
             3: f"{a} released under the MIT License {b}",
             4: f"{a}\nLicensed under the Apache\nLicense, Version 2.0. Licensed under\nCC BY 4.0.\n{b}",
             5: f"{a}\nLicensed under CC BY 4.0.\n{b}\nReleased under\nthe MIT License\n{b}\nReleased under\nthe MIT License\n{a}",
             6: f"{a}\nReleased under the\n{b}\nMIT License\n{a}",
             7: f"{a}\nThis work, by us, is licensed under the GNU\nLesser\nGeneral Public License, version 3. {b}"}
    got = {r.doc_id: tuple(r)[1:] for r in m.scan(spark, documents([(k, v, "s") for k, v in texts.items()])).collect()}
    assert got[1] == (1, "Apache-2.0", "Apache-2.0", 1.0)
    assert got[2][0] == 1 and got[2][2:] == ("GPL-3.0", 1.0)
    assert got[3] == (1, "MIT", "MIT", 1.0)
    assert got[4][0] == 2 and {"Apache-2.0", "CC-BY-4.0"} <= set(got[4][1].split(","))
    assert got[5][0] == 2 and {"MIT", "CC-BY-4.0"} <= set(got[5][1].split(",")) and got[5][3] == 1.0
    assert got[6] == (0, "", None, 0.0)
    assert got[7][0] == 1 and got[7][2] == "LGPL-3.0"


def test_templates_of_several_sentences(spark, documents):
    own = [("X", "Copies may be made.\nThe above notice stays. There is no warranty of any kind.")]
    a = " ".join(prose(3, 200))
    docs = documents([(1, f"{a}\nCopies may be made. The above\nnotice stays.\nThere is no warranty of any kind.\n{a}", "s"),
                      (2, f"{a}\nThere is no warranty of any kind.\n{a}", "s")])
    got = {r.doc_id: tuple(r)[1:] for r in m.scan(spark, docs, own).collect()}
    assert got == {1: (1, "X", "X", 1.0), 2: (0, "", None, 0.0)}


def test_plan_has_no_python(spark):
    from conftest import SF_SMALL
    plan = m.op7_licences(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
