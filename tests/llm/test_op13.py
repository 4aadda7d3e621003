import hashlib
import random

import pytest

from tessera.llm import op13_substring as m


def brute(rows, window=m.WINDOW):
    """rows in reading order: (doc_id, text).  Sorted (doc_id, n_words, n_removed, kept words)."""
    order = sorted(rows, key=lambda r: (2**63 - 1 if r[0] is None else r[0], hashlib.md5((r[1] or "").encode()).digest()))
    seen, out = set(), []
    for doc, text in order:
        ws = [w for w in (text or "").replace("\t", " ").replace("\n", " ").replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" ") if w]
        gone = set()
        for i in range(len(ws) - window + 1):
            key = tuple(ws[i:i + window])
            gone |= set(range(i, i + window)) if key in seen else set()
            seen.add(key)
        out.append((-1 if doc is None else doc, len(ws), len(gone), " ".join(w for i, w in enumerate(ws) if i not in gone)))
    return sorted(out)


def result(df):
    return sorted((-1 if r.doc_id is None else r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in df.collect())


def corpus(seed, n=120):
    rng = random.Random(seed)
    vocabulary = ["Ab", "ab", "é", "x y", " ", "one", "two", "three", "four", "five"]
    prose = lambda k: [rng.choice(vocabulary) + str(rng.randint(0, 40)) for _ in range(k)]
    passages = [prose(k) for k in (19, 20, 21, 35, 60)]
    rows = []
    for i in range(n):
        body = prose(rng.choice([0, 3, 25, 70]))
        for p in rng.sample(passages, rng.randint(0, 3)):
            at = rng.randint(0, len(body))
            body[at:at] = p
        rows.append((rng.randint(0, 200), rng.choice([" ", "\n", "  \t"]).join(body)))
    rows += [(7, rows[0][1])] * 3 + [(i, rows[1][1]) for i in range(300, 340)]         # repeated rows, a group of copies
    rows += [(None, rows[2][1]), (None, rows[2][1]), (None, " ".join(prose(30))), (None, None), (5, None), (6, ""), (6, " \n ")]
    rows += [(400, "la " * 500), (401, "la " * 30), (402, "do re " * 100), (403, "do re " * 9 + "do re")]
    return rows


@pytest.mark.parametrize("seed, words, packs", [(1, 1_000_000, 4), (2, 100, 1)])
def test_equals_brute_force(spark, documents, monkeypatch, seed, words, packs):
    monkeypatch.setattr(m, "RANGE_WORDS", words)
    monkeypatch.setattr(m, "PACKS_PER_BUCKET", packs)
    rows = corpus(seed)
    got = m.repeats(spark, documents([(i, t, "s") for i, t in rows]))
    assert result(got) == brute(rows)
    for r in got.collect():
        assert sum(s.end - s.begin for s in r.spans or []) == r.n_removed
        assert hashlib.sha256(r.kept_text.encode()).hexdigest() == r.kept_sha256
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("tessera_texts")]


def test_a_repeat_of_a_window_is_found_at_every_offset(spark, documents):
    passage = [f"p{i}" for i in range(20)]
    rows = [(i, " ".join([f"a{i}_{k}" for k in range(i)] + passage + [f"b{i}_{k}" for k in range(7)])) for i in range(23)]
    got = {r.doc_id: r for r in m.repeats(spark, documents([(i, t, "s") for i, t in rows])).collect()}
    assert got[0].n_removed == 0
    assert all([tuple(s) for s in got[i].spans] == [(i, i + 20)] for i in range(1, 23))


def test_a_text_of_a_million_words(spark, documents):
    long = [f"w{i * i % 10007}" for i in range(1_000_000)]
    got = {r.doc_id: r for r in m.repeats(spark, documents([(1, " ".join(long), "s"), (2, " ".join(long[500_000:500_030]), "s")])).collect()}
    assert got[1].n_words == 1_000_000 and got[1].n_removed == 1_000_000 - 10_007 and got[2].n_removed == 30


def test_no_rows(spark, documents):
    assert m.repeats(spark, documents([])).count() == 0


def test_texts_are_shuffled_once(spark, documents):
    name, sizes = m.packed(spark, m.texts_of(documents([(i, f"t{i}", "s") for i in range(50)])))
    try:
        live = spark.createDataFrame([], "pack int, range int, live binary")
        plan = (spark.table(name).groupBy("pack").cogroup(live.groupBy("pack"))
                .applyInArrow(lambda a, b: a, "pack int, doc_id bigint, h binary, text string")
                ._jdf.queryExecution().executedPlan().toString())
        scan = plan[plan.index("FlatMapCoGroupsInArrow"):]
        texts_side = [line for line in scan.splitlines() if "Exchange" in line]
        assert len(texts_side) <= 1 and "Bucketed: true" in plan
    finally:
        spark.sql(f"DROP TABLE {name}")
