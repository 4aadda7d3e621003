import numpy as np
import pytest

from tessera.llm import op2_topk as m


def vectors(spark, n=700, dim=40, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim))
    x[n // 2:n // 2 + 60] = x[7]                      # a hot code
    x[200:240] = x[20] + rng.normal(size=(40, dim)) * 0.3
    rows = [(i, [float(v) for v in x[i]], 1, 0.5) for i in range(n)]
    rows += [(None, [1.0] * dim, 1, 0.5), (20 * n, None, 1, 0.5), (20 * n + 20, [], 1, 0.5), (20 * n + 40, [None, 1.0], 1, 0.5),
             (40, [float(v) for v in x[40]], 1, 0.5)]
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, CODE int, distance double")


def brute(df, k):
    rows = [(r.vec_id, [v is not None and v > 0 for v in r.embedding]) for r in df.collect()
            if r.vec_id is not None and r.embedding is not None]
    code = {}
    width = max(len(c) for _, c in rows)
    rows = [(i, np.array(c + [False] * (width - len(c)))) for i, c in rows]
    for i, c in rows:
        code.setdefault(i, c)
    out = []
    for q, c in code.items():
        if q % 20 == 0:
            near = sorted((int((c != x).sum()), i) for i, x in rows)[:k]
            out += [(q, r + 1, i, d) for r, (d, i) in enumerate(near)]
    return sorted(out)


@pytest.mark.parametrize("code_block, run, k", [(65_536, 256, 10), (100, 7, 10), (100, 50, 150)])
def test_equals_brute_force(spark, monkeypatch, code_block, run, k):
    monkeypatch.setattr(m, "CODE_BLOCK", code_block)
    monkeypatch.setattr(m, "QUERY_RUN", run)
    df = vectors(spark)
    assert sorted(tuple(r) for r in m.top_k(spark, df, k).collect()) == brute(df, k)


def test_search_grows_until_covered():
    rng = np.random.default_rng(1)
    block = rng.integers(0, 1 << 16, (30_000, 4)).astype(np.uint16)
    queries = block[:40] ^ (rng.random((40, 4)) < 0.5).astype(np.uint16)
    for k in (1, 5):
        for q, found in zip(queries, m.search(m.Index(block), queries, k)):
            d = np.bitwise_count(block ^ q).sum(axis=1)
            assert set(found) == set(np.flatnonzero(d <= np.sort(d)[k - 1]))


def test_no_rows(spark):
    none = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    assert m.top_k(spark, none).count() == 0


def test_many_blocks_take_each_code_once_and_an_id_of_two_codes_asks_with_both(spark, monkeypatch):
    monkeypatch.setattr(m, "CODE_BLOCK", 10)
    rows = m.codes(vectors(spark))
    asking = rows.filter("vec_id % 20 = 0").dropDuplicates()
    dealt, tasks = m.deal(spark, rows, asking)
    blocks = -(-rows.count() // 10)
    assert tasks == blocks and dealt.filter("NOT query").count() == rows.count()
    assert dealt.filter("query").count() == blocks * asking.count()
    two = spark.createDataFrame([(20, [1.0, 1.0]), (20, [-1.0, 1.0]), (1, [-1.0, 1.0])], "vec_id bigint, embedding array<double>")
    got = [(r.query_id, r.vec_id, r.distance) for r in m.top_k(spark, two, 3).orderBy("rank").collect()]
    assert got == [(20, 1, 0), (20, 20, 0), (20, 20, 0)]
