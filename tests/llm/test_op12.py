import numpy as np
import pytest

from tessera.llm import op12_hard_negatives as m


def brute(rows, every, n_pos, n_neg, low, high):
    best = {}
    for i, v, label in rows:
        if i is None or v is None or label is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        q = tuple(int(np.floor(256 * x)) for x in v)
        if i not in best or (label, np.array(q, float).tobytes()) < best[i][0]:
            best[i] = ((label, np.array(q, float).tobytes()), label, q)
    good = [(i, label, q) for i, (_, label, q) in best.items()]
    score = lambda a, b: sum(x * y for x, y in zip(a, b))  # noqa: E731 - the shorter one ends the sum, as zeros do
    out = []
    for a, la, qa in good:
        if a % every:
            continue
        pos = sorted((-score(qa, q), i) for i, label, q in good if label == la and i != a)[:n_pos]
        others = sorted((-score(qa, q), i) for i, label, q in good if label != la)
        for s, p in pos:
            inside = [(n, i) for n, i in others if low * -s <= 100 * -n <= high * -s][:n_neg]
            out += [(a, p, r + 1, i, -s, -n) for r, (n, i) in enumerate(inside)]
    return sorted(out)


def vectors(seed, n=500, dim=12, spread=0.2):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dim))
    rows = [(i, (centres[i % 6] + rng.normal(size=dim) * spread).tolist(), int(rng.integers(0, 3))) for i in range(-20, n)]
    for i in range(60, 130):                       # a hot vector, one label
        rows[i] = (rows[i][0], rows[60][1], 1)
    rows += [(None, [1.0] * dim, 1), (n + 10, None, 1), (n + 20, [1.0] * dim, None), (n + 30, [1.0, None] + [0.0] * (dim - 2), 1),
             (n + 40, [float("inf")] * dim, 1), (n + 50, [float("nan")] * dim, 1), (n + 60, [], 1), (n + 70, [2.5, 1.0], 2),
             rows[30], rows[30], (rows[40][0], [0.5] * dim, 0), (1000, [0.1] * dim, 77)]
    return rows


def frame(spark, rows, kind="double"):
    return spark.createDataFrame([(*r, 1, "x", 0.5) for r in rows],
                                 f"vec_id bigint, embedding array<{kind}>, label int, block int, LABEL string, score double")


@pytest.mark.parametrize("chunk, least, every", [(256, 1024, 10), (7, 60, 10), (3, 90, 1)])
def test_equals_brute_force(spark, monkeypatch, chunk, least, every):
    monkeypatch.setattr(m, "CHUNK", chunk)
    monkeypatch.setattr(m, "LEAST_BLOCK", least)
    monkeypatch.setattr(m, "BLOCK_BYTES", least * 8 * 12)
    rows = vectors(chunk, n=200 if every == 1 else 500)
    got = m.hard_negatives(spark, frame(spark, rows), every)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, every, m.POSITIVES, m.NEGATIVES, m.LOW, m.HIGH)


def test_bounds_spare_scores_and_lose_none():
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(20, 24)) * 3
    x = np.floor(256 * (centres[np.arange(4000) % 20] + rng.normal(size=(4000, 24)) * 0.02))
    labels = (np.arange(4000) % 20) // 2 + (rng.random(4000) < 0.1)
    block = m.Block(np.arange(4000), labels, x)
    chunk = m.Chunk.of(np.arange(0, 4000, 40), labels[::40], x[::40])
    asks = {}
    for a, p, s in m.positives(block, chunk, 5):
        asks.setdefault(a, []).append((p, s))
    found = sorted(m.negatives(block, chunk, asks, 3, 50, 95))
    assert block.rescored < 0.4 * block.bounded
    rows = list(zip(range(4000), (x / 256).tolist(), labels.tolist()))
    want = brute([r for r in rows], 40, 5, 3, 50, 95)
    assert found == sorted((a, p, n, s, t) for a, p, _, n, s, t in want)


def test_the_tree_spans_at_least_length():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(40, 5))
    parent, edge = m.spanning_tree(x)
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    assert parent[0] == -1 and np.allclose(edge[1:], d[np.arange(1, 40), parent[1:]])
    total, inside = 0.0, [0]
    while len(inside) < 40:                        # Kruskal's sum, grown plainly
        rest = [i for i in range(40) if i not in inside]
        sub = d[np.ix_(inside, rest)]
        total += sub.min()
        inside.append(rest[int(sub.min(axis=0).argmin())])
    assert np.isclose(edge.sum(), total)


def test_components_too_large_for_doubles_are_exact(spark):
    rows = [(50 * i, [5e6 + i, -2e6], i % 2) for i in range(12)]
    got = m.hard_negatives(spark, frame(spark, rows))
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, 50, 5, 3, 50, 95)


def test_one_partition_for_each_block(spark, monkeypatch):
    monkeypatch.setattr(m, "LEAST_BLOCK", 10)
    rows, dim = m.integer_vectors(spark, frame(spark, vectors(1)))
    none = spark.createDataFrame([], f"tree binary, asks {m._ASKS}")
    met = m._meetings(rows, none, 40, dim, None)
    assert met.rdd.getNumPartitions() == 40


def test_no_rows(spark):
    assert m.hard_negatives(spark, frame(spark, [], "float")).count() == 0
    assert m.hard_negatives(spark, frame(spark, [(50, None, 1)])).count() == 0
