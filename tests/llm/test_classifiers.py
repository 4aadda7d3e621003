import random

import numpy as np
import pytest

from tessera.llm import op1_toxicity, op4_quality

from .conftest import prose

SF = "/root/testdata/sf0.01"


def _auc(score, label):
    rank = np.argsort(np.argsort(score))
    up = label == 1
    return (rank[up].mean() - (up.sum() - 1) / 2) / (~up).sum()


@pytest.mark.parametrize("query, label, least", [(op4_quality.op4_quality, "quality", 0.97),
                                                 (op1_toxicity.op1_toxicity, "toxic", 0.80)])
def test_held_out_order(spark, query, label, least):
    got = query(spark, SF).toPandas()
    assert got.columns.tolist() == ["doc_id", "held_out", "score", "predicted"]
    assert len(got) == 1000 and got.score.between(0, 1).all()
    both = got.merge(spark.read.parquet(f"{SF}/labels.parquet").toPandas(), on="doc_id")
    held = both[both.held_out]
    assert _auc(held.score.to_numpy(), held[label].to_numpy()) >= least


def _labelled(spark, documents):
    rng = random.Random(2)
    rows, labels = [], []
    for k in range(400):
        toxic = k % 4 == 0
        words = prose(k, 60)
        if toxic:
            words[rng.randrange(60)] = "vileword"
        junk = k % 5 == 0
        rows.append((k, " ".join(w + "###" for w in words) if junk else " ".join(words), "s"))
        labels.append((k, int(not junk), int(toxic)))
    rows += [(1000, None, "s"), (1001, "", "s"), (None, "vileword", "s"), (1002, "vileword " * 50_000, None), (3, rows[3][1], "s")]
    labels += [(None, 1, 1), (5000, 1, 1), (1, None, None)]
    return documents(rows), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def test_toxicity_finds_the_word(spark, documents):
    docs, labels = _labelled(spark, documents)
    got = {r.doc_id: r.score for r in op1_toxicity.score(spark, docs, op1_toxicity.fit(spark, docs, labels)).collect()}
    assert all((got[k] >= 0.5) == (k % 4 == 0) for k in range(400))
    assert got[1000] == got[1001] < 0.5 <= got[1002] and got[None] >= 0.5


def test_quality_stage_drops_junk(spark, documents):
    docs, labels = _labelled(spark, documents)
    kept = op4_quality.keep_good(spark, docs, labels)
    assert kept.columns == docs.columns
    ids = {r[0] for r in kept.collect()}
    assert ids & set(range(400)) == {k for k in range(400) if k % 5}


def test_empty_tables(spark, documents):
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    docs = documents([(1, "a b", "s")])
    assert [r.score for r in op1_toxicity.score(spark, docs, op1_toxicity.fit(spark, docs, labels)).collect()] == [0.5]
    assert op4_quality.keep_good(spark, docs, labels).count() == 1
    assert op4_quality.keep_good(spark, documents([]), labels).count() == 0


def test_held_out_rows_are_never_learned_from(spark, documents):
    docs, labels = _labelled(spark, documents)
    flipped = labels.selectExpr("doc_id", "IF(crc32(CAST(CAST(doc_id AS string) AS binary)) % 5 = 0, 1 - quality, quality) quality",
                                "IF(crc32(CAST(CAST(doc_id AS string) AS binary)) % 5 = 0, 1 - toxic, toxic) toxic")
    a, b = op1_toxicity.fit(spark, docs, labels), op1_toxicity.fit(spark, docs, flipped)
    assert np.array_equal(a[0], b[0]) and np.array_equal(a[1], b[1])
    a, b = op4_quality.fit(docs, labels), op4_quality.fit(docs, flipped)
    assert np.array_equal(a.weights, b.weights) and a.cut == b.cut


def test_ftrl_equals_a_plain_loop():
    """One coordinate at a time, from the published update, on rows that overlap."""
    import math
    import random

    from tessera.llm import op1_toxicity as t
    rng = random.Random(3)
    rows = [(rng.randint(0, 1), np.array(sorted(rng.sample(range(40), rng.randint(0, 9))), dtype=np.int64)) for _ in range(120)]
    z, n = [0.0] * 40, [0.0] * 40
    bz = bn = 0.0

    def weight(z, n, l1, l2):
        return 0.0 if abs(z) <= l1 else -(z - math.copysign(l1, z)) / ((t.BETA + math.sqrt(n)) / t.ALPHA + l2)

    for _ in range(2):
        for label, x in rows:
            w, b = {int(i): weight(z[i], n[i], t.L1, t.L2) for i in x}, weight(bz, bn, 0.0, 0.0)
            g = 1 / (1 + math.exp(-(sum(w.values()) + b))) - label
            for i in w:
                s = (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / t.ALPHA
                z[i] += g - s * w[i]
                n[i] += g * g
            bz += g - (math.sqrt(bn + g * g) - math.sqrt(bn)) / t.ALPHA * b
            bn += g * g
    got, bias = t.ftrl(rows, 2)
    want = [weight(a, b, t.L1, t.L2) for a, b in zip(z, n)]
    assert np.allclose(got[:40], want) and not got[40:].any() and np.isclose(bias, weight(bz, bn, 0.0, 0.0))
    assert 0 < np.count_nonzero(want) < 40                      # the L1 bound leaves some at zero


def test_pairwise_fit_is_about_as_good_as_newton_on_all_pairs():
    from tessera.llm import op4_quality as q
    rng = np.random.default_rng(5)
    k = len(q.FEATURES)
    truth = rng.normal(size=k)
    x = rng.normal(size=(300, k))
    good = (x @ truth + rng.normal(size=300) * 2 > 0).astype(int)
    model = q.bradley_terry(x, good)
    z = np.clip((x - model.mean) / model.scale, -8, 8)
    diff = (z[good == 1][:, None] - z[good == 0][None]).reshape(-1, k)

    def loss(w):
        return np.logaddexp(0, -diff @ w).mean() + q.RIDGE / 2 * w @ w

    w = np.zeros(k)
    for _ in range(25):                                         # Newton's method over every pair
        p = 1 / (1 + np.exp(diff @ w))
        hessian = (diff * (p * (1 - p))[:, None]).T @ diff / len(diff) + q.RIDGE * np.eye(k)
        w += np.linalg.solve(hessian, (p[:, None] * diff).mean(axis=0) - q.RIDGE * w)
    assert loss(w) <= loss(model.weights) < loss(w) * 1.05 + 0.01 < loss(np.zeros(k))
    assert np.corrcoef(w, model.weights)[0, 1] > 0.97


def test_quality_is_learned_from_every_labelled_row_and_every_pair(spark):
    """24,000 rows, 100 million pairs: their statistics, the cut's rank, and a slope of nearly zero."""
    from tessera.llm import op4_quality as q
    docs = spark.range(0, 30_000, 1, 4).selectExpr(
        "id AS doc_id", "concat(repeat('word ', CAST(3 + id % 17 AS int)), repeat('## ', CAST(id * 7919 % 11 AS int)), 'End ', id % 23) AS text")
    labels = docs.selectExpr("doc_id", "IF(doc_id * 7919 % 11 + doc_id * 104729 % 13 < 9, 1, 0) AS quality")
    model = q.fit(docs, labels)
    rows = [(r.label, r.x) for r in q.training_features(docs, labels, "quality").collect()]
    good, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    assert len(rows) > 23_000 and np.allclose(model.mean, x.mean(axis=0)) and np.allclose(model.scale, x.std(axis=0) + 1e-6)
    assert (model.raw(x) < model.cut).sum() <= (good == 0).sum() <= (model.raw(x) <= model.cut + 1e-9).sum()
    block = q.bradley_terry(x, good)
    assert np.allclose(block.weights, model.weights, atol=1e-6) and np.isclose(block.cut, model.cut)
    z, lead = model.standard(x), model.raw(x)
    pairs = (good == 1).sum() * (good == 0).sum()
    slope = -q.RIDGE * model.weights                             # over all pairs, without a grid
    for part in np.array_split(np.flatnonzero(good == 1), 60):
        doubt = 1 / (1 + np.exp(np.clip(lead[part][:, None] - lead[good == 0][None], -700, 700)))
        slope += (doubt.sum(axis=1) @ z[part] - doubt.sum(axis=0) @ z[good == 0]) / pairs
    assert np.abs(slope).max() < 2 * q.FLAT


def test_cut_lies_between_the_ranks_of_all_rows(spark):
    from tessera.llm import op4_quality as q
    rng = random.Random(4)
    values = [rng.choice([0.25, rng.uniform(-3, 3), 1e-9 * rng.random()]) for _ in range(500)]
    scores = spark.createDataFrame([(v,) for v in values], "raw double").repartition(3).cache()
    ordered = sorted(values)
    for rank in (1, 100, 163, 300, 420, 499):
        assert q.cut_of(scores, rank) == (ordered[rank - 1] + ordered[rank]) / 2
    assert q.cut_of(scores.filter("raw = 0.25"), 3) == 0.25
