import random
import re

import numpy as np
import pytest
from conftest import SF_SMALL

from tessera.llm import op8_minhash as m

from .conftest import prose


def brute(rows):
    """Class ids of (doc_id, text) by comparing all pairs of exact shingle sets."""
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda x: x[0].lower(), t or ""))
        sets[i] = {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    comp = {i: i for i in sets}
    changed = True
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in links:
            low = min(comp[a], comp[b])
            changed |= comp[a] != low or comp[b] != low
            comp[a] = comp[b] = low
    return {i: (len(sets[i]), comp[i]) for i in sets}


def corpus():
    rng = random.Random(5)
    rows = []
    for g in range(6):          # groups of copies with ever more words replaced
        base = prose(g, 120)
        for k in range(12):
            w = list(base)
            for _ in range(k // 2):
                w[rng.randrange(len(w))] = f"new{rng.random()}"
            rows.append(" ".join(w))
    shared = prose(99, 40)      # a passage in many different texts
    rows += [" ".join(prose(200 + k, 100) + shared) for k in range(20)]
    rows += [" ".join(prose(300, 60))] * 15
    rows += ["", " \n", None, "one", "One", "a b c d", "a b c e", "a b c d e", "é É", "É é"]
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("block, links", [(512, 1_000_000), (4, 0)])
def test_classes_are_those_of_all_pairs(spark, documents, monkeypatch, block, links):
    monkeypatch.setattr(m, "BLOCK", block)   # 4: clusters of several blocks, strays against all
    monkeypatch.setattr(m, "LINKS_PER_TASK", links)   # 0: star contraction
    rows = corpus()
    got = m.near_duplicates(spark, documents([(i, t, "s") for i, t in rows])).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(rows)


def test_repeated_rows_null_ids_and_no_rows(spark, documents):
    text = " ".join(prose(1, 30))
    got = m.near_duplicates(spark, documents([(4, text, "s"), (4, text, "s"), (2, text, None), (None, text, "s"),
                                              (7, None, "s")])).collect()
    assert sorted((r.doc_id, r.component_id) for r in got if r.doc_id) == [(2, 2), (4, 2), (4, 2), (7, 7)]
    assert [r.component_id for r in got if r.doc_id is None] == [None]
    assert m.near_duplicates(spark, documents([])).count() == 0


def test_stage_keeps_one_row_of_each_class(spark, documents):
    text, other = " ".join(prose(1, 30)), " ".join(prose(2, 30))
    docs = documents([(4, text, "s"), (2, text, "s"), (9, other, "s"), (9, other, "s"), (None, text, "s"), (5, "", "s")])
    kept = m.keep_one(spark, docs)
    assert kept.columns == docs.columns
    assert sorted((r[0] is None, r[0] or 0) for r in kept.collect()) == [(False, 2), (False, 5), (False, 9), (True, 0)]


def test_signatures_within_the_distance_share_a_key():
    import numpy as np

    rng = np.random.default_rng(0)
    mins = rng.integers(0, 1 << 62, (300, m.SLOTS)).astype(np.uint64)
    for row in range(0, 300, 2):    # the second of each pair differs in exactly MAX_DISTANCE slots
        mins[row + 1] = mins[row]
        at = rng.choice(m.SLOTS, m.MAX_DISTANCE, replace=False)
        mins[row + 1, at] += np.uint64(1)
    keys = m.index_keys(mins)
    assert all(set(keys[r]) & set(keys[r + 1]) for r in range(0, 300, 2))


def test_query_columns(spark):
    got = m.op8_near_duplicates(spark, SF_SMALL)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]


@pytest.mark.parametrize("links", [1_000_000, 0])
def test_components_of_a_long_chain(spark, monkeypatch, links, scratch):
    monkeypatch.setattr(m, "LINKS_PER_TASK", links)
    rows = [(k, k + 1) for k in range(0, 40)] + [(101, 100), (100, 102), (102, 101), (7, 7)]
    edges = spark.createDataFrame(rows, "a bigint, b bigint")
    got = {r.id: r.comp for r in m.components(spark, edges).collect()}
    assert got == {k: 0 for k in range(41)} | {k: 100 for k in (100, 101, 102)}
    assert m.components(spark, edges.filter("a > 1000")).count() == 0


def test_signatures_of_unrelated_long_texts_lie_far_apart():
    """Low bytes agree by chance in one slot of 256, whatever the size of the sets."""
    rng = np.random.default_rng(9)
    for size in (200, 1000, 5000):
        sets = rng.integers(0, 1 << 63, (20, size), dtype=np.int64).astype(np.uint64)
        mins = m.minhashes(sets.ravel(), np.arange(20) * size)
        sig = (mins & np.uint64(0xFF)).astype(np.uint8)
        d = (sig[:, None] != sig[None]).sum(-1)[np.triu_indices(20, 1)]
        assert d.min() > 58 and d.mean() > 63


def test_minhashes_within_the_distance_share_a_key():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, (300, m.SLOTS), dtype=np.int64).astype(np.uint64)
    near = base.copy()
    for row in near:
        at = rng.choice(m.SLOTS, rng.integers(0, m.MAX_DISTANCE + 1), replace=False)
        row[at] ^= rng.integers(1, 1 << 62, len(at)).astype(np.uint64)
    shared = (m.index_keys(base) == m.index_keys(near)).any(axis=1)
    assert shared.all()
    assert not (m.index_keys(base[:-1]) == m.index_keys(base[1:])).any()


def test_a_common_passage_makes_no_cluster(spark, documents, monkeypatch):
    """Texts that share a passage of a quarter of their words are not dealt to one group."""
    from .conftest import prose
    passage, seen = prose(1, 120), []
    rows = [(i, " ".join(passage + prose(1000 + i, 360)), "s") for i in range(150)]
    real = m.block_tasks
    monkeypatch.setattr(m, "block_tasks", lambda members: (seen.append(members.count()), real(members))[1])
    got = m.near_duplicates(spark, documents(rows)).collect()
    assert all(r.component_id == r.doc_id for r in got) and seen[0] <= 10
