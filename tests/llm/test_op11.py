import hashlib
import random
import zlib

import pytest

from tessera.llm import op11_prefix_trie as m

SCHEMA = "conv_id bigint, turn bigint, role string, text string, Turn string, block int, k1 string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 3, "clash") for r in rows], SCHEMA)


def originals(rows):
    out = {}
    for c, t, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            out.setdefault(c, []).append(((t is not None, t or 0, digest), (role, text)))
    return {c: [x for _, x in sorted(v, key=lambda y: y[0])] for c, v in out.items()}


def rebuilt(convs):
    out = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        out[c] = convs.get(base, [])[:h] + turns[h:]
    return out


def brute(convs):
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children = {}
    for p in members:
        if p:
            children.setdefault(p[:-1], []).append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[c] for c in children.get(p, [])) or 1
        own = (len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0
        saved[p] = own + sum(saved[c] for c in children.get(p, []))
    return sorted((min(ms), len(p), min(members[p[:-1]]) if p else -1, len(ms), len(children.get(p, [])), leaves[p], saved[p],
                   hashlib.sha256(",".join(map(str, sorted(c for c in ms if len(convs[c]) == len(p)))).encode()).hexdigest())
                  for p, ms in members.items())


def result(df):
    return sorted((r.conv_id, r.depth, -1 if r.parent_conv_id is None else r.parent_conv_id, r.n_convs, r.n_children,
                   r.n_leaves, r.saved_tokens, r.ends_sha256) for r in df.collect())


def conversations(seed, n=60, longest=70):
    """Random conversations with long shared beginnings, nulls, ties, repeated rows and negative ids."""
    rng = random.Random(seed)
    rows, trunk = [], [rng.choice(["é?", "yes", "", "no way"]) + str(i % 7) for i in range(longest)]
    for c in rng.sample(range(-30, 200), n):
        cut, size = rng.randint(0, longest), rng.choice([0, 1, 3, 8, 9, 16, 17, longest])
        texts = (trunk[:cut] + [f"own {rng.randint(0, 2)}" for _ in range(longest)])[:size]
        rows += [(c, None if i == 0 and c % 3 == 0 else i, rng.choice(["user", None]) if i > 40 else "user", t) for i, t in enumerate(texts)]
        if c % 7 == 0:
            rows += [(c, 1, "user", "tie"), (c, 1, "user", "tie"), (c, 1, "assistant", None), (None, 1, "user", "nobody")]
    return rows


@pytest.mark.parametrize("seed, chunk", [(1, 65_536), (2, 3)])
def test_equals_brute_force(spark, monkeypatch, seed, chunk):
    monkeypatch.setattr(m, "CHUNK", chunk)
    rows = conversations(seed)
    df = frame(spark, rows)
    assert result(m.prefix_trie(spark, df)) == brute(originals(rows))
    turns = m.numbered(spark, m.turns_of(df))
    assert result(m.trie(spark, m.rebuilt(turns))) == brute(rebuilt(originals(rows)))


def test_a_hot_conversation_is_numbered_over_partitions(spark):
    rows = [(5, i, "user", f"t{i}") for i in range(3000)] + [(6, 0, "user", "t0"), (6, 1, "user", "x")]
    numbered = m.numbered(spark, m.turns_of(frame(spark, rows)))
    assert sorted(r.pos for r in numbered.filter("conv_id = 5").collect()) == list(range(3000))
    got = {(r.conv_id, r.depth): r for r in m.trie(spark, numbered).collect()}
    assert len(got) == 3002 and got[5, 0].n_leaves == 2 and got[5, 1].n_convs == 2 and got[5, 0].saved_tokens == 2
    assert got[5, 2999].n_children == 1 and got[5, 3000].n_children == 0


def test_no_rows_and_rows_without_ids(spark):
    assert m.prefix_trie(spark, frame(spark, [])).count() == 0
    assert m.prefix_trie(spark, frame(spark, [(None, 1, "user", "x")])).count() == 0
