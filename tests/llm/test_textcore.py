import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import textcore as T

TEXT = st.text(alphabet="aBzÉ9_ .,\n\t é漢", max_size=30)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), TEXT), max_size=6))
def test_words_are_the_patterns(texts):
    for table, pattern in ((T.NON_SPACE, r"[^\x20\x09-\x0D]+"),
                           (T.ALNUM, r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")):
        seen: dict[str, int] = {}
        for first, last, data, offsets in T.blocks(pa.array(texts, pa.string()), limit=16):
            w = T.words(data, offsets, table)
            for k in range(first, last):
                want = [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in re.findall(pattern, texts[k] or "")]
                got = w.hashes[w.bounds[k - first]:w.bounds[k - first + 1]].tolist()
                assert len(got) == len(want)
                for word, h in zip(want, got):
                    assert seen.setdefault(word, h) == h
        assert len(set(seen.values())) == len(seen)


def test_blocks_cover_slices_and_long_texts():
    texts = pa.array(["x" * 5, None, "", "y" * 100, "z"]).slice(1)
    got = [(a, b, bytes(d), o.tolist()) for a, b, d, o in T.blocks(texts, limit=10)]
    assert [g[:2] for g in got] == [(0, 2), (2, 3), (3, 4)]
    assert b"".join(g[2] for g in got) == b"y" * 100 + b"z"
    assert not list(T.blocks(pa.array([], pa.string())))


def test_chain_depends_on_order():
    h = np.array([1, 2, 3, 1, 2, 3, 2, 1], dtype=np.uint64)
    runs = T.chain(h, 3)
    assert runs[0] == runs[3] and len(set(runs.tolist())) == 5
