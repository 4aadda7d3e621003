"""Vectorised word hashing over Arrow string batches.

One pass of numpy over the UTF-8 bytes of many texts finds the words and gives
each a 64-bit hash, so no Python code runs per word.  Word characters are all
bytes outside a set of ASCII separators; bytes of multi-byte characters are
never ASCII, so working on bytes and on code points gives the same words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
#: Bytes of text handled at once; temporaries take about 40 times as much.
BLOCK_BYTES = 1 << 19


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (multiply / xor-shift), wrapping arithmetic."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def separators(*ranges: tuple[int, int]) -> np.ndarray:
    """Boolean table of 256 bytes: True for word bytes, False inside the ranges."""
    table = np.ones(256, dtype=bool)
    for lo, hi in ranges:
        table[lo:hi + 1] = False
    return table


#: Words as runs of anything but ASCII white space: [^\x20\x09-\x0D]+
NON_SPACE = separators((0x20, 0x20), (0x09, 0x0D))
#: Words as runs of ASCII letters, digits and non-ASCII characters.
ALNUM = separators((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F))

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_BYTE_HASH = mix(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15))
_BASE, _INVERSE = 0x5851F42D4C957F2D, pow(0x5851F42D4C957F2D, -1, 1 << 64)


class _Powers:
    """Powers of an odd base modulo 2**64, grown on demand."""

    def __init__(self, base: int):
        self.base, self.table = base, np.ones(1, dtype=U64)

    def upto(self, n: int) -> np.ndarray:
        while len(self.table) < n:
            step = U64(pow(self.base, len(self.table), 1 << 64))
            self.table = np.concatenate([self.table, self.table * step])
        return self.table[:n]


_POWERS, _INVERSES = _Powers(_BASE), _Powers(_INVERSE)


@dataclass
class Words:
    """Words of a block of texts: hash of each, and where each text's words begin."""

    hashes: np.ndarray   # uint64, one per word, in reading order
    bounds: np.ndarray   # int64, texts + 1: words of text i are bounds[i]:bounds[i + 1]
    data: np.ndarray     # bytes of the block, lower-cased if asked for
    offsets: np.ndarray  # int64, texts + 1: bytes of text i
    starts: np.ndarray   # int64, first byte of each word
    ends: np.ndarray     # int64, byte after each word

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)


def blocks(texts: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first, last + 1, bytes, offsets) of runs of texts; a longer text is a run of its own.

    Null texts are empty.
    """
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    n = len(texts)
    if not n:
        return
    _, offs, data = texts.buffers()
    offsets = np.frombuffer(offs, dtype=np.int64)[texts.offset:texts.offset + n + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last, data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first]
        first = last


def words(data: np.ndarray, offsets: np.ndarray, word_byte: np.ndarray, lower: bool = True) -> Words:
    """Lower-case A-Z (unless told not to), split into words and hash each word."""
    data = _LOWER[data] if lower else data
    inside = np.zeros(len(data) + 1, dtype=bool)
    inside[:-1] = word_byte[data]
    before = np.zeros(len(data) + 1, dtype=bool)
    before[1:] = inside[:-1]
    before[offsets] = False                       # a text begins: nothing stands before it
    starts = np.flatnonzero(inside & ~before)
    after = inside.copy()                         # after[i]: byte i goes on with the word
    after[offsets] = False
    ends = np.flatnonzero(inside[:-1] & ~after[1:]) + 1
    prefix = np.zeros(len(data) + 1, dtype=U64)
    np.cumsum(_BYTE_HASH[data] * _POWERS.upto(len(data)), out=prefix[1:])
    hashes = (prefix[ends] - prefix[starts]) * _INVERSES.upto(len(data) + 1)[starts]
    hashes = mix(hashes + (ends - starts).astype(U64))
    bounds = np.searchsorted(starts, offsets)
    return Words(hashes, bounds, data, offsets, starts, ends)


def chain(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` consecutive words, ignoring text bounds."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=U64)
    out = np.zeros(n, dtype=U64)
    for j in range(width):
        out = mix(out * U64(0x9E3779B97F4A7C15) + hashes[j:j + n])
    return out
