"""Personal data by anchor expansion.

An Aho-Corasick automaton finds the *anchors* of a text in one pass: at-signs,
plus signs, digits, URL schemes and identifier cues.  Text without anchors, which
is nearly all of it, is never looked at again.  Each anchor is handed to a small
deterministic parser that expands to the left and right, then validates:

* ``@``: local part to the left, dotted domain to the right -> ``email``
* a digit: dotted quads -> ``ip``, digits with single blanks or hyphens that pass
  the Luhn check -> ``card``
* ``+``: the number it introduces -> ``phone``
* ``http://``, ``https://``, ``ftp://`` -> ``url``
* ``password``, ``token``, ``secret``, ``api_key``, ... followed by ``=`` or ``:``
  -> ``secret`` (the value); ``AKIA`` -> ``secret`` (an access key)
* ``account``, ``iban``, ``ssn``, ``passport`` and a value with digits -> ``account``

The first four kinds are exactly the leftmost non-overlapping matches, per kind,
of the patterns that the tests state; a match that fails its check is consumed.
Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import hashlib
import string
from collections.abc import Iterator
from functools import lru_cache, partial

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import pick, position, tag

BASE = ("email", "ip", "card", "phone")
KINDS = BASE + ("url", "secret", "account")

_DIGIT = frozenset(string.digits)
_LABEL = frozenset(string.ascii_letters + string.digits + "-")
_LOCAL = _LABEL | frozenset("._%+")
_PHONE = _DIGIT | frozenset(" ().-")
_VALUE = frozenset(string.ascii_letters + string.digits + "_-./+=")
_URL = frozenset(string.ascii_letters + string.digits + "-._~:/?#[]@!$&'()*+,;=%")
_SECRET_CUES = ("password", "passwd", "token", "secret", "api_key", "apikey", "access_key")
_ACCOUNT_CUES = ("account", "iban", "ssn", "passport")
_SCHEMES = ("http://", "https://", "ftp://")

Span = tuple[str, int, int]


@lru_cache(maxsize=1)
def automaton():
    """Anchors to their parser; built once per worker."""
    import ahocorasick

    found = ahocorasick.Automaton()
    for digit in string.digits:
        found.add_word(digit, ("digit", 1))
    found.add_word("@", ("email", 1))
    found.add_word("+", ("phone", 1))
    found.add_word("AKIA", ("key", 4))
    for kind, cues in (("url", _SCHEMES), ("secret", _SECRET_CUES), ("account", _ACCOUNT_CUES)):
        for cue in cues:
            for form in {cue, cue.upper(), cue.capitalize()}:
                found.add_word(form, (kind, len(form)))
    found.make_automaton()
    return found


def _while(text: str, at: int, allowed: frozenset) -> int:
    while at < len(text) and text[at] in allowed:
        at += 1
    return at


def email_at(text: str, sign: int, floor: int) -> tuple[int, int] | None:
    """Mailbox around the at-sign; its local part may not reach below ``floor``."""
    start = sign
    while start > floor and text[start - 1] in _LOCAL:
        start -= 1
    end = _while(text, sign + 1, _LABEL)
    if start == sign or end == sign + 1:
        return None
    domain = end
    while end < len(text) and text[end] == ".":
        label = _while(text, end + 1, _LABEL)
        if label == end + 1:
            break
        end = label
    return (start, end) if end > domain else None


def quad_at(text: str, start: int) -> tuple[int, bool] | None:
    """End of the four dotted numbers that start here, and whether all are at most 255."""
    end, fits = start, True
    for part in range(4):
        if part:
            if end >= len(text) or text[end] != ".":
                return None
            end += 1
        stop = _while(text, end, _DIGIT)
        if stop == end:
            return None
        fits &= int(text[max(end, stop - 18):stop]) <= 255 and not text[end:max(end, stop - 18)].strip("0")
        end = stop
    return end, fits


def digits_at(text: str, start: int) -> int:
    """End of the digits, single blanks or hyphens between them, that start here."""
    end = start + 1
    while end < len(text):
        if text[end] in _DIGIT:
            end += 1
        elif text[end] in " -" and end + 1 < len(text) and text[end + 1] in _DIGIT:
            end += 2
        else:
            break
    return end


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def phone_at(text: str, plus: int) -> int | None:
    """End of the number after a plus sign: a digit, anything of a number, a digit."""
    if plus + 1 >= len(text) or text[plus + 1] not in _DIGIT:
        return None
    end = _while(text, plus + 2, _PHONE)
    while end > plus + 3 and text[end - 1] not in _DIGIT:
        end -= 1
    return end if end > plus + 3 and text[end - 1] in _DIGIT else None


def _cue_end(text: str, at: int, needs_sign: bool) -> int | None:
    """Where the value after a cue begins: behind an optional quote and blank, ``=`` or ``:``."""
    i = at
    while i < len(text) and i < at + 3 and text[i] in " \"'":
        i += 1
    if i < len(text) and text[i] in "=:":
        i += 1
        while i < len(text) and i < at + 8 and text[i] in " \"'":
            i += 1
    elif needs_sign or i == at:
        return None
    return i


class _Run:
    """The run of allowed characters last looked at, so that none is read twice however many
    anchors it holds: its end, its end without trailing marks, and its last digit."""

    def __init__(self, allowed: frozenset, trailing: str = ""):
        self.allowed, self.trailing, self.start, self.end = allowed, trailing, 0, -1

    def at(self, text: str, i: int) -> _Run:
        if not self.start <= i <= self.end:
            self.start, self.end = i, _while(text, i, self.allowed)
            self.trimmed = self.end
            while self.trimmed > i and text[self.trimmed - 1] in self.trailing:
                self.trimmed -= 1
            self.digit = self.trimmed - 1
            while self.digit >= i and text[self.digit] not in _DIGIT:
                self.digit -= 1
        return self


def spans(text: str | None) -> list[Span]:
    """All spans of a text, by kind as listed, then start."""
    found: dict[str, list[Span]] = {k: [] for k in KINDS}
    if not text:
        return []
    done = dict.fromkeys(KINDS, 0)  # end of the last match per kind, failed ones included
    runs = 0                        # end of the digits last looked at
    keys, values = _Run(_LABEL - {"-"}), _Run(_VALUE, "./-=")
    for last, (kind, size) in automaton().iter(text):
        at = last - size + 1
        if kind == "digit":
            if at < runs:
                continue
            runs = _while(text, at, _DIGIT)
            if at >= done["card"] and (end := digits_at(text, at)) > at + 1:
                done["card"] = end
                only = "".join(c for c in text[at:end] if c in _DIGIT)
                if 13 <= len(only) <= 19 and luhn(only):
                    found["card"].append(("card", at, end))
            if at >= done["ip"] and (quad := quad_at(text, at)):
                done["ip"] = quad[0]
                if quad[1]:
                    found["ip"].append(("ip", at, quad[0]))
        elif kind == "email":
            if at >= done["email"] and (box := email_at(text, at, done["email"])):
                done["email"] = box[1]
                found["email"].append(("email", *box))
        elif kind == "phone":
            if at >= done["phone"] and (end := phone_at(text, at)):
                done["phone"] = end
                if 9 <= sum(c in _DIGIT for c in text[at:end]) <= 15:
                    found["phone"].append(("phone", at, end))
        elif kind == "url":
            if at >= done["url"] and (at == 0 or not text[at - 1].isalnum()):
                end = _while(text, last + 1, _URL)
                while end > last + 1 and text[end - 1] in ".,;:!?)'":
                    end -= 1
                if end > last + 1:
                    done["url"] = end
                    found["url"].append(("url", at, end))
        elif kind == "key":
            end = keys.at(text, at).end
            if end - at == 20 and at >= done["secret"]:
                done["secret"] = end
                found["secret"].append(("secret", at, end))
        else:
            start = _cue_end(text, last + 1, kind == "secret")
            if start is not None and start >= done[kind]:
                run = values.at(text, start)
                if run.trimmed - start >= 6 and run.digit >= start:
                    done[kind] = run.trimmed
                    found[kind].append((kind, start, run.trimmed))
    return [s for k in KINDS for s in sorted(found[k], key=lambda s: s[1])]


def joined(found: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in found)


def redact(text: str | None, found: list[Span]) -> str | None:
    """The text with every span replaced by its kind; overlapping spans become one,
    named after the kind that starts first (of equal starts, the longer)."""
    if not found:
        return text
    out, at = [], 0
    for kind, start, end in sorted(found, key=lambda s: (s[1], -s[2], KINDS.index(s[0]))):
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first in range(0, batch.num_rows, rows):
            yield batch.slice(first, rows)


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _slices(batches):
        rows = [spans(t.as_py()) for t in batch.column("text")]
        base = [joined([s for s in r if s[0] in BASE]) for r in rows]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id")]
            + [pa.array([sum(s[0] == k for s in r) for r in rows], pa.int64()) for k in BASE]
            + [pa.array([hashlib.sha256(b.encode()).hexdigest() for b in base], pa.string()),
               pa.array([joined(r) for r in rows], pa.string())],
            names=["doc_id", *[f"n_{k}" for k in BASE], "base_sha256", "spans"])


def find(docs: DataFrame) -> DataFrame:
    """One row per document: counts of the base kinds, their digest, all spans.

    A null or empty text has no spans: zero counts, the digest of empty text.
    """
    ids = pick(docs, doc_id="doc_id", text="text").select(F.col("doc_id").cast("bigint"), "text")
    return ids.mapInArrow(_find, "doc_id bigint, " + ", ".join(f"n_{k} bigint" for k in BASE)
                          + ", base_sha256 string, spans string")


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: personal data in every text of ``documents``."""
    return find(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def _redact(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    for batch in _slices(batches):
        at = batch.schema.get_field_index(column)
        texts = batch.column(at).to_pylist()
        clean = pa.array([redact(t, spans(t)) for t in texts], batch.schema.field(at).type)
        yield batch.set_column(at, batch.schema.field(at), clean)


def without_pii(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Pipeline stage: every document stays, its spans replaced by ``[KIND]``.

    ``n_chars``, where the table has it, becomes the new text's length; the
    other columns stay as they are.
    """
    names = docs.columns
    tagged = tag(docs)
    text = f"c{position(names, 'text')}"
    clean = tagged.mapInArrow(partial(_redact, column=text), tagged.schema)
    if "n_chars" in [n.lower() for n in names]:
        size = f"c{position(names, 'n_chars')}"
        clean = clean.withColumn(size, F.length(text).cast(tagged.schema[size].dataType))
    return clean.toDF(*names)
