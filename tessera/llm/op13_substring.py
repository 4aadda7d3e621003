"""Removal of repeated passages: fixed-block anchors, extended to maximal exact repeats.

Method
------
1. Equal texts are one text, owned by its smallest doc_id; the other copies are wholly
   repeated.  Distinct texts are written once, in *packs* of some megabytes, as a table
   bucketed by pack: the three steps that read it bring small tables to it and never
   shuffle a text again.
2. Index and probe: the non-overlapping blocks of ``BLOCK`` words of every text (at 0,
   BLOCK, 2 * BLOCK, ..) are the index; every rolling window of BLOCK words probes it.
   A repeat of ``WINDOW`` >= 2 * BLOCK - 1 words holds a whole block of each of its
   occurrences, so all its occurrences are hit by it.  A pack sends its distinct windows
   once, as 38 bits beside their hash range, marked where they are blocks or occur twice.
   A window is *live* if it is somewhere a block and occurs in two places.
3. Extension: a live hit is extended by 0 to WINDOW - BLOCK words to the left and the rest
   to the right; an extension is named by the 96 bits of its two halves.  Of each name a
   pack sends its first occurrence, in the order of (doc_id, text digest, position), and
   gets back which of them are first of all.  The others are repeats, and runs of repeats
   that overlap are maximal repeated spans.

Skew: a passage that is in a third of all texts costs one row entry for each pack, not for
each occurrence, and no pair of occurrences is ever made.  Windows are equal up to a
collision of their hashes.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import pick, written
from tessera.llm.textcore import NON_SPACE, U64, blocks, chain, words
from tessera.session import scratch_path

WINDOW, BLOCK = 20, 10
#: Bytes of text in a bucket, packs in a bucket, and window hashes that a task compares at once.
BUCKET_BYTES, PACKS_PER_BUCKET, RANGE_WORDS = 32 << 20, 4, 1_000_000
LOW = U64((1 << 38) - 1)
LAST_ID = np.iinfo(np.int64).max
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def texts_of(docs: DataFrame) -> DataFrame:
    """(doc_id, h, text) with a digest of the text; a null text is empty."""
    text = F.coalesce("text", F.lit(""))
    return pick(docs, doc_id="doc_id", text="text").select(
        F.col("doc_id").cast("bigint"), F.unhex(F.md5(text.cast("binary"))).alias("h"), text.alias("text"))


def _once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's distinct texts at first sight; smaller ids seen later follow without the text."""
    least: dict[bytes, int] = {}
    smaller: dict[bytes, int] = {}
    schema = pa.schema([("doc_id", pa.int64()), ("h", pa.binary()), ("text", pa.string())])
    for batch in batches:
        fresh = []
        for i, (doc, h) in enumerate(zip(batch.column("doc_id").to_pylist(), batch.column("h").to_pylist())):
            doc = LAST_ID if doc is None else doc
            if h not in least:
                least[h] = doc
                fresh.append(i)
            elif doc < least[h]:
                least[h] = smaller[h] = doc
        taken = batch.take(pa.array(fresh, pa.int64()))
        yield pa.RecordBatch.from_arrays([taken.column(n) for n in schema.names], schema=schema)
    if smaller:
        yield pa.RecordBatch.from_arrays([pa.array(list(smaller.values()), pa.int64()), pa.array(list(smaller), pa.binary()),
                                          pa.nulls(len(smaller), pa.string())], schema=schema)


@dataclass
class Sizes:
    buckets: int
    packs: int
    ranges: int


def packed(spark: SparkSession, texts: DataFrame) -> tuple[str, Sizes]:
    """Name of the bucketed table (pack, doc_id, h, text) of distinct texts, and how it is dealt."""
    size, n = texts.agg(F.sum(F.octet_length("text")), F.count("*")).first()
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(parts, -(-(size or 0) // BUCKET_BYTES))
    sizes = Sizes(buckets, buckets * PACKS_PER_BUCKET, max(1, -(-(size or 0) // (6 * RANGE_WORDS))))
    name = f"tessera_texts_{uuid.uuid4().hex[:12]}"
    (texts.mapInArrow(_once, "doc_id bigint, h binary, text string")
     .withColumn("pack", F.pmod(F.xxhash64("h"), F.lit(sizes.packs)).cast("int"))
     .repartition(buckets, "pack").write.format("parquet").option("compression", "zstd")
     .option("path", scratch_path(spark, "sub-texts")).bucketBy(buckets, "pack").saveAsTable(name))
    return name, sizes


@dataclass
class Pack:
    """Distinct texts of a pack in the order of (doc_id, digest), and their words."""

    ids: list[int]
    digests: list[bytes]
    texts: pa.Array
    bounds: np.ndarray   # words of text i are bounds[i]:bounds[i + 1]
    grams: np.ndarray    # hash of the BLOCK words from each word on; 0 where the text ends before

    @classmethod
    def load(cls, table: pa.Table) -> Pack:
        owner: dict[bytes, int] = {}
        at: dict[bytes, int] = {}
        whole = table.column("text").combine_chunks()
        there = whole.is_valid().to_pylist()
        for i, (doc, h) in enumerate(zip(table.column("doc_id").to_pylist(), table.column("h").to_pylist())):
            doc = LAST_ID if doc is None else doc
            owner[h] = min(doc, owner.get(h, LAST_ID))
            if there[i]:
                at[h] = i
        order = sorted(owner, key=lambda h: (owner[h], h))
        texts = whole.take(pa.array([at[h] for h in order], pa.int64()))
        grams, counts = [], []
        for _, _, data, offsets in blocks(texts):
            w = words(data, offsets, NON_SPACE, lower=False)
            runs = np.zeros(len(w.hashes), dtype=U64)
            found = chain(w.hashes, BLOCK)
            runs[:len(found)] = np.maximum(found, U64(1))
            ends = np.repeat(w.bounds[1:], w.counts)
            runs[np.arange(len(runs)) + BLOCK > ends] = 0
            grams.append(runs)
            counts.append(w.counts)
        bounds = np.concatenate([[0], np.cumsum(np.concatenate(counts))]) if counts else np.zeros(1, np.int64)
        return cls([owner[h] for h in order], order, texts, bounds.astype(np.int64),
                   np.concatenate(grams) if grams else np.zeros(0, U64))

    @property
    def starts(self) -> np.ndarray:
        """For each word, where its text's words begin."""
        return np.repeat(self.bounds[:-1], np.diff(self.bounds))


def range_of(grams: np.ndarray, ranges: int) -> np.ndarray:
    return ((grams >> U64(32)) * U64(ranges)) >> U64(32)


def code(grams: np.ndarray, ranges: int) -> np.ndarray:
    """Hash range and 38 further bits, as two halves of a number."""
    return (range_of(grams, ranges) << U64(38)) | (grams & LOW)


def five_bytes(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]).tobytes()


def of_five_bytes(raw: bytes) -> np.ndarray:
    wide = np.zeros((len(raw) // 5, 8), dtype=np.uint8)
    wide[:, :5] = np.frombuffer(raw, np.uint8).reshape(-1, 5)
    return wide.view("<u8").ravel().astype(U64)


def _rows(rows: list[tuple], *kinds: tuple[str, pa.DataType]) -> pa.Table:
    columns = zip(*rows) if rows else [[]] * len(kinds)
    return pa.table({n: pa.array(c, t) for c, (n, t) in zip(columns, kinds)})


def _probe(table: pa.Table, ranges: int) -> pa.Table:
    """A pack's distinct windows by hash range: 38 bits, then "is a block", "occurs twice"."""
    pack = Pack.load(table)
    at = np.flatnonzero(pack.grams)
    aligned = (at - pack.starts[at]) % BLOCK == 0
    order = np.argsort(pack.grams[at], kind="stable")
    grams, aligned = pack.grams[at][order], aligned[order]
    first = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]])) if len(grams) else np.zeros(0, np.int64)
    count = np.diff(np.append(first, len(grams)))
    block = np.logical_or.reduceat(aligned, first) if len(first) else aligned
    grams = grams[first]
    keys = ((grams & LOW) << U64(2)) | (block.astype(U64) << U64(1)) | (count > 1).astype(U64)
    where = range_of(grams, ranges)  # ascending, as the hashes are
    cut = np.flatnonzero(np.concatenate([[True], where[1:] != where[:-1]])) if len(where) else []
    ends = np.append(cut[1:], len(where)) if len(where) else []
    b = table.column("pack")[0].as_py()
    return _rows([(int(where[i]), b, five_bytes(keys[i:j])) for i, j in zip(cut, ends)],
                 ("range", pa.int32()), ("pack", pa.int32()), ("keys", pa.binary()))


def _match(table: pa.Table) -> pa.Table:
    """Windows of a hash range that are live, for each pack that has them."""
    packs, raw = table.column("pack").to_pylist(), table.column("keys").to_pylist()
    parts = [of_five_bytes(r) for r in raw]
    keys = np.concatenate(parts)
    values, at = np.unique(keys >> U64(2), return_inverse=True)
    live = np.bincount(at, weights=((keys >> U64(1)) & U64(1)).astype(float), minlength=len(values)) > 0
    live &= np.bincount(at, weights=1.0 + (keys & U64(1)).astype(float), minlength=len(values)) > 1
    keep, r, out, lo = live[at], table.column("range")[0].as_py(), [], 0
    for b, part in zip(packs, parts):
        mine = part[keep[lo:lo + len(part)]] >> U64(2)
        lo += len(part)
        if len(mine):
            out.append((b, r, five_bytes(mine)))
    return _rows(out, ("pack", pa.int32()), ("range", pa.int32()), ("live", pa.binary()))


def _candidates(pack: Pack, replies: pa.Table, ranges: int) -> np.ndarray:
    """Words at which a window begins that holds a live hit, inside one text."""
    live = [(U64(r) << U64(38)) | of_five_bytes(raw) for r, raw in
            zip(replies.column("range").to_pylist(), replies.column("live").to_pylist()) if raw is not None]
    if not live or not len(pack.grams):
        return np.zeros(0, np.int64)
    live = np.sort(np.concatenate(live))
    codes = code(pack.grams, ranges)
    spot = np.minimum(np.searchsorted(live, codes), len(live) - 1)
    hits = np.flatnonzero((live[spot] == codes) & (pack.grams > 0))
    step = np.zeros(len(pack.grams) + 1, dtype=np.int64)
    np.add.at(step, np.maximum(hits - (WINDOW - BLOCK), pack.starts[hits]), 1)
    np.add.at(step, hits + 1, -1)
    ends = np.repeat(pack.bounds[1:], np.diff(pack.bounds))
    return np.flatnonzero((np.cumsum(step[:-1]) > 0) & (np.arange(len(pack.grams)) + WINDOW <= ends))


def _halves(pack: Pack, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return pack.grams[at], (pack.grams[at + WINDOW - BLOCK] & U64(0xFFFFFFFF)).astype(np.uint32)


def _firsts(pack: Pack, at: np.ndarray) -> np.ndarray:
    """Of windows at ``at`` (ascending), the first occurrence of each in the pack."""
    left, right = _halves(pack, at)
    order = np.lexsort((at, right, left))
    left, right = left[order], right[order]
    new = np.concatenate([[True], (left[1:] != left[:-1]) | (right[1:] != right[:-1])]) if len(at) else np.zeros(0, bool)
    return np.sort(at[order[new]])


def _extend(table: pa.Table, replies: pa.Table, ranges: int) -> pa.Table:
    """The first occurrence in the pack of each window around a live hit, by hash range."""
    if not len(table):
        return _rows([], *_EXTENSION)
    pack, b = Pack.load(table), table.column("pack")[0].as_py()
    at = _firsts(pack, _candidates(pack, replies, ranges))
    left, right = _halves(pack, at)
    text = np.searchsorted(pack.bounds, at, side="right") - 1
    ids = np.array(pack.ids, dtype=np.int64)[text]
    ties = np.frombuffer(b"".join(h[:8] for h in pack.digests), ">u8").astype(U64)[text]
    where = range_of(left, ranges)
    order = np.argsort(where, kind="stable")
    where = where[order]
    cut = np.flatnonzero(np.concatenate([[True], where[1:] != where[:-1]])) if len(where) else []
    out = []
    for i, j in zip(cut, np.append(cut[1:], len(where)) if len(where) else []):
        o = order[i:j]
        out.append((int(where[i]), b, left[o].tobytes(), right[o].tobytes(), ids[o].tobytes(), ties[o].tobytes(),
                    at[o].astype(np.uint32).tobytes()))
    return _rows(out, *_EXTENSION)


_EXTENSION = (("range", pa.int32()), ("pack", pa.int32()), ("left", pa.binary()), ("right", pa.binary()),
              ("ids", pa.binary()), ("ties", pa.binary()), ("at", pa.binary()))


def _first_of_all(table: pa.Table) -> pa.Table:
    """For each pack, where it has the first occurrence of a window among all packs."""
    def column(name: str, kind) -> np.ndarray:
        return np.frombuffer(b"".join(table.column(name).to_pylist()), kind)

    left, right, at = column("left", U64), column("right", np.uint32), column("at", np.uint32)
    order = np.lexsort((column("ties", U64), column("ids", np.int64), right, left))
    left, right = left[order], right[order]
    new = np.concatenate([[True], (left[1:] != left[:-1]) | (right[1:] != right[:-1])])
    first = np.zeros(len(at), dtype=bool)
    first[order[new]] = True
    out, lo = [], 0
    for b, raw in zip(table.column("pack").to_pylist(), table.column("at").to_pylist()):
        n = len(raw) // 4
        mine = at[lo:lo + n][first[lo:lo + n]]
        lo += n
        if len(mine):
            out.append((b, mine.tobytes()))
    return _rows(out, ("pack", pa.int32()), ("first", pa.binary()))


def _judge(table: pa.Table, replies: pa.Table, ranges: int, keep_text: bool) -> pa.Table:
    """Each distinct text: its owner, words, repeated spans, and what is kept."""
    if not len(table):
        return _rows([], *_JUDGED)
    pack = Pack.load(table)
    at = _candidates(pack, replies, ranges)
    first = [np.frombuffer(raw, np.uint32) for raw in replies.column("first").to_pylist() if raw is not None]
    late = at[~np.isin(at, np.concatenate(first).astype(np.int64))] if first else at
    step = np.zeros(len(pack.grams) + WINDOW + 1, dtype=np.int64)
    np.add.at(step, late, 1)
    np.add.at(step, late + WINDOW, -1)
    gone = np.cumsum(step)[:len(pack.grams)] > 0
    out = []
    for i, (doc, h, lo, hi) in enumerate(zip(pack.ids, pack.digests, pack.bounds[:-1], pack.bounds[1:])):
        mask, found = gone[lo:hi], pack.texts[i].as_py().encode("utf-8").split()
        edge = np.flatnonzero(np.diff(np.concatenate([[0], mask.view(np.int8), [0]])))
        kept = b" ".join([w for w, m in zip(found, mask.tolist()) if not m] if len(edge) else found)
        out.append((h, doc, len(found), int(mask.sum()),
                    [{"begin": int(s), "end": int(e)} for s, e in zip(edge[::2], edge[1::2])],
                    hashlib.sha256(kept).hexdigest(), kept.decode("utf-8") if keep_text else None))
    return _rows(out, *_JUDGED)


_SPAN = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
_JUDGED = (("h", pa.binary()), ("owner", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("spans", _SPAN),
           ("kept_sha256", pa.string()), ("kept_text", pa.string()))
_JUDGED_SQL = ("h binary, owner bigint, n_words bigint, n_removed bigint, spans array<struct<begin:bigint,end:bigint>>, "
               "kept_sha256 string, kept_text string")


def repeats(spark: SparkSession, docs: DataFrame, keep_text: bool = True) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_removed, spans (begin, end: words of each maximal
    repeated span), kept_sha256 and, if asked for, kept_text (kept words joined by one space).

    Null, empty and blank texts have no words.  Documents of one id and rows with a null id
    (the largest of all) stand in the order of their text's digest; of rows equal in id
    and text, one is first and the others are wholly repeated.
    """
    texts = texts_of(docs)
    name, sizes = packed(spark, texts)
    try:
        table = spark.table(name)
        n = sizes.ranges  # functions without hints take and give whole tables
        probes = table.groupBy("pack").applyInArrow(lambda texts: _probe(texts, n), "range int, pack int, keys binary")
        live = written(spark, probes.groupBy("range").applyInArrow(_match, "pack int, range int, live binary"), "sub-live")
        windows = table.groupBy("pack").cogroup(live.groupBy("pack")).applyInArrow(
            lambda texts, replies: _extend(texts, replies, n),
            "range int, pack int, left binary, right binary, ids binary, ties binary, at binary")
        first = written(spark, windows.groupBy("range").applyInArrow(_first_of_all, "pack int, first binary"), "sub-first")
        replies = live.withColumn("first", F.lit(None).cast("binary")).unionByName(first, allowMissingColumns=True)
        judged = written(spark, table.groupBy("pack").cogroup(replies.groupBy("pack")).applyInArrow(
            lambda texts, replies: _judge(texts, replies, n, keep_text), _JUDGED_SQL), "sub-judged")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")  # the entry only: its files are scratch
    rows = texts.groupBy("doc_id", "h").agg(F.count("*").alias("rows"))
    whole = F.when(F.col("n_words") >= WINDOW, F.array(F.struct(F.lit(0).cast("bigint").alias("begin"), F.col("n_words").alias("end"))))
    own = F.col("copy") & (F.coalesce("doc_id", F.lit(LAST_ID)) == F.col("owner"))
    copy = ~own & (F.col("n_words") >= WINDOW)
    first_row = F.expr("transform(sequence(1, rows), i -> i = 1)")
    return (rows.join(judged, "h").withColumn("copy", F.explode(first_row)).select(
        "doc_id", "n_words", F.when(copy, F.col("n_words")).otherwise(F.col("n_removed")).alias("n_removed"),
        F.when(copy, whole).otherwise(F.col("spans")).alias("spans"),
        F.when(copy, F.lit(EMPTY_SHA)).otherwise(F.col("kept_sha256")).alias("kept_sha256"),
        *([F.when(copy, F.lit("")).otherwise(F.col("kept_text")).alias("kept_text")] if keep_text else [])))


def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: what is left of every document of ``documents``."""
    out = repeats(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"), keep_text=False)
    return out.select("doc_id", "n_words", "n_removed", "kept_sha256")


ORACLE = rf"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
win AS (SELECT doc_id, s, array_to_string(ws[s:s + {WINDOW - 1}], ' ') AS words
        FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - {WINDOW - 2})) AS s FROM w WHERE len(ws) >= {WINDOW})),
late AS (SELECT doc_id, s FROM win QUALIFY row_number() OVER (PARTITION BY words ORDER BY doc_id, s) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + {WINDOW})) AS pos FROM late),
word AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS pos FROM w),
kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY pos) AS words
         FROM word ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(words, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)"""
