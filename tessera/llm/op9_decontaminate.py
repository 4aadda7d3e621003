"""Benchmark decontamination with a hash set of normalised test n-grams.

DataFrame functions only.  Benchmark texts become windows of ``WINDOW``
consecutive normalised words (a shorter text is one window).  Of a window of n words
all runs of ``n // 2 + 1`` words go into a set of 64-bit hashes, which is broadcast.
Any n consecutive words of a training text hold one such run that begins at every
``n - n // 2``-th word, so only these runs of a text are hashed and looked up (of ten
words: runs of six, at every fifth word), and no window is missed.

Texts are scanned in place, as chunks of ``CHUNK`` window starts with the words that
the last of them need.  Only chunks with a known run leave the scan, with their words; an
equi-join of their windows with the benchmark's windows *verifies* each hit and tells
its items.  The scan shuffles no texts, whatever the benchmark's size: a set of more than
``MAX_SET`` hashes is cut into parts, and the texts are scanned once for each part.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import MAX_BROADCAST_IDS, pick, position, tag, written

WINDOW = 10
#: Window starts of a chunk of a text.
CHUNK = 50
#: Hashes that are broadcast at once (8 bytes each).
MAX_SET = 4_000_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words after lower-casing A-Z are runs of a-z, 0-9 and non-ASCII characters; this lies between them.
_BETWEEN = r"[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def _words(text: str) -> str:
    """SQL of a text's words.  ``lower`` is the faster equal of ``translate`` where all is ASCII,
    and ``split`` (with '' at the ends) a quarter of the cost of ``regexp_extract_all``."""
    return (f"array_remove(split(CASE WHEN octet_length({text}) = length({text}) THEN lower({text}) "
            f"ELSE translate({text}, '{_UPPER}', '{_LOWER}') END, '{_BETWEEN}'), '')")


def benchmark_windows(benchmark: DataFrame) -> DataFrame:
    """(ws, len, items): distinct windows, the ids of the items that hold them.

    A text without words has no window; a null item_id names no item.
    """
    items = pick(benchmark, item_id="item_id", text="text").select(
        F.col("item_id").cast("string").alias("item_id"),
        F.expr(_words("coalesce(text, '')")).alias("ws"))
    cut = items.filter("size(ws) > 0").select("item_id", F.explode(F.expr(
        f"transform(sequence(0, greatest(size(ws) - {WINDOW}, 0)), i -> slice(ws, i + 1, {WINDOW}))")).alias("ws"))
    return cut.groupBy("ws", F.size("ws").alias("len")).agg(F.collect_set("item_id").alias("items"))


def runs(windows: DataFrame) -> DataFrame:
    """(h): distinct hashes of the runs of ``len // 2 + 1`` words of all windows."""
    return windows.select(F.explode(F.expr(
        "transform(sequence(1, (len + 1) div 2), i -> xxhash64(len, slice(ws, i, len div 2 + 1)))")).alias("h")).distinct()


def _probes(lengths: list[int]) -> str:
    """SQL: the runs (len, step, h) of a chunk's words ``ws`` that stand for its windows of each length.

    The run of step j stands for the windows that begin at words ``t * j`` to ``t * j + t - 1``
    of the chunk, with ``t = (len + 1) // 2``; it begins at the last of them.
    """
    parts = []
    for n in lengths:
        t, run = (n + 1) // 2, n // 2 + 1
        parts.append(
            f"transform(if(size(ws) >= {n}, sequence(0, least((size(ws) - {n}) div {t}, {(CHUNK - 1) // t})), array()), "
            f"j -> struct({n} AS len, j AS step, xxhash64({n}, slice(ws, {t} * j + {t}, {run})) AS h))")
    return ", ".join(parts)


def _scanned(texts: DataFrame, lengths: list[int], known: DataFrame, counts: bool) -> DataFrame:
    """(doc_id, digest, n_words, chunk, len, step, ws): the runs that are known; with
    ``counts`` also a row of null ``len`` for each text.

    Words are cut once.  A text of no words is one empty chunk.
    """
    chunks = (f"transform(array({_words('text')}), ws -> struct(CAST(size(ws) AS bigint) AS n_words, "
              f"transform(sequence(0, greatest(size(ws) - 1, 0) div {CHUNK}), "
              f"c -> slice(ws, {CHUNK} * c + 1, {CHUNK + WINDOW - 1})) AS chunks))[0]")
    rows = (texts.select("doc_id", F.xxhash64("text").alias("digest"), F.expr(chunks).alias("s"))
            .select("doc_id", "digest", "s.n_words", F.posexplode("s.chunks").alias("chunk", "ws")))
    # the text's own row: its hash is not a run's (and would be verified like any other)
    own = "if(chunk = 0, array(struct(CAST(null AS int) AS len, 0 AS step, digest AS h)), array())"
    probes = [part for part in (own if counts else "", _probes(lengths)) if part]
    probed = rows.select("*", F.inline(F.expr(f"concat({', '.join(probes)})")))
    return (probed.join(F.broadcast(known.select(F.col("h").alias("known"))), F.col("h") == F.col("known"), "left")
            .filter("len IS NULL OR known IS NOT NULL")
            .select("doc_id", "digest", "n_words", "chunk", "len", "step", F.expr("if(len IS NULL, null, ws)").alias("ws")))


def scan(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, max_set: int = MAX_SET) -> tuple[DataFrame, DataFrame]:
    """(texts, found): every row's id, text digest and word count; the rows with verified hits.

    Rows are told apart by id and text digest, so ids may be null or repeated.
    """
    windows = written(spark, benchmark_windows(benchmark), "dc-windows")
    known = written(spark, runs(windows), "dc-runs")
    lengths = sorted(r.len for r in windows.select("len").distinct().collect())   # ten at most
    parts = max(1, -(-known.count() // max_set))
    texts = pick(docs, doc_id="doc_id", text="text").select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    passes = [_scanned(texts, lengths, known.filter(F.pmod("h", F.lit(parts)) == k), k == 0) for k in range(parts)]
    scanned = written(spark, reduce(DataFrame.unionByName, passes), "dc-scanned")
    starts = ("filter(sequence((len + 1) div 2 * step, (len + 1) div 2 * (step + 1) - 1), "
              f"i -> i < {CHUNK} AND i + len <= size(ws))")
    hits = (scanned.filter("len IS NOT NULL").groupBy("doc_id", "digest", "chunk", "len", "step")
            .agg(F.first("ws").alias("ws"))
            .select("doc_id", "digest", "len", F.expr(f"inline(transform({starts}, "
                    f"i -> struct({CHUNK} * chunk + i AS pos, slice(ws, i + 1, len) AS ws)))")))
    spans = F.collect_list(F.sequence("pos", F.col("pos") + F.col("len") - 1))
    found = written(spark, hits.join(windows.select("ws", "items"), "ws").groupBy("doc_id", "digest").agg(
        F.size(F.array_distinct(F.flatten(spans))).cast("bigint").alias("n_hit"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items")), "dc-found")
    return scanned.filter("len IS NULL").select("doc_id", "digest", "n_words"), found


def decontaminate(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, max_set: int = MAX_SET) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) of every row.

    Null and empty texts have no words and are clean.
    """
    texts, found = scan(spark, docs, benchmark, max_set)
    t, f = texts.alias("t"), found.alias("f")
    both = t.join(f, F.col("t.doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("t.digest") == F.col("f.digest")), "left")
    return both.select(
        "t.doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("bigint").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")), 256).alias("items_sha256"),
        F.col("n_hit").isNotNull().alias("contaminated"))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: ``documents`` against the windows of ``benchmark``."""
    return decontaminate(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"),
                         spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def clean_documents(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Pipeline stage: documents with any verified hit go; the columns stay as they are.

    Up to ``MAX_BROADCAST_IDS`` (id, digest) pairs of them are broadcast, so that
    the texts stay where they are; more make it a shuffle join.
    """
    _, found = scan(spark, docs, benchmark)
    found = found.select("doc_id", "digest")
    if found.count() <= MAX_BROADCAST_IDS:
        found = F.broadcast(found)
    names = docs.columns
    d = tag(docs)
    doc_id = F.col(f"c{position(names, 'doc_id')}").cast("bigint")
    digest = F.xxhash64(F.coalesce(F.col(f"c{position(names, 'text')}"), F.lit("")))
    return d.join(found, doc_id.eqNullSafe(found.doc_id) & (digest == found.digest), "left_anti").toDF(*names)


ORACLE = r"""
WITH i AS (
  SELECT item_id::VARCHAR AS item_id, regexp_extract_all(translate(coalesce(text, ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM benchmark),
win AS (
  SELECT DISTINCT item_id, len(w) AS n, array_to_string(w, ' ') AS w FROM (
    SELECT item_id, unnest(list_transform(range(0, greatest(len(ws) - 10, 0) + 1),
           lambda k: ws[k + 1:k + 10])) AS w FROM i WHERE len(ws) > 0)),
d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM documents),
pos AS (SELECT doc_id, ws, n, unnest(range(0, len(ws) - n + 1)) AS k
        FROM d, (SELECT DISTINCT n FROM win) WHERE len(ws) >= n),
hit AS (SELECT doc_id, k, pos.n, item_id FROM pos JOIN win
        ON win.n = pos.n AND win.w = array_to_string(ws[k + 1:k + pos.n], ' ')),
word AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (
           SELECT DISTINCT doc_id, unnest(range(k, k + n)) AS p FROM hit) GROUP BY doc_id),
item AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
         FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id)
SELECT d.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN word USING (doc_id) LEFT JOIN item USING (doc_id)"""
