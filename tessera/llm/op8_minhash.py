"""MinHash near-duplicate classes by a multi-index Hamming join.

Method
------
1. Every text becomes its set of distinct five-word shingles (64-bit hashes).
   Equal sets (equal count and 128-bit digest) form one *class*, so a thousand
   copies cost one row from here on.
2. A class gets ``SLOTS`` minhashes.  Their low bytes are its b-bit signature
   (b = 8, packed in eight longs); the Hamming distance of two signatures counts
   the slots that differ, about (1 - similarity) * SLOTS.
3. Multi-index: the slots are split into ``CHUNKS`` chunks.  Two signatures
   within ``MAX_DISTANCE`` have, by the pigeonhole principle, one chunk with at
   most ``CHUNK_ERRORS`` differing slots.  The allowed errors of each chunk are
   enumerated as its variants with that slot left out, and each variant is an
   index key: all pairs whose minhashes differ in at most that many slots share a
   key.  (Keys are made of whole minhashes, as three bytes of b bits would be
   shared by chance in a large corpus; the b-bit distance, which is never larger,
   then decides about the pairs that share a key.)
4. Candidates are gathered into loose *clusters*: classes within the distance of
   one of a few hubs of a shared key (linear in the key's size), then pairs that
   share a key, are within the distance and still lie in different clusters.
   All pairs within the distance are inside a cluster, and a large group of near
   copies is never expanded into its pairs.
5. Clusters are confirmed on the full shingle sets, ``BLOCK`` classes at a time:
   a task counts the common shingles of its block and returns a spanning forest
   of the links.  In clusters of several blocks, classes that did not join the
   cluster's main component are then compared with all other blocks.
6. The forests are closed into components: up to ``LINKS_PER_TASK`` links by one
   task, more by alternating star contraction.

At similarity 0.75 the distance is binomial(64, 0.25); it exceeds 33 with a
chance of 3e-6, and with less above 0.75.

Skew: copies are collapsed with map-side aggregation, hubs are found with
map-side aggregation, and the joins are plain equi-joins that adaptive
execution splits.  Every step after the signatures reads a written table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import pick, position, rows_of, tag, written
from tessera.llm.textcore import NON_SPACE, U64, blocks, chain, mix, words

SHINGLE = 5
SLOTS, CHUNKS, MAX_DISTANCE = 64, 17, 33
CHUNK_ERRORS = MAX_DISTANCE // CHUNKS  # 1
#: A link needs LINK_DEN * intersection >= LINK_NUM * union.
LINK_NUM, LINK_DEN = 75, 100
#: Different hub orders among the keys of a class.
HUB_ORDERS = 16
#: Classes of a cluster that one task compares (two such blocks in the second pass).
BLOCK = 512
PIVOTS = 32
#: Links (16 bytes each) that one task may close into components; more go by star rounds.
LINKS_PER_TASK = 1_000_000

SIG = [f"s{i}" for i in range(SLOTS // 8)]
FP = ["fp1", "fp2", "n"]

_rng = np.random.default_rng(20240817)
_XOR = _rng.integers(0, 1 << 63, SLOTS, dtype=np.int64).astype(U64)
_MUL = _rng.integers(0, 1 << 63, SLOTS, dtype=np.int64).astype(U64) | U64(1)


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text, sorted, and their bounds.

    A text of one to four words has one shingle, the whole sequence.
    """
    w = words(data, offsets, NON_SPACE)
    runs = chain(w.hashes, SHINGLE)
    sets = []
    for lo, hi in zip(w.bounds[:-1].tolist(), w.bounds[1:].tolist()):
        if hi - lo >= SHINGLE:
            s = np.sort(runs[lo:hi - SHINGLE + 1])
            sets.append(s[np.concatenate([[True], s[1:] != s[:-1]])])
        else:
            sets.append(chain(w.hashes[lo:hi], hi - lo) + U64(hi - lo) if hi > lo
                        else np.zeros(0, dtype=U64))
    bounds = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    return (np.concatenate(sets) if sets else np.zeros(0, dtype=U64)), bounds


def minhashes(shingles: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """(texts, SLOTS) minima of SLOTS orders of the shingles; no text may be empty."""
    out = np.empty((len(starts), SLOTS), dtype=U64)
    for j in range(SLOTS):
        out[:, j] = np.minimum.reduceat((shingles ^ _XOR[j]) * _MUL[j], starts)
    return out


def index_keys(mins: np.ndarray) -> np.ndarray:
    """Keys of the multi-index: per chunk, its variants with one slot left out."""
    slot = mix(mins + np.arange(1, SLOTS + 1, dtype=U64) * U64(0x9E3779B97F4A7C15))
    keys = []
    for chunk in np.array_split(np.arange(SLOTS), CHUNKS):
        total = slot[:, chunk].sum(axis=1, dtype=U64)
        for left_out in chunk:
            keys.append(mix(total - slot[:, left_out] + U64(int(left_out) + 1)))
    return np.stack(keys, axis=1)


_SIGNED = "doc_id bigint, n bigint, fp1 bigint, fp2 bigint, keys array<bigint>, " + \
    ", ".join(f"{s} bigint" for s in SIG)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("doc_id")
        for first, last, data, offsets in blocks(batch.column("text")):
            shingles, bounds = shingle_sets(data, offsets)
            n = np.diff(bounds)
            full = np.flatnonzero(n)
            m = last - first
            fp1, fp2 = np.zeros(m, U64), np.zeros(m, U64)
            sig = np.zeros((m, SLOTS), dtype=np.uint8)
            keys = np.zeros((0, SLOTS), dtype=U64)
            if len(full):
                starts = bounds[:-1][full]
                fp1[full] = np.add.reduceat(mix(shingles), starts)
                fp2[full] = np.add.reduceat(mix(shingles ^ U64(0xA0761D6478BD642F)), starts)
                mins = minhashes(shingles, starts)
                sig[full] = (mins & U64(0xFF)).astype(np.uint8)
                keys = index_keys(mins)
            key_bounds = np.zeros(m + 1, dtype=np.int32)
            key_bounds[1:] = np.cumsum(np.where(n > 0, SLOTS, 0))
            yield pa.RecordBatch.from_arrays(
                [ids.slice(first, m), pa.array(n), pa.array(fp1.view(np.int64)),
                 pa.array(fp2.view(np.int64)),
                 pa.ListArray.from_arrays(pa.array(key_bounds), pa.array(keys.ravel().view(np.int64)))]
                + [pa.array(np.ascontiguousarray(sig[:, 8 * i:8 * i + 8]).view(np.int64).ravel())
                   for i in range(len(SIG))],
                names=["doc_id", "n", "fp1", "fp2", "keys", *SIG])


def signatures(docs: DataFrame) -> DataFrame:
    """One row per document: set size, set digest, index keys, signature."""
    return pick(docs, doc_id="doc_id", text="text").select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(_sign, _SIGNED)


def distance(a: str, b: str) -> Column:
    """Slots in which two signatures differ: bytes that differ, counted in eight longs."""
    total = F.lit(0)
    for s in SIG:
        x = F.col(f"{a}.{s}").bitwiseXOR(F.col(f"{b}.{s}"))
        for k in (4, 2, 1):
            x = x.bitwiseOR(F.shiftrightunsigned(x, k))
        total = total + F.bit_count(x.bitwiseAND(F.lit(0x0101010101010101)))
    return total


def forest(n: np.ndarray, sets: list[np.ndarray], comps: np.ndarray, sides: np.ndarray,
           across: bool) -> list[tuple[int, int]]:
    """Pairs (first member, other member) of each component of the links among
    classes of different components so far.

    ``across``: only between the two sides.  Common shingles are counted by
    products of 0/1 matrices over the shingles that two classes or more have.
    """
    m = len(sets)
    owner = np.repeat(np.arange(m), n)
    _, code, seen = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = seen > 1
    column = np.cumsum(shared) - 1
    keep = shared[code]
    owner, code = owner[keep], column[code[keep]]
    order = np.argsort(code, kind="stable")
    owner, code = owner[order], code[order]
    common = np.zeros((m, m), dtype=np.float32)
    wide = int(shared.sum())
    for lo in range(0, wide, 4096):
        i, j = np.searchsorted(code, [lo, lo + 4096])
        part = np.zeros((m, min(4096, wide - lo)), dtype=np.float32)
        part[owner[i:j], code[i:j] - lo] = 1.0
        common += part @ part.T
    common = common.astype(np.int64)
    link = LINK_DEN * common >= LINK_NUM * (n[:, None] + n[None, :] - common)
    link &= comps[:, None] != comps[None, :]
    if across:
        link &= sides[:, None] != sides[None, :]
    edges, left = [], link.any(axis=1)
    while left.any():
        root = int(np.argmax(left))
        left[root] = False
        front = [root]
        while front:
            reached = np.flatnonzero(link[front].any(axis=0) & left)
            left[reached] = False
            edges += [(root, int(v)) for v in reached]
            front = reached.tolist()
    return edges


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (cl, lo, hi): the forest of each such group."""
    key, group, size = None, [], 0

    def close() -> pa.RecordBatch:
        ids = [g[0] for g in group]
        n = np.array([len(g[3]) for g in group], dtype=np.int64)
        found = forest(n, [g[3] for g in group], np.array([g[1] for g in group]),
                       np.array([g[2] for g in group]), key[1] != key[2]) if len(group) > 1 else []
        return pa.RecordBatch.from_arrays(
            [pa.array([ids[y] for _, y in found], pa.int64()),
             pa.array([ids[x] for x, _ in found], pa.int64()),
             pa.array([size] * len(found), pa.int64())], names=["a", "b", "k"])

    for batch in batches:
        at, lo, hi, ids, comps, sides, sizes = (
            batch.column(c).to_pylist() for c in ("cl", "lo", "hi", "id", "comp", "side", "k"))
        for first, last, data, offsets in blocks(batch.column("text")):
            shingles, bounds = shingle_sets(data, offsets)
            for k in range(first, last):
                if (at[k], lo[k], hi[k]) != key:
                    if len(group) > 1:
                        yield close()
                    key, group, size = (at[k], lo[k], hi[k]), [], sizes[k]
                if group and group[-1][0] == ids[k]:
                    continue  # a repeated row
                group.append((ids[k], comps[k], sides[k],
                              shingles[bounds[k - first]:bounds[k - first + 1]].copy()))
    if len(group) > 1:
        yield close()


def confirm(spark: SparkSession, docs: DataFrame, tasks: DataFrame) -> DataFrame:
    """Components (a, b = smallest id, k) of the groups (cl, lo, hi) that ``tasks`` deals ids into.

    Sets are made anew, in the task, from the texts of the documents in question.
    """
    texts = pick(docs, id="doc_id", text="text").select(F.col("id").cast("bigint").alias("id"), "text")
    tasks = written(spark, tasks, "nd-tasks")
    ids = written(spark, tasks.select("id").distinct(), "nd-ids")
    rows = (rows_of(texts, "id", ids).join(tasks, "id")
            .repartition("cl", "lo", "hi").sortWithinPartitions("cl", "lo", "hi", "id"))
    return written(spark, rows.mapInArrow(_confirm, "a bigint, b bigint, k bigint"), "nd-links")


def block_tasks(members: DataFrame) -> DataFrame:
    """First pass: every cluster (id, cl, k = its size) in blocks, each on its own.

    About ``PIVOTS`` members of a cluster of several blocks are in all of them,
    so that components meet across blocks.
    """
    number = F.ceil(F.col("k") / BLOCK).cast("int")
    block = F.pmod(F.xxhash64("id"), number).cast("int")
    pivot = (number > 1) & (F.pmod(F.xxhash64("id", F.lit("pivot")), F.col("k")) < PIVOTS)
    return (members.withColumn("lo", F.explode(F.when(pivot, F.sequence(F.lit(0), number - 1)).otherwise(F.array(block))))
            .select("id", "cl", "k", "lo", F.col("lo").alias("hi"), F.lit(0).alias("side"), F.col("id").alias("comp")))


def stray_tasks(members: DataFrame, comps: DataFrame) -> DataFrame:
    """Second pass, clusters of several blocks: classes outside the main component
    meet all others; members of the main component never meet each other."""
    big = (members.filter(F.col("k") > BLOCK).join(comps, "id", "left")
           .withColumn("comp", F.coalesce("comp", "id")))
    parts = big.groupBy("cl", "comp").agg(F.count("*").alias("c"))
    main = parts.groupBy("cl").agg(F.max_by("comp", F.struct("c", "comp")).alias("main"),
                                   F.max("c").alias("c"))
    big = (big.join(main, "cl").withColumn("stray", F.col("comp") != F.col("main"))
           .withColumn("s", F.ceil((F.col("k") - F.col("c")) / BLOCK).cast("int"))
           .withColumn("g", F.ceil(F.col("c") / BLOCK).cast("int")).filter("s > 0"))
    i = F.pmod(F.xxhash64("id"), F.when(F.col("stray"), F.col("s")).otherwise(F.col("g"))).cast("int")
    others = F.when(F.col("stray"), F.expr("sequence(0, s + g - 1)")).otherwise(F.expr("sequence(0, s - 1)"))
    own = F.when(F.col("stray"), F.col("i")).otherwise(F.col("s") + F.col("i"))
    return (big.withColumn("i", i).withColumn("own", own).withColumn("other", F.explode(others))
            .select("id", "cl", "k", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"),
                    (F.col("own") > F.col("other")).cast("int").alias("side"), "comp"))


def _close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Components of all links (a, b) of the partition: labels sink to the smallest."""
    ends = [(b.column("a").to_numpy(), b.column("b").to_numpy()) for b in batches if b.num_rows]
    if not ends:
        return
    nodes, at = np.unique(np.concatenate([x for e in ends for x in e]), return_inverse=True)
    bounds = np.cumsum([0] + [len(x) for e in ends for x in e])
    pieces = [at[i:j] for i, j in zip(bounds[:-1], bounds[1:])]
    u, v = np.concatenate(pieces[0::2]), np.concatenate(pieces[1::2])
    label = np.arange(len(nodes))
    while True:
        low = label.copy()
        np.minimum.at(low, u, label[v])
        np.minimum.at(low, v, label[u])
        np.minimum.at(low, label[u], low[u])
        np.minimum.at(low, label[v], low[v])
        low = low[low]
        if np.array_equal(low, label):
            break
        label = low
    yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(nodes[label])], names=["id", "comp"])


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """(id, comp): smallest id reachable, for every id that has a link (a, b).

    ``links`` must be a written table: it is counted first.  Up to
    ``LINKS_PER_TASK`` links are closed by one task.  More are closed by
    alternating star contraction: each round links every node's larger
    neighbours, then its smaller ones, to its smallest neighbour, until the
    links are stars.  Links only ever go down, so rounds are logarithmic.
    """
    if links.count() <= LINKS_PER_TASK:
        return written(spark, links.select("a", "b").coalesce(1)
                       .mapInArrow(_close, "id bigint, comp bigint"), "nd-comps")
    edges = written(spark, links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                    .filter("u <> v").distinct(), "nd-edges")
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(low, "u").filter("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v"))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .filter("u <> v").union(low.select("u", F.col("m").alias("v"))).distinct())
        edges = written(spark, small, "nd-edges")
        # stars: no node points twice, and none that is pointed at points further
        ends = edges.select("u", F.lit(1).alias("out")).union(edges.select(F.col("v").alias("u"), F.lit(0).alias("out")))
        loose = (ends.groupBy("u").agg(F.sum("out").alias("out"), F.min("out").alias("least"))
                 .filter("out > 1 OR out = 1 AND least = 0").agg(F.count("*")).first()[0])
        if not loose:
            break
    return written(spark, edges.select(F.col("u").alias("id"), F.col("v").alias("comp")).union(
        edges.select(F.col("v").alias("id"), F.col("v").alias("comp")).distinct()), "nd-comps")


def near_duplicates(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs``.

    Texts that are null, empty or without words have no shingles and link with
    nothing.  Rows that repeat a doc_id count as one document.  A null doc_id
    names no document: such a row links with nothing and its component_id is
    null.
    """
    signed = written(spark, signatures(docs), "nd-signed")
    known = signed.filter("n > 0 AND doc_id IS NOT NULL")
    classes = written(spark, known.groupBy(*FP).agg(
        F.min("doc_id").alias("id"), F.first("keys").alias("keys"),
        *[F.first(s).alias(s) for s in SIG]), "nd-classes")
    sig = classes.select("id", "n", *SIG)
    keyed = classes.select("id", F.explode("keys").alias("key"))

    # hubs: the smallest of a key's classes under one of a few orders of the ids
    order = F.xxhash64("id", F.pmod(F.col("key"), F.lit(HUB_ORDERS)))
    hubs = (keyed.groupBy("key").agg(F.min_by("id", order).alias("hub"), F.count("*").alias("k"))
            .filter("k > 1").select("key", "hub"))
    shared = written(spark, keyed.join(hubs, "key"), "nd-shared")
    stars = shared.filter("id <> hub").select(
        F.greatest("id", "hub").alias("a"), F.least("id", "hub").alias("b")).distinct()
    loose = written(spark, _within(stars, sig), "nd-stars")
    clusters = components(spark, loose)

    # what is left: classes of different clusters that share a key
    part = (shared.select("id", "key").join(clusters, "id", "left")
            .withColumn("comp", F.coalesce("comp", "id")))
    # pairs of a key's main cluster need no look: one side of each pair is outside of it
    main = (part.groupBy("key", "comp").agg(F.count("*").alias("c")).groupBy("key")
            .agg(F.max_by("comp", F.struct("c", "comp")).alias("main"), F.count("*").alias("parts"))
            .filter("parts > 1").select("key", "main"))
    rest = written(spark, part.join(main, "key").join(sig, "id"), "nd-rest")
    x, y = rest.filter("comp <> main").alias("x"), rest.alias("y")
    met = (x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.comp") != F.col("y.comp"))
                  & ((F.col("y.comp") == F.col("y.main")) | (F.col("x.id") > F.col("y.id")))
                  & close_enough("x", "y"))
           .select(F.col("x.comp").alias("a"), F.col("y.comp").alias("b")).distinct())
    bridges = written(spark, met, "nd-bridges")
    if not bridges.isEmpty():
        clusters = components(spark, loose.union(bridges))

    sizes = clusters.groupBy("comp").agg(F.count("*").alias("k"))
    members = written(spark, clusters.join(sizes, "comp")
                      .select("id", F.col("comp").alias("cl"), "k"), "nd-members")
    found = confirm(spark, docs, block_tasks(members))
    # a cluster of one block is final: its rows point at the component's smallest id
    final = found.filter(F.col("k") <= BLOCK)
    comps = final.select(F.col("a").alias("id"), F.col("b").alias("comp"))
    if not members.filter(F.col("k") > BLOCK).isEmpty():
        links = found.filter(F.col("k") > BLOCK).select("a", "b")
        so_far = components(spark, links)
        links = links.union(confirm(spark, docs, stray_tasks(members, so_far)).select("a", "b"))
        comps = comps.union(components(spark, links))

    owner = (classes.select(*FP, "id").join(comps, "id", "left")
             .select(*FP, F.coalesce("comp", "id").alias("comp")))
    return (signed.select("doc_id", *FP).join(owner, FP, "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("doc_id").isNotNull(), F.coalesce("comp", "doc_id"))
                    .alias("component_id")))


def close_enough(a: str, b: str) -> Column:
    """Set sizes that allow the similarity, and signatures within the distance."""
    n, m = F.col(f"{a}.n"), F.col(f"{b}.n")
    return ((LINK_DEN * F.least(n, m) >= LINK_NUM * F.greatest(n, m))
            & (distance(a, b) <= MAX_DISTANCE))


def _within(pairs: DataFrame, sig: DataFrame) -> DataFrame:
    """The pairs (a, b) that are close enough."""
    return (pairs.join(sig.alias("x"), F.col("a") == F.col("x.id"))
            .join(sig.alias("y"), F.col("b") == F.col("y.id"))
            .filter(close_enough("x", "y")).select("a", "b"))


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query over ``documents``: class and survivor of every document."""
    out = near_duplicates(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_shingles", "component_id",
                      (F.col("doc_id") == F.col("component_id")).alias("kept"))


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
sh AS (
  SELECT doc_id, unnest(CASE WHEN len(ws) >= 5 THEN list_distinct(list_transform(
         range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')))
         WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS s FROM w),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
met AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
        FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM met JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
          WHERE 100 * c >= 75 * (na.n + nb.n - c)),
reach(id, to_id) AS (
  SELECT doc_id, doc_id FROM documents UNION
  SELECT reach.id, links.b FROM reach JOIN links ON links.a = reach.to_id),
comp AS (SELECT id, min(to_id) AS component_id FROM reach GROUP BY id)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id,
       d.doc_id = c.component_id AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id JOIN comp c ON c.id = d.doc_id"""


def keep_one(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Pipeline stage: of each component the document with the smallest id stays.

    Documents without words and documents without an id stay; of rows that
    repeat an id one stays.
    """
    found = near_duplicates(spark, docs)
    names = docs.columns
    gone = written(spark, found.filter("doc_id <> component_id").select("doc_id").distinct(), "nd-gone")
    tagged = tag(docs)
    key = f"c{position(names, 'doc_id')}"
    kept = rows_of(tagged, key, gone, "left_anti")
    ids = pick(docs, doc_id="doc_id")
    twice = written(spark, ids.filter("doc_id IS NOT NULL").groupBy("doc_id")
                    .agg(F.count("*").alias("k")).filter("k > 1").select("doc_id"), "nd-twice")
    if not twice.isEmpty():
        # rare: only the repeated ids are gathered by id
        once = rows_of(kept, key, twice, "left_anti")
        some = rows_of(kept, key, twice).dropDuplicates([key])
        kept = once.unionByName(some)
    return kept.toDF(*names)
