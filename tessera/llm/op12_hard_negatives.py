"""Hard-negative mining by bounds along a spanning tree of anchors.

Vectors become integers (``floor(SCALE * x)``), scores are their inner products.  For
each anchor its best positives (other rows of its label) are found first; each positive
then asks for the best rows of other labels whose score lies in a window below its own.

Method
------
1. Anchors are dealt into chunks; a chunk holds the minimum spanning tree of its anchors
   (Prim's algorithm over Euclidean distances), with the length of every edge.
2. Candidates are dealt into blocks, one task each.  Every chunk visits every block: the
   stated set of anchors against all rows, anchors being the small side that is copied.
3. In a block a chunk's tree is walked from the root, whose scores are computed.  For a
   child c of p, |score(c, x) - score(p, x)| <= |c - p| * |x|, so the parent's score
   (or its interval, where it was not computed) plus and minus edge times norm bounds the
   child's.  Only candidates whose interval overlaps what the child asks for are scored
   again: intervals that can still reach its best positives, then intervals that overlap
   a window and can still be among the first in it.
4. Each block returns its few best rows; the best of all blocks are the result.

All bounds are rounded outwards and scores are exact, so no candidate is lost; where
vectors are far apart the bounds rule out little and nearly all candidates are scored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import pick, rows_of, written

SCALE = 256
ANCHOR_EVERY, POSITIVES, NEGATIVES = 50, 5, 3
#: A negative's score: LOW * positive <= 100 * negative <= HIGH * positive.
LOW, HIGH = 50, 95
#: Anchors in a tree; bytes of candidate vectors in a block, and its least rows.
CHUNK, BLOCK_BYTES, LEAST_BLOCK = 256, 16 << 20, 1024
#: Below this, sums of products are exact in double precision.
EXACT = 1 << 53


def _quantize(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = batch.column("embedding")
        values = rows.values.to_numpy(zero_copy_only=False).astype(np.float64)
        bounds = rows.offsets.to_numpy()
        lengths = np.diff(bounds)
        values = values[bounds[0]:bounds[-1]] if len(bounds) else values[:0]
        at = np.repeat(np.arange(len(rows)), lengths)
        column = np.arange(len(values)) - np.repeat(bounds[:-1] - bounds[0], lengths)
        out = np.zeros((len(rows), dim))
        out[at, column] = np.floor(values * SCALE)
        good = np.isfinite(out).all(axis=1)  # a null component reads as NaN
        keep = np.flatnonzero(good)
        yield pa.RecordBatch.from_arrays(
            [batch.column("vec_id").take(pa.array(keep)), batch.column("label").take(pa.array(keep)),
             pa.array([out[i].tobytes() for i in keep], pa.binary())], names=["vec_id", "label", "q"])


def integer_vectors(spark: SparkSession, vectors: DataFrame) -> tuple[DataFrame, int]:
    """(vec_id, label, q) of the rows that take part, as a written table, and their dimension.

    Rows with a null id, label or vector, or with a component that is null or not finite,
    take no part.  Shorter vectors are padded with zeros.  Rows that repeat a vec_id count
    as one, the one with the smallest label, then the smallest vector.
    """
    rows = (pick(vectors, vec_id="vec_id", embedding="embedding", label="label")
            .filter("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL")
            .select(F.col("vec_id").cast("bigint"), F.col("embedding").cast("array<double>"), F.col("label").cast("bigint")))
    dim = max(1, rows.agg(F.max(F.size("embedding"))).first()[0] or 1)
    rows = written(spark, rows.mapInArrow(partial(_quantize, dim=dim), "vec_id bigint, label bigint, q binary"), "hn-vectors")
    twice = written(spark, rows.groupBy("vec_id").agg(F.count("*").alias("k")).filter("k > 1").select("vec_id"), "hn-twice")
    if not twice.isEmpty():
        one = rows_of(rows, "vec_id", twice).groupBy("vec_id").agg(F.min(F.struct("label", "q")).alias("r")).select("vec_id", "r.*")
        rows = written(spark, rows_of(rows, "vec_id", twice, "left_anti").union(one), "hn-vectors")
    return rows, dim


def spanning_tree(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Parents (-1 at the root, row 0) and edge lengths of the rows' minimum spanning tree."""
    n = len(x)
    parent, near = np.full(n, -1), np.full(n, np.inf)
    inside, at = np.zeros(n, bool), 0
    for _ in range(n - 1):
        inside[at] = True
        d = ((x - x[at]) ** 2).sum(axis=1)
        closer = (d < near) & ~inside
        near[closer], parent[closer] = d[closer], at
        at = int(np.argmin(np.where(inside, np.inf, near)))
    edge = np.sqrt(np.where(np.isfinite(near), near, 0.0))
    return parent, edge


@dataclass
class Chunk:
    """Anchors with their tree; ``asks`` has what each anchor looks for."""

    ids: np.ndarray
    labels: np.ndarray
    x: np.ndarray
    parent: np.ndarray
    edge: np.ndarray

    @classmethod
    def of(cls, ids, labels, x) -> Chunk:
        return cls(ids, labels, x, *spanning_tree(x))

    def pack(self) -> bytes:
        return b"".join(v.astype(t).tobytes() for v, t in (
            (self.ids, "<i8"), (self.labels, "<i8"), (self.parent, "<i8"), (self.edge, "<f8"), (self.x, "<f8")))

    @classmethod
    def unpack(cls, raw: bytes, dim: int) -> Chunk:
        n = len(raw) // (8 * (4 + dim))
        whole, real = np.frombuffer(raw, "<i8", 3 * n).reshape(3, n), np.frombuffer(raw, "<f8", offset=24 * n)
        return cls(whole[0], whole[1], real[n:].reshape(n, dim), whole[2], real[:n])

    def preorder(self) -> list[int]:
        children: dict[int, list[int]] = {}
        for i, p in enumerate(self.parent.tolist()):
            children.setdefault(p, []).append(i)
        order, stack = [], children.get(-1, [])[::-1]
        while stack:
            order.append(stack.pop())
            stack += children.get(order[-1], [])[::-1]
        return order


class Block:
    """Candidates of a task."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray):
        self.ids, self.labels, self.x = ids, labels, x
        self.norm = np.sqrt((x * x).sum(axis=1)) * (1 + 1e-9)
        self.rescored = self.bounded = 0

    def scores(self, rows: np.ndarray, a: np.ndarray, exact: bool) -> np.ndarray:
        if exact:
            return self.x[rows] @ a if len(rows) < len(self.x) else self.x @ a
        return np.array([sum(int(u) * int(v) for u, v in zip(self.x[r], a)) for r in rows], dtype=object)

    def walk(self, chunk: Chunk, choose) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Yields (anchor, candidates, exact scores): those that ``choose(anchor, low, high)``
        takes by their bounds, in the order of the tree."""
        reach = np.abs(chunk.x).max(initial=0) * np.abs(self.x).max(initial=0) * chunk.x.shape[1]
        exact, everyone = bool(reach < EXACT), np.arange(len(self.ids))
        waiting = np.bincount(chunk.parent + 1, minlength=len(chunk.ids) + 1)[1:]
        bounds: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for at in chunk.preorder():
            up = int(chunk.parent[at])
            if up < 0 or not exact:
                rows = everyone
                low = high = None
            else:
                slack = chunk.edge[at] * (1 + 1e-9) * self.norm * (1 + 1e-9) + 1e-3
                low, high = bounds[up][0] - slack, bounds[up][1] + slack
                waiting[up] -= 1
                if not waiting[up]:
                    del bounds[up]
                rows = choose(at, low, high)
            found = self.scores(rows, chunk.x[at], exact)
            self.rescored += len(rows)
            self.bounded += len(everyone)
            if exact and waiting[at]:
                if low is None:
                    low, high = found.copy(), found.copy()
                else:
                    low[rows] = high[rows] = found
                bounds[at] = low, high
            yield at, rows, found


def kth_largest(values: np.ndarray, k: int) -> float:
    return np.partition(values, len(values) - k)[len(values) - k] if len(values) >= k else -np.inf


def first(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k largest scores, ties by the smaller id."""
    if len(ids) > 4 * k:
        near = np.flatnonzero(scores >= kth_largest(scores, k))
        return near[np.lexsort((ids[near], -scores[near]))[:k]]
    return np.lexsort((ids, -scores))[:k]


def positives(block: Block, chunk: Chunk, k: int) -> Iterator[tuple[int, int, int]]:
    """(anchor id, row id, score): each anchor's k best other rows of its label in the block."""
    order = np.argsort(block.labels, kind="stable")
    sorted_labels = block.labels[order]

    def same(at: int) -> np.ndarray:
        lo, hi = np.searchsorted(sorted_labels, [chunk.labels[at], chunk.labels[at] + 1])
        rows = order[lo:hi]
        return rows[block.ids[rows] != chunk.ids[at]]

    def choose(at: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        rows = same(at)
        return rows[high[rows] >= kth_largest(low[rows], k)]

    for at, rows, scores in block.walk(chunk, choose):
        mine = np.flatnonzero((block.labels[rows] == chunk.labels[at]) & (block.ids[rows] != chunk.ids[at]))
        for i in mine[first(block.ids[rows[mine]], scores[mine], k)]:
            yield int(chunk.ids[at]), int(block.ids[rows[i]]), int(scores[i])


def negatives(block: Block, chunk: Chunk, asks: dict[int, list[tuple[int, int]]], k: int,
              low_share: int, high_share: int) -> Iterator[tuple[int, int, int, int, int]]:
    """(anchor id, positive id, row id, positive's score, score): for each (positive, score)
    that an anchor asks for, the k best rows of other labels in its window."""
    windows = {a: [(p, s, -(-low_share * s // 100), high_share * s // 100) for p, s in ps] for a, ps in asks.items()}

    def choose(at: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        wanted = np.zeros(len(low), dtype=bool)
        other = block.labels != chunk.labels[at]
        for _, _, least, most in windows.get(int(chunk.ids[at]), ()):
            if least <= most:
                sure = low[other & (low >= least) & (high <= most)]
                wanted |= (high >= max(least, kth_largest(sure, k))) & (low <= most)
        return np.flatnonzero(wanted & other)

    for at, rows, scores in block.walk(chunk, choose):
        other = block.labels[rows] != chunk.labels[at]
        for p, s, least, most in windows.get(int(chunk.ids[at]), ()):
            mine = np.flatnonzero(other & (scores >= least) & (scores <= most))
            for i in mine[first(block.ids[rows[mine]], scores[mine], k)]:
                yield int(chunk.ids[at]), p, int(block.ids[rows[i]]), s, int(scores[i])


def _chunks(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[pa.RecordBatch]:
    """Trees over runs of ``CHUNK`` anchors of a partition, sorted by (label, vec_id)."""
    ids: list[int] = []
    labels: list[int] = []
    raw: list[bytes] = []

    def close(n: int) -> pa.RecordBatch:
        c = Chunk.of(np.array(ids[:n]), np.array(labels[:n]), np.frombuffer(b"".join(raw[:n]), "<f8").reshape(n, dim))
        del ids[:n], labels[:n], raw[:n]
        return pa.RecordBatch.from_arrays([pa.array([int(c.ids[0])]), pa.array([c.ids.tolist()], pa.list_(pa.int64())),
                                           pa.array([c.pack()], pa.binary())], names=["chunk", "anchors", "tree"])

    for batch in batches:
        ids += batch.column("vec_id").to_pylist()
        labels += batch.column("label").to_pylist()
        raw += batch.column("q").to_pylist()
        while len(ids) >= CHUNK:
            yield close(CHUNK)
    if ids:
        yield close(len(ids))


def _meet(batches: Iterator[pa.RecordBatch], dim: int, work) -> Iterator[pa.RecordBatch]:
    """Rows of one block, candidates before chunks; ``work(block, chunk, asks)`` gives rows."""
    ids: list[int] = []
    labels: list[int] = []
    raw: list[bytes] = []
    block = None
    for batch in batches:
        out = []
        for i, label, q, asks in zip(*(batch.column(c).to_pylist() for c in ("vec_id", "label", "q", "asks"))):
            if i is not None:
                ids.append(i)
                labels.append(label)
                raw.append(q)
                continue
            if not ids:
                continue  # a block that no candidate fell into
            if block is None:
                block = Block(np.array(ids), np.array(labels), np.frombuffer(b"".join(raw), "<f8").reshape(len(ids), dim))
                raw.clear()
            out += work(block, Chunk.unpack(q, dim), asks)
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*out) if out else [[]] * 5)],
                                         names=["anchor_id", "positive_id", "row_id", "positive_score", "score"])


def _find_positives(block: Block, chunk: Chunk, asks, k: int) -> list[tuple]:
    return [(a, p, p, s, s) for a, p, s in positives(block, chunk, k)]


def _find_negatives(block: Block, chunk: Chunk, asks, k: int, low: int, high: int) -> list[tuple]:
    by_anchor: dict[int, list[tuple[int, int]]] = {}
    for ask in asks or []:
        by_anchor.setdefault(ask["anchor_id"], []).append((ask["positive_id"], ask["positive_score"]))
    return list(negatives(block, chunk, by_anchor, k, low, high))


_ASKS = "array<struct<anchor_id:bigint,positive_id:bigint,positive_score:bigint>>"


def _meetings(candidates: DataFrame, chunks: DataFrame, blocks: int, dim: int, work) -> DataFrame:
    """Every chunk (tree, asks) meets every block of candidates, one partition for each block."""
    block = F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")
    rows = candidates.select(block.alias("block"), "vec_id", "label", "q", F.lit(None).cast(_ASKS).alias("asks")).union(
        chunks.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(None).cast("bigint"),
                      F.lit(None).cast("bigint"), "tree", "asks"))
    return (rows.repartitionById(blocks, F.col("block")).sortWithinPartitions(F.col("vec_id").isNull(), "vec_id")
            .mapInArrow(partial(_meet, dim=dim, work=work),
                        "anchor_id bigint, positive_id bigint, row_id bigint, positive_score bigint, score bigint"))


def hard_negatives(spark: SparkSession, vectors: DataFrame, every: int = ANCHOR_EVERY, n_positives: int = POSITIVES,
                   n_negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Anchors are the rows whose vec_id is divisible by ``every``.  An anchor without rows of
    its label has no positives; a positive without rows in its window (always if its score
    is negative) has no result rows.  See ``integer_vectors`` for nulls and repeated rows.
    """
    rows, dim = integer_vectors(spark, vectors)
    n = rows.count()
    spread = -(-n // (4 * spark.sparkContext.defaultParallelism))  # small tables: some tasks for every core
    blocks = max(1, -(-n // max(LEAST_BLOCK, min(BLOCK_BYTES // (8 * dim), spread))))
    anchors = rows.filter(F.col("vec_id") % every == 0)
    parts = max(1, -(-anchors.count() // (4 * CHUNK)))
    chunks = written(spark, anchors.repartitionByRange(parts, "label", "vec_id").sortWithinPartitions("label", "vec_id")
                     .mapInArrow(partial(_chunks, dim=dim), "chunk bigint, anchors array<bigint>, tree binary"), "hn-chunks")

    near = _meetings(rows, chunks.withColumn("asks", F.lit(None).cast(_ASKS)), blocks, dim, partial(_find_positives, k=n_positives))
    best = F.row_number().over(Window.partitionBy("anchor_id").orderBy(F.desc("score"), "row_id"))
    wanted = written(spark, near.withColumn("r", best).filter(F.col("r") <= n_positives)
                     .select("anchor_id", "positive_id", "positive_score"), "hn-positives")
    # at most CHUNK * n_positives of them go to a chunk
    asks = (chunks.select("chunk", F.explode("anchors").alias("anchor_id")).join(wanted, "anchor_id")
            .groupBy("chunk").agg(F.collect_list(F.struct("anchor_id", "positive_id", "positive_score")).alias("asks")))
    found = _meetings(rows, chunks.join(asks, "chunk").select("tree", "asks"), blocks, dim,
                      partial(_find_negatives, k=n_negatives, low=low, high=high))
    rank = F.row_number().over(Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("score"), "row_id"))
    return (found.withColumn("rank", rank).filter(F.col("rank") <= n_negatives)
            .select("anchor_id", "positive_id", "rank", F.col("row_id").alias("negative_id"), "positive_score",
                    F.col("score").alias("negative_score")))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: ``embeddings`` with the stated labels, anchors and windows."""
    rows = pick(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), vec_id="vec_id", embedding="embedding", label="label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(spark, rows.withColumn("label", moved))


ORACLE = f"""
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS q
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.q, b.q)::BIGINT AS score
      FROM e a JOIN e b ON a.vec_id % {ANCHOR_EVERY} = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {POSITIVES})
SELECT anchor_id, positive_id, (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id))::INTEGER AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND {LOW} * positive_score <= 100 * score AND 100 * score <= {HIGH} * positive_score
QUALIFY rank <= {NEGATIVES}"""
