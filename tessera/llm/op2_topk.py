"""Exact top-k search over binary codes by incremental multi-index hashing.

A vector's code has a bit for each component, set where the component is
positive.  Codes are cut into segments of 16 bits, and an index maps each
segment value to the codes that have it.  The search of a query grows step by
step: step (a, j) looks up, in segment j, all values that differ from the
query's in exactly ``a`` bits, and verifies the codes found by their full Hamming
distance.  After it, every code within ``m * a + j`` has been found (m segments):
one that has not differs by more than ``a`` bits in segments up to j and by ``a`` or
more in the others.  A query ends when its k-th verified distance is covered by
that radius, so the result is exact.  Where a step would look up more values
than the block has codes, the rest of the block is verified instead.

The stated query set (ids divisible by ``QUERY_EVERY``) meets all rows in blocks: a task
indexes up to ``CODE_BLOCK`` codes once and searches them for all queries, which come to it
in a stream.  Queries are the small side, so they are what is copied to each block; codes
move once.  (Only where there are fewer blocks than cores, so in small tables, a block
goes to several tasks, each with a part of the queries: smaller blocks would cost more, as
the k-th neighbour in them is farther.)  Each task returns k rows a query; the k best of a query's rows over all
blocks are its result, ties by the smaller id.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import pick, written

K = 10
QUERY_EVERY = 20
SEGMENT = 16
#: Most codes in a block, and about how few queries are worth a task of their own.
CODE_BLOCK, QUERY_RUN = 65_536, 256
#: Queries searched at once inside a task (a byte for each query and code).
BATCH = 128


def _codes(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """Sign bits of the embeddings, packed; missing components count as not positive."""
    for batch in batches:
        rows = batch.column("embedding")
        sign = np.zeros((batch.num_rows, bits), dtype=np.uint8)
        if len(rows):
            values = np.nan_to_num(rows.values.to_numpy(zero_copy_only=False).astype(np.float64), nan=0.0)
            bounds = rows.offsets.to_numpy()
            lengths = np.diff(bounds)
            at = np.repeat(np.arange(len(rows)), lengths)
            column = np.arange(bounds[0], bounds[-1]) - np.repeat(bounds[:-1], lengths)
            sign[at, column] = values[bounds[0]:bounds[-1]] > 0
        packed = np.packbits(sign, axis=1)
        yield pa.RecordBatch.from_arrays(
            [batch.column("vec_id"), pa.array([p.tobytes() for p in packed], pa.binary())], names=["vec_id", "code"])


def codes(vectors: DataFrame) -> DataFrame:
    """(vec_id, code) of every vector that has an id and an embedding.

    The code is as long as the longest embedding, rounded up to whole segments;
    shorter ones are padded with zero bits.
    """
    rows = pick(vectors, vec_id="vec_id", embedding="embedding").filter(
        "vec_id IS NOT NULL AND embedding IS NOT NULL").select(F.col("vec_id").cast("bigint"), "embedding")
    longest = rows.agg(F.max(F.size("embedding"))).first()[0] or 1
    bits = -(-longest // SEGMENT) * SEGMENT
    return rows.mapInArrow(partial(_codes, bits=bits), "vec_id bigint, code binary")


def flips(a: int) -> np.ndarray:
    """All 16-bit masks of exactly ``a`` bits."""
    return np.array([sum(1 << b for b in c) for c in combinations(range(SEGMENT), a)], dtype=np.int64)


class Index:
    """A block of codes (rows of 16-bit segments) with each segment's values in order."""

    def __init__(self, block: np.ndarray):
        self.block, (self.n, self.m) = block, block.shape
        self.order = [np.argsort(block[:, j], kind="stable") for j in range(self.m)]
        self.begin = [np.searchsorted(block[o, j], np.arange((1 << SEGMENT) + 1)) for j, o in enumerate(self.order)]


def search(index: Index, queries: np.ndarray, k: int) -> list[np.ndarray]:
    """Per query, the positions of the block's codes that may be among its k nearest:
    all codes within the k-th smallest distance."""
    n, m, order, begin = index.n, index.m, index.order, index.begin
    k = min(k, n)
    wide = index.block.view(np.uint16)
    found: list[np.ndarray] = []
    for lo in range(0, len(queries), BATCH):
        q = queries[lo:lo + BATCH]
        seen = np.full((len(q), n), 255, dtype=np.uint8) if m * SEGMENT < 255 else np.full((len(q), n), 65535, dtype=np.uint16)
        top = seen.max()
        counts = np.zeros((len(q), m * SEGMENT + 1), dtype=np.int64)  # verified codes by distance
        active = np.arange(len(q))

        def verify(rows: np.ndarray, at: np.ndarray) -> None:
            new = seen[rows, at] == top
            both = np.unique(rows[new] * n + at[new])
            rows, at = both // n, both % n
            d = np.bitwise_count(wide[at] ^ q[rows]).sum(axis=1, dtype=np.int64)
            seen[rows, at] = d
            np.add.at(counts, (rows, d), 1)

        for a in range(SEGMENT + 1):
            masks = flips(a)
            for j in range(m):
                if not len(active):
                    break
                if len(masks) > n:  # looking up costs more than looking at all
                    for row in active:
                        verify(np.full(n, row), np.arange(n))
                    covered = m * SEGMENT
                else:
                    value = q[active, j].astype(np.int64)[:, None] ^ masks[None, :]
                    first, many = begin[j][value].ravel(), (begin[j][value + 1] - begin[j][value]).ravel()
                    rows = np.repeat(np.repeat(active, len(masks)), many)
                    step = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                    verify(rows, order[j][np.repeat(first, many) + step])
                    covered = m * a + j
                kth = (np.cumsum(counts[active], axis=1) >= k).argmax(axis=1)
                enough = counts[active].sum(axis=1) >= k
                active = active[~(enough & (kth <= covered))]
        kth = (np.cumsum(counts, axis=1) >= k).argmax(axis=1)
        found += [np.flatnonzero(seen[i] <= kth[i]) for i in range(len(q))]
    return found


def _codes_of(raw: list[bytes]) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(b"".join(raw), dtype=">u2").astype(np.uint16).reshape(len(raw), -1))


def _search(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Rows of one block, codes (query false) before queries (query true)."""
    ids: list[int] = []
    raw: list[bytes] = []
    index = None
    for batch in batches:
        asked: list[tuple[int, bytes]] = []
        for vec_id, code, query in zip(*(batch.column(c).to_pylist() for c in ("vec_id", "code", "query"))):
            if query:
                asked.append((vec_id, code))
            else:
                ids.append(vec_id)
                raw.append(code)
        if not asked or not ids:
            continue
        if index is None:
            index, block_ids = Index(_codes_of(raw)), np.array(ids, dtype=np.int64)
            raw.clear()
        queries = _codes_of([c for _, c in asked])
        out_q, out_v, out_d = [], [], []
        for i, at in enumerate(search(index, queries, k)):
            d = np.bitwise_count(index.block[at] ^ queries[i]).sum(axis=1, dtype=np.int64)
            best = np.lexsort((block_ids[at], d))[:k]
            out_q.append(np.full(len(best), asked[i][0]))
            out_v.append(block_ids[at][best])
            out_d.append(d[best])
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (out_q, out_v, out_d)],
                                         names=["query_id", "vec_id", "distance"])


def deal(spark: SparkSession, rows: DataFrame, asking: DataFrame) -> tuple[DataFrame, int]:
    """Codes and queries (task, vec_id, code, query) and the number of tasks."""
    blocks = max(1, -(-rows.count() // CODE_BLOCK))
    runs = max(1, min(-(-4 * spark.sparkContext.defaultParallelism // blocks), -(-asking.count() // QUERY_RUN)))
    block = F.pmod(F.xxhash64("vec_id", "code", F.monotonically_increasing_id()), F.lit(blocks))
    run = F.pmod(F.xxhash64("vec_id", "code"), F.lit(runs))
    upto = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dealt = (rows.select(block.alias("block"), upto(runs).alias("run"), "vec_id", "code", F.lit(False).alias("query"))
             .union(asking.select(upto(blocks), run, "vec_id", "code", F.lit(True)))
             .withColumn("task", (F.col("block") * runs + F.col("run")).cast("int")))
    return dealt, blocks * runs


def top_k(spark: SparkSession, vectors: DataFrame, k: int = K, every: int = QUERY_EVERY) -> DataFrame:
    """(query_id, rank, vec_id, distance): for each id divisible by ``every``, its k nearest
    codes among all rows, itself included; ties by the smaller id.

    A null embedding has no code and a null id no name: such rows neither ask nor
    answer.  Repeated rows answer as often as they are there and ask once; an id
    that has several codes asks with each, and its k nearest are those of all.
    """
    rows = written(spark, codes(vectors), "topk-codes")
    asking = rows.filter(F.col("vec_id") % every == 0).dropDuplicates(["vec_id", "code"])
    dealt, tasks = deal(spark, rows, asking)
    near = (dealt.repartitionById(tasks, F.col("task")).select("vec_id", "code", "query")
            .sortWithinPartitions("query", "vec_id")
            .mapInArrow(partial(_search, k=k), "query_id bigint, vec_id bigint, distance bigint"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("distance", "vec_id"))
    return near.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "distance")


def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding whose id is divisible by 20, against all of ``embeddings``."""
    return top_k(spark, spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


ORACLE = f"""
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: coalesce(x, 0) > 0) AS code FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL),
d AS (SELECT q.vec_id AS query_id, e.vec_id,
             len(list_filter(list_zip(q.code, e.code), lambda p: p[1] <> p[2]))::BIGINT AS distance
      FROM (SELECT DISTINCT vec_id, code FROM e WHERE vec_id % {QUERY_EVERY} = 0) q, e)
SELECT query_id, rank, vec_id, distance FROM (
  SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id))::INTEGER AS rank FROM d)
WHERE rank <= {K}"""
