"""Prefix trie of conversations by a SQL ROLLUP over positional turn columns.

Method
------
1. Turns are numbered within their conversation and reduced to two position-salted
   64-bit ids; a prefix is named by the xor of its turns' ids (128 bits), so names are
   equal up to a hash collision, and no text moves after this step.
2. Conversations are laid out in *column blocks* of ``WIDTH`` turns.  A block row is
   keyed by the node that the block before it ends in (the root for the first block),
   so one ``GROUP BY key, ROLLUP (turn 1, .., turn WIDTH)`` aggregates every prefix of
   every block of all conversations together; ``grouping_id`` tells a prefix's length.
   A prefix that is longer than its conversations has a null in its last column and is
   dropped.
3. Subtree sums are a second ROLLUP, over the nodes themselves.  What hangs below a
   block's last column is added to the node that it hangs from first: totals of blocks
   are summed up the tree of blocks by pointer doubling, in log2(blocks) rounds.
4. The ids of the conversations that end in a node are joined in chunks of at most
   ``CHUNK`` ids, and the chunks of a node are hashed in order as a stream.

Skew: turns are numbered over range partitions, so that a conversation of any length is
split; every grouping has partial aggregation; joins are equi-joins on node names, unique
on one side.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import pick, written

#: Turns in a column block.
WIDTH = 8
#: The contract's rebuilding: followers of a conversation, and how many turns they may take.
FAMILY, MOST_TAKEN = 5, 8
#: Conversation ids that are joined to one string (ids are distinct, so chunks are bounded).
CHUNK = 65_536
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def turns_of(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, id, bytes): a digest of (role, text) and the text's UTF-8 length."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    return (pick(conversations, conv_id="conv_id", turn="turn", role="role", text="text")
            .filter("conv_id IS NOT NULL")
            .select(F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"),
                    F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary")).alias("id"),
                    F.octet_length(text).cast("bigint").alias("bytes")))


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by conv_id: ``at`` counts each conversation's rows within the partition."""
    last, count = None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        conv = batch.column("conv_id").to_numpy()
        first = np.flatnonzero(np.concatenate([[True], conv[1:] != conv[:-1]]))
        at = np.arange(len(conv)) - np.repeat(first, np.diff(np.append(first, len(conv))))
        if conv[0] == last:
            at[:first[1] if len(first) > 1 else len(conv)] += count
        last, count = conv[-1], int(at[-1]) + 1
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at.astype(np.int64))], names=[*batch.schema.names, "at"])


def numbered(spark: SparkSession, turns: DataFrame) -> DataFrame:
    """``turns`` with ``pos``, from 0, in the order of (turn, id), null turns first.

    A global sort over range partitions; a conversation that spans several of them
    continues its count from the partitions before.  At most one conversation per
    boundary does, so the offsets have fewer rows than there are partitions.
    """
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("id")]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    local = written(spark, turns.repartitionByRange(parts, *order).sortWithinPartitions(*order)
                    .mapInArrow(_number, "conv_id bigint, turn bigint, id string, bytes bigint, at bigint")
                    .withColumn("part", F.spark_partition_id()), "trie-turns")
    counts = local.groupBy("conv_id", "part").agg(F.count("*").alias("n"))
    spans = counts.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("part", "n"))).alias("parts")).filter("size(parts) > 1")
    before = spans.select("conv_id", F.posexplode("parts").alias("k", "p"), "parts").select(
        "conv_id", F.col("p.part").alias("part"),
        F.expr("aggregate(slice(parts, 1, k), 0L, (acc, x) -> acc + x.n)").alias("before"))
    return (local.join(F.broadcast(before), ["conv_id", "part"], "left")
            .select("conv_id", (F.col("at") + F.coalesce("before", F.lit(0))).alias("pos"), "id", "bytes"))


def rebuilt(turns: DataFrame) -> DataFrame:
    """The contract's conversations: the first h turns of conversation c - c % 5, then
    c's own turns after its first h, with h = crc32(c) % 9; c % 5 has the sign of c.
    """
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9
    ids = turns.select("conv_id").distinct()
    own = turns.withColumn("h", h).filter("pos >= h").select("conv_id", "pos", "id", "bytes")
    # a follower's base has at most MOST_TAKEN rows here, a base at most 2 * FAMILY - 1 followers
    base = turns.filter(F.col("pos") < MOST_TAKEN).filter(F.col("conv_id") % FAMILY == 0).withColumnRenamed("conv_id", "base")
    taken = (ids.withColumn("h", h).withColumn("base", F.col("conv_id") - F.col("conv_id") % FAMILY)
             .join(base, "base").filter("pos < h").select("conv_id", "pos", "id", "bytes"))
    # a base of fewer than h turns leaves a gap before the own turns: numbers close up
    have = base.groupBy("base").agg(F.count("*").alias("have"))
    gap = (ids.withColumn("h", h).withColumn("base", F.col("conv_id") - F.col("conv_id") % FAMILY)
           .join(have, "base", "left").select("conv_id", (F.col("h") - F.least(F.col("h"), F.coalesce("have", F.lit(0)))).alias("gap"))
           .filter("gap > 0"))
    own = own.join(gap, "conv_id", "left").select("conv_id", (F.col("pos") - F.coalesce("gap", F.lit(0))).alias("pos"), "id", "bytes")
    # every conversation has a row, also one that has no turns left
    return taken.union(own).union(ids.select("conv_id", F.lit(None).cast("bigint"), F.lit(None).cast("string"), F.lit(None).cast("bigint")))


def _xor(columns: list[str]) -> Column:
    return reduce(lambda a, b: a.bitwiseXOR(b), [F.coalesce(F.col(c), F.lit(0).cast("bigint")) for c in columns])


def column_blocks(spark: SparkSession, turns: DataFrame) -> DataFrame:
    """(conv_id, block, p1, p2, a0, b0, n0, ..): a row for each conversation and column block.

    ``a``/``b`` name the turns, ``n`` are their texts' bytes, p1/p2 name the node that
    the blocks before end in.  Conversations without turns have an empty first block.
    """
    pos = F.coalesce(F.col("pos"), F.lit(0))
    turns = turns.select(
        "conv_id", F.floor(pos / WIDTH).cast("int").alias("block"), (pos % WIDTH).cast("int").alias("slot"), "bytes",
        F.when(F.col("id").isNotNull(), F.xxhash64("id", "pos")).alias("a"),
        F.when(F.col("id").isNotNull(), F.xxhash64("pos", F.lit("turn"), "id")).alias("b"))
    pivot = [F.max(F.when(F.col("slot") == i, F.col(c))).alias(f"{n}{i}")
             for i in range(WIDTH) for c, n in (("a", "a"), ("b", "b"), ("bytes", "n"))]
    rows = turns.groupBy("conv_id", "block").agg(*pivot)
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # only conversations of several blocks need the names of the blocks before
    longer = written(spark, rows, "trie-blocks")
    zero = F.lit(0).cast("bigint")
    ids = longer.filter("block > 0").select("conv_id").distinct()
    names = (longer.join(ids, "conv_id", "left_semi")
             .select("conv_id", "block", _xor([f"a{i}" for i in range(WIDTH)]).alias("x"), _xor([f"b{i}" for i in range(WIDTH)]).alias("y"))
             .select("conv_id", "block", F.expr("bit_xor(x)").over(before).alias("p1"), F.expr("bit_xor(y)").over(before).alias("p2"))
             .filter("block > 0"))
    out = (longer.join(names, ["conv_id", "block"], "left")
           .withColumn("p1", F.coalesce("p1", zero)).withColumn("p2", F.coalesce("p2", zero)))
    return written(spark, out, "trie-layout")


def _rollup(view: str, measures: str) -> str:
    """Every prefix of the block rows in ``view``, with its length; see the module's text."""
    turns = ", ".join(f"(a{i}, b{i})" for i in range(WIDTH))
    names = ", ".join(f"a{i}, b{i}" for i in range(WIDTH))
    last = ", ".join(f"a{i}" for i in range(WIDTH))
    return f"""
      SELECT * FROM (
        SELECT block, p1, p2, {names}, {WIDTH} - CAST(bit_count(grouping_id()) / 2 AS INT) AS len, {measures}
        FROM {view} GROUP BY block, p1, p2, ROLLUP ({turns}))
      WHERE len = 0 OR element_at(array({last}), greatest(len, 1)) IS NOT NULL"""


def _named(nodes: DataFrame) -> DataFrame:
    """Adds k1/k2, the node's name: the block's key xor the turns of the prefix."""
    return (nodes.withColumn("k1", F.col("p1").bitwiseXOR(_xor([f"a{i}" for i in range(WIDTH)])))
            .withColumn("k2", F.col("p2").bitwiseXOR(_xor([f"b{i}" for i in range(WIDTH)]))))


def _sql(spark: SparkSession, df: DataFrame, query) -> DataFrame:
    return spark.sql(query("{rows}"), rows=df)


def below(spark: SparkSession, totals: DataFrame) -> DataFrame:
    """(k1, k2, leaves, saved): sums over all blocks below each block boundary.

    ``totals``: k1, k2 (the boundary), u1, u2 (the boundary above, null at the top) and
    the block's own sums.  Round k adds the sums of the boundaries 2^k levels below.
    """
    up = written(spark, totals, "trie-up")
    while not up.filter("u1 IS NOT NULL").isEmpty():
        add = (up.filter("u1 IS NOT NULL").groupBy(F.col("u1").alias("k1"), F.col("u2").alias("k2"))
               .agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved")))
        above = up.select(F.col("k1").alias("u1"), F.col("k2").alias("u2"), F.col("u1").alias("w1"), F.col("u2").alias("w2"))
        up = written(spark, up.join(add, ["k1", "k2"], "left").join(above, ["u1", "u2"], "left").select(
            "k1", "k2", F.col("w1").alias("u1"), F.col("w2").alias("u2"),
            (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"),
            (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved")), "trie-up")
    return up.select("k1", "k2", "leaves", "saved")


def _stream_sha(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (k1, k2, chunk): SHA-256 of each node's chunks, joined by commas."""
    key, digest, schema = None, None, ["k1", "k2", "ends_sha256"]
    for batch in batches:
        out = []
        for k1, k2, ids in zip(*(batch.column(c).to_pylist() for c in ("k1", "k2", "ids"))):
            if (k1, k2) != key:
                if key is not None:
                    out.append((*key, digest.hexdigest()))
                key, digest = (k1, k2), hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(
            zip(*out) if out else ([], [], []), (pa.int64(), pa.int64(), pa.string()))], names=schema)
    if key is not None:
        yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(
            (*key, digest.hexdigest()), (pa.int64(), pa.int64(), pa.string()))], names=schema)


def ends(conversations: DataFrame) -> DataFrame:
    """(k1, k2, ends_sha256) of nodes in which conversations (conv_id, k1, k2) end."""
    chunks = (conversations.withColumn("chunk", F.floor(F.col("conv_id") / CHUNK))
              .groupBy("k1", "k2", "chunk")
              .agg(F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids")))
    return (chunks.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "chunk")
            .mapInArrow(_stream_sha, "k1 bigint, k2 bigint, ends_sha256 string"))


def trie(spark: SparkSession, turns: DataFrame) -> DataFrame:
    """A row for each node of the trie of ``turns`` (conv_id, pos, id, bytes).

    ``pos`` counts from 0 without gaps; a conversation without turns has one row of
    null pos and id.  ``id`` names a turn, ``bytes`` is its saving.
    """
    layout = column_blocks(spark, turns)
    counts = ", ".join(f"max(n{i})" for i in range(WIDTH))
    nodes = _named(_sql(spark, layout, lambda v: _rollup(v, f"min(conv_id) AS conv_id, count(*) AS n_convs, array({counts}) AS sizes")))
    nodes = nodes.filter("len > 0 OR block = 0")
    last = F.greatest(F.col("len"), F.lit(1))
    nodes = (nodes.withColumn("saving", F.when(F.col("len") > 0, (F.col("n_convs") - 1) * F.element_at("sizes", last)).otherwise(F.lit(0)))
             .withColumn("depth", (F.col("block") * WIDTH + F.col("len")).cast("bigint"))
             .withColumn("m1", F.element_at(F.array(*[f"a{i}" for i in range(WIDTH)]), last))
             .withColumn("m2", F.element_at(F.array(*[f"b{i}" for i in range(WIDTH)]), last))
             # the parent's name: the own one without the last turn
             .withColumn("u1", F.when(F.col("len") > 0, F.col("k1").bitwiseXOR(F.col("m1"))))
             .withColumn("u2", F.when(F.col("len") > 0, F.col("k2").bitwiseXOR(F.col("m2"))))
             .drop("m1", "m2", "sizes"))
    nodes = written(spark, nodes, "trie-nodes")
    children = (nodes.filter("u1 IS NOT NULL").groupBy(F.col("u1").alias("k1"), F.col("u2").alias("k2"))
                .agg(F.count("*").alias("n_children")))
    nodes = written(spark, nodes.join(children, ["k1", "k2"], "left").fillna(0, ["n_children"])
                    .withColumn("leaves", (F.col("n_children") == 0).cast("bigint")), "trie-nodes")

    own = nodes
    deeper = nodes.filter("block > 0")
    if not deeper.isEmpty():
        totals = deeper.groupBy(F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(
            F.sum("leaves").alias("leaves"), F.sum("saving").alias("saved"))
        boundary = nodes.filter(F.col("len") == WIDTH).select(
            "k1", "k2", F.when(F.col("block") > 0, F.col("p1")).alias("u1"), F.when(F.col("block") > 0, F.col("p2")).alias("u2"))
        hanging = below(spark, totals.join(boundary, ["k1", "k2"])).select(
            "k1", "k2", F.col("leaves").alias("hanging_leaves"), F.col("saved").alias("hanging_saved"))
        own = (nodes.join(hanging, ["k1", "k2"], "left")
               .withColumn("leaves", F.col("leaves") + F.coalesce("hanging_leaves", F.lit(0)))
               .withColumn("saving", F.col("saving") + F.coalesce("hanging_saved", F.lit(0))))
    sums = (_named(_sql(spark, own, lambda v: _rollup(v, "sum(leaves) AS n_leaves, sum(saving) AS saved_tokens")))
            .filter("len > 0 OR block = 0").select("k1", "k2", "n_leaves", "saved_tokens"))

    every = [f"{c}{i}" for i in range(WIDTH) for c in "ab"]
    ending = (layout.select("conv_id", "block", *every, "p1", "p2").groupBy("conv_id")
              .agg(F.max_by(F.struct("p1", "p2", *every), "block").alias("r")).select("conv_id", "r.*"))
    closed = ends(_named(ending).select("conv_id", "k1", "k2"))
    parents = nodes.filter("n_children > 0").select(
        F.col("k1").alias("u1"), F.col("k2").alias("u2"), F.col("conv_id").alias("parent_conv_id"))
    return (nodes.select("k1", "k2", "u1", "u2", "conv_id", "depth", "n_convs", "n_children")
            .join(sums, ["k1", "k2"]).join(closed, ["k1", "k2"], "left").join(parents, ["u1", "u2"], "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                    F.coalesce("ends_sha256", F.lit(EMPTY_SHA)).alias("ends_sha256")))


def prefix_trie(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    """The trie of the conversations as they are: see ``trie``.

    Rows without a conv_id belong to no conversation and are left out.  Turns of one
    number follow each other in the order of a digest of (role, text); repeated rows
    are turns of their own.  No conversation: no node, not even the root.
    """
    return trie(spark, numbered(spark, turns_of(conversations)))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: the trie of the rebuilt conversations."""
    turns = numbered(spark, turns_of(spark.read.parquet(f"{sf_dir}/conversations.parquet")))
    return trie(spark, rebuilt(written(spark, turns, "trie-numbered")))


ORACLE = """
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
           md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
crc AS (  -- CRC-32, reflected polynomial, bit by bit over the digits of the id
  SELECT conv_id, list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::UBIGINT)),
    lambda acc, ch: list_reduce(list_prepend(xor(acc, ch), list_transform(range(8), lambda i: i::UBIGINT)),
      lambda r, i: CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384::UBIGINT) ELSE r >> 1 END)) AS r
  FROM (SELECT DISTINCT conv_id FROM t)),
c AS (SELECT conv_id, (xor(r, 4294967295::UBIGINT) % 9)::BIGINT AS h FROM crc),
turns AS (
  SELECT c.conv_id, 0 AS part, t.pos, t.role, t.text FROM c JOIN t ON t.conv_id = c.conv_id - c.conv_id % 5 AND t.pos <= c.h
  UNION ALL
  SELECT c.conv_id, 1, t.pos, t.role, t.text FROM c JOIN t ON t.conv_id = c.conv_id AND t.pos > c.h),
conv AS (
  SELECT c.conv_id, coalesce(list({'role': role, 'text': text} ORDER BY part, pos) FILTER (WHERE pos IS NOT NULL), []) AS path
  FROM c LEFT JOIN turns USING (conv_id) GROUP BY c.conv_id),
member AS (SELECT conv_id, len(path) AS n, unnest(range(0, len(path) + 1)) AS depth, path FROM conv),
node AS (
  SELECT path[1:depth] AS prefix, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE n = depth), '')) AS ends_sha256
  FROM member GROUP BY ALL),
full_node AS (
  SELECT n.*, p.conv_id AS parent_conv_id, coalesce(k.n_children, 0) AS n_children,
         CASE WHEN n.depth = 0 THEN 0 ELSE (n.n_convs - 1) * strlen(n.prefix[n.depth].text) END AS saving
  FROM node n LEFT JOIN node p ON n.depth > 0 AND p.depth = n.depth - 1 AND p.prefix = n.prefix[1:n.depth - 1]
  LEFT JOIN (SELECT prefix[1:depth - 1] AS prefix, depth - 1 AS depth, count(*) AS n_children FROM node WHERE depth > 0 GROUP BY ALL) k
    ON k.depth = n.depth AND k.prefix = n.prefix),
sums AS (
  SELECT a.depth, a.conv_id, sum(CASE WHEN b.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum(b.saving) AS saved_tokens
  FROM full_node a JOIN full_node b ON b.depth >= a.depth AND b.prefix[1:a.depth] = a.prefix GROUP BY ALL)
SELECT f.conv_id, f.depth::BIGINT AS depth, f.parent_conv_id, f.n_convs::BIGINT AS n_convs, f.n_children::BIGINT AS n_children,
       s.n_leaves::BIGINT AS n_leaves, s.saved_tokens::BIGINT AS saved_tokens, f.ends_sha256
FROM full_node f JOIN sums s ON s.depth = f.depth AND s.conv_id = f.conv_id"""
