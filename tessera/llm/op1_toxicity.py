"""Toxicity: FTRL-proximal logistic regression over hashed n-grams and skip-grams.

Features of a text are the *presence* of its words, word pairs and one-gap
skip pairs, hashed into ``2 ** BITS`` coordinates (words are runs of ASCII
letters, digits and non-ASCII characters, A-Z lower-cased).  Presence instead
of counts keeps a long text comparable with a short one.

Training uses a bounded sample of the labelled rows, drawn by a hash of the id.
Its features are made by all tasks; FTRL-proximal, with per-coordinate rates and
L1 sparsity, then passes over that sample in one task.  L1 leaves a few hundred
non-zero weights: the model is collected and broadcast only after its size is
checked against ``MAX_WEIGHTS``.

Scoring streams over the whole texts, a block at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import held_out, pick, written
from tessera.llm.textcore import ALNUM, U64, Words, blocks, mix, words

BITS = 20
#: Labelled rows that are learned from, at most about; sampled by a hash of the id.
MAX_TRAINING_ROWS = 24_000
EPOCHS = 4
ALPHA, BETA, L1, L2 = 2.0, 1.0, 4.0, 1.0
#: Non-zero weights that may be broadcast (12 bytes each).
MAX_WEIGHTS = 1 << BITS

_KINDS = ((1, 0), (2, 1), (3, 2))  # (salt, distance of the second word); 0: the word alone


def _coordinates(w: Words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per kind of feature: hashed coordinate and text number of each occurrence."""
    text = np.repeat(np.arange(len(w.counts)), w.counts)
    shift = U64(64 - BITS)
    for salt, gap in _KINDS:
        if gap == 0:
            yield (mix(w.hashes + U64(salt)) >> shift).astype(np.int64), text
        elif len(text) > gap:
            same = text[gap:] == text[:-gap]
            pair = mix(mix(w.hashes[:-gap] + U64(salt)) ^ w.hashes[gap:])
            yield (pair >> shift).astype(np.int64)[same], text[gap:][same]


def _featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Text column to its sorted distinct coordinates."""
    for batch in batches:
        for first, last, data, offsets in blocks(batch.column("text")):
            w = words(data, offsets, ALNUM)
            parts = [t.astype(np.int64) << BITS | c for c, t in _coordinates(w)]
            both = np.unique(np.concatenate(parts))
            bounds = np.searchsorted(both, np.arange(last - first + 1, dtype=np.int64) << BITS)
            yield pa.RecordBatch.from_arrays(
                [batch.column(c).slice(first, last - first) for c in ("at", "label")]
                + [pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)),
                                            pa.array((both & ((1 << BITS) - 1)).astype(np.int32)))],
                names=["at", "label", "x"])


def ftrl(rows: list[tuple[int, np.ndarray]], epochs: int) -> tuple[np.ndarray, float]:
    """FTRL-proximal over (label, coordinates); dense weights and the bias.

    Per coordinate: z gathers shifted gradients, n their squares; the rate is
    alpha / (beta + sqrt(n)), and a weight is zero while abs(z) <= L1.
    """
    z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)
    bias_z = bias_n = bias = 0.0

    def weights(i: np.ndarray) -> np.ndarray:
        zi = z[i]
        shrunk = np.sign(zi) * np.maximum(np.abs(zi) - L1, 0.0)
        return -shrunk / ((BETA + np.sqrt(n[i])) / ALPHA + L2)

    for _ in range(epochs):
        for label, x in rows:
            w = weights(x)
            p = 1.0 / (1.0 + np.exp(-np.clip(w.sum() + bias, -35.0, 35.0)))
            g = p - label
            nx = n[x]
            z[x] += g - (np.sqrt(nx + g * g) - np.sqrt(nx)) / ALPHA * w
            n[x] = nx + g * g
            bias_z += g - (np.sqrt(bias_n + g * g) - np.sqrt(bias_n)) / ALPHA * bias
            bias_n += g * g
            bias = -bias_z / ((BETA + np.sqrt(bias_n)) / ALPHA)
    return weights(np.arange(1 << BITS)), bias


def _train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The model of all rows of the partition: (coordinate, weight); the bias at -1."""
    rows = []
    for batch in batches:
        x = batch.column("x")
        bounds, values = x.offsets.to_numpy(), x.values.to_numpy()
        for k, (at, label) in enumerate(zip(batch.column("at").to_pylist(),
                                            batch.column("label").to_pylist())):
            rows.append((at, label, values[bounds[k]:bounds[k + 1]].copy()))
    if rows:
        rows.sort(key=lambda r: (r[0], r[1], len(r[2])))  # an order that reruns repeat
        w, bias = ftrl([(label, x) for _, label, x in rows], EPOCHS)
        at = np.flatnonzero(w)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1).astype(np.int32)),
                                          pa.array(np.append(w[at], bias))], names=["i", "w"])


def training_rows(docs: DataFrame, labels: DataFrame, label: str, max_rows: int) -> DataFrame:
    """(doc_id, text, label): at most about ``max_rows`` labelled rows outside the held-out fifth.

    The sample is drawn by a hash of doc_id, so it does not depend on the order
    of the rows.  Null labels and ids are left out.
    """
    known = (pick(labels, doc_id="doc_id", label=label)
             .filter(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max("label").cast("int").alias("label")))
    share = min(1.0, max_rows / max(1, known.count()))
    drawn = known.filter(F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit("sample")),
                                F.lit(1_000_003)) < int(share * 1_000_003) + 1)
    # at most about max_rows narrow rows: broadcast, so that the texts stay where they are
    return pick(docs, doc_id="doc_id", text="text").join(F.broadcast(drawn), "doc_id")


def fit(spark: SparkSession, docs: DataFrame, labels: DataFrame, label: str = "toxic",
        max_rows: int = MAX_TRAINING_ROWS) -> tuple[np.ndarray, np.ndarray, float]:
    """Model: non-zero coordinates, their weights, the bias.

    Without any labelled row the model is empty and every score is 0.5.
    """
    at = F.xxhash64(F.col("doc_id").cast("string"), F.lit("order"))
    rows = written(spark, training_rows(docs, labels, label, max_rows)
                   .select(at.alias("at"), "label", "text")
                   .mapInArrow(_featurise, "at bigint, label int, x array<int>"), "tox-rows")
    model = written(spark, rows.repartition(1).mapInArrow(_train, "i int, w double"), "tox-model")
    if model.count() > MAX_WEIGHTS + 1:
        raise ValueError("the model has more weights than may be broadcast")
    got = sorted((r.i, r.w) for r in model.collect())
    bias = got[0][1] if got and got[0][0] == -1 else 0.0
    got = [g for g in got if g[0] >= 0]
    return (np.array([i for i, _ in got], dtype=np.int64), np.array([w for _, w in got]), float(bias))


def _score(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    at, values, bias = model.value
    dense = np.zeros(1 << BITS, dtype=np.float64)
    dense[at] = values
    live = dense != 0.0
    for batch in batches:
        for first, last, data, offsets in blocks(batch.column("text")):
            w = words(data, offsets, ALNUM)
            total = np.full(last - first, bias)
            hits = [text[live[c]] << BITS | c[live[c]] for c, text in _coordinates(w)]
            both = np.unique(np.concatenate(hits))
            np.add.at(total, both >> BITS, dense[both & ((1 << BITS) - 1)])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(first, last - first),
                 pa.array(1.0 / (1.0 + np.exp(-np.clip(total, -35.0, 35.0))))],
                names=["doc_id", "score"])


def score(spark: SparkSession, docs: DataFrame, model: tuple) -> DataFrame:
    """(doc_id, score) of every row; null and empty texts get the bias alone."""
    shared = spark.sparkContext.broadcast(model)
    ids = pick(docs, doc_id="doc_id", text="text").select(F.col("doc_id").cast("bigint"), "text")
    return ids.mapInArrow(partial(_score, model=shared), "doc_id bigint, score double")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: toxicity of every document, fitted on ``labels.toxic``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return score(spark, docs, fit(spark, docs, labels)).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))

