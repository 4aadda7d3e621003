"""Quality: Bradley-Terry ranking of documents learned from preference pairs.

Every text is described by a few dense features: shares of characters and words
of certain shapes, and how repetitive it is.  A document's latent score is a
linear function of its standardised features.  The model is learned from
preference pairs (a good text beats a bad one): the chance that a beats b is
sigmoid(score(a) - score(b)), so fitting is logistic loss on the *difference*
of the features of a and b, without an intercept.

A pairwise model fixes the order of documents, not a cut.  The cut is the
training scores' quantile at the share of bad documents; the published score
is a sigmoid that gives that quantile exactly ``CUT``.

The features are computed by Spark over whole texts, of every labelled row outside
the held-out fifth.  Every pair counts: a pass over the rows sums their features by
score in bins (a row is shared out between the two nearest of a grid of ``WIDTH``),
and the pairs' loss and slope follow from those sums, so a pass costs as much as the rows, not
the pairs.  A quasi-Newton climb makes at most ``PASSES`` such passes; the cut is counted over all rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import held_out, pick, position, tag, written
from tessera.llm.textcore import NON_SPACE, blocks, words

RIDGE = 1e-3
PASSES, FLAT = 80, 1e-3     # passes over the rows at most; slope at which the climb ends
WIDTH, CLIP = 1 / 32, 8.0   # of the grid of scores; bound of a standardised feature
CUT_BINS = 4096
CUT = 0.3

FEATURES = ("upper", "lower", "digit", "symbol", "comma_stop", "bang", "pipe", "high",
            "log_words", "word_length", "lone_symbol", "symbol_end", "upper_words",
            "distinct", "repeat_next", "repeat_five", "longest_run", "lines")

_CLASS = np.zeros(256, dtype=np.uint8)
_CLASS[0x41:0x5B] = 1
_CLASS[0x61:0x7B] = 2
_CLASS[0x30:0x3A] = 3
for _c in range(0x21, 0x80):
    if not _CLASS[_c]:
        _CLASS[_c] = 4
for _c in b",.;:'":
    _CLASS[_c] = 5
_CLASS[ord("!")] = 6
_CLASS[ord("|")] = 7
_CLASS[0x80:] = 8


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    return total[bounds[1:]] - total[bounds[:-1]]


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(texts, FEATURES) of a block of texts; a text without words is all zeros."""
    kinds = _CLASS[data]
    w = words(data, offsets, NON_SPACE)
    n = w.counts.astype(np.float64)
    length = np.maximum(np.diff(offsets).astype(np.float64), 1.0)
    per_word = np.maximum(n, 1.0)
    out = np.zeros((len(n), len(FEATURES)))
    for i in range(8):
        out[:, i] = _sums(kinds == i + 1, offsets) / length
    out[:, 8] = np.log1p(n)
    size = (w.ends - w.starts).astype(np.float64)
    out[:, 9] = _sums(size, w.bounds) / per_word
    if len(w.starts):
        first, last = kinds[w.starts], kinds[w.ends - 1]
        marks = np.isin(kinds, (4, 6, 7))
        out[:, 10] = _sums((size == 1) & marks[w.starts], w.bounds) / per_word
        out[:, 11] = _sums(marks[w.ends - 1] & (size > 1), w.bounds) / per_word
        both = (first == 1) & (kinds[np.minimum(w.starts + 1, w.ends - 1)] == 1) & (size > 1)
        out[:, 12] = _sums(both, w.bounds) / per_word
        text = np.repeat(np.arange(len(n)), w.counts)
        order = np.lexsort((w.hashes, text))
        new = np.ones(len(text), dtype=bool)
        new[1:] = (w.hashes[order][1:] != w.hashes[order][:-1]) | (text[order][1:] != text[order][:-1])
        out[:, 13] = _sums(new, w.bounds) / np.maximum(np.sqrt(n), 1.0)  # distinct words over root length
        for column, gap in ((14, 1), (15, 5)):
            again = np.zeros(len(text))
            if len(text) > gap:
                again[gap:] = (w.hashes[gap:] == w.hashes[:-gap]) & (text[gap:] == text[:-gap])
            out[:, column] = _sums(again, w.bounds) / per_word
        out[:, 16] = _frequent(order, new, text, len(n)) / per_word
    out[:, 17] = _sums(data == 0x0A, offsets) / per_word
    out[n == 0] = 0.0
    return out


def _frequent(order: np.ndarray, new: np.ndarray, text: np.ndarray, texts: int) -> np.ndarray:
    """Occurrences of each text's most frequent word."""
    starts = np.flatnonzero(new)
    counts = np.diff(np.append(starts, len(new)))
    most = np.zeros(texts)
    np.maximum.at(most, text[order][starts], counts)
    return most


@dataclass
class Model:
    """Standardisation, weights, and the raw score at the cut."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cut: float

    def standard(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -CLIP, CLIP)

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.standard(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        logit = self.raw(x) - self.cut + np.log(CUT / (1 - CUT))
        return 1.0 / (1.0 + np.exp(-np.clip(logit, -35.0, 35.0)))


Block = tuple[np.ndarray, np.ndarray]  # features of some rows, their labels


def moments(blocks_of_rows: Iterable[Block]) -> np.ndarray:
    """(3, 1 + k + k * k): of bad, good and other rows the count, the features' sums and those of their products."""
    total = np.zeros((3, 1 + len(FEATURES) + len(FEATURES) ** 2))
    for x, good in blocks_of_rows:
        for kind, at in enumerate((good == 0, good == 1, (good != 0) & (good != 1))):
            total[kind] += np.concatenate([[at.sum()], x[at].sum(axis=0), (x[at].T @ x[at]).ravel()])
    return total


def _reach(weights: np.ndarray) -> int:
    """Grid points on each side of zero that scores can come to."""
    return int(CLIP * np.abs(weights).sum() / WIDTH) + 2


def graded(blocks_of_rows: Iterable[Block], model: Model) -> np.ndarray:
    """(2, grid points, 1 + k): count and feature sums of bad and of good rows by score."""
    reach = _reach(model.weights)
    total = np.zeros((2, 2 * reach + 1, 1 + len(FEATURES)))
    flat = total.reshape(-1, total.shape[2])
    for x, good in blocks_of_rows:
        paired = (good == 0) | (good == 1)
        z = model.standard(x[paired])
        at = z @ model.weights / WIDTH + reach
        low = np.floor(at).astype(np.int64)
        row = np.column_stack([np.ones(len(z)), z])
        for point, share in ((low, low + 1 - at), (low + 1, at - low)):
            key = good[paired] * total.shape[1] + point
            order = np.argsort(key, kind="stable")
            first = np.flatnonzero(np.diff(key[order], prepend=-1))
            if len(first):
                flat[key[order][first]] += np.add.reduceat((row * share[:, None])[order], first)
    return total


def _spread(counts: np.ndarray, kernel: np.ndarray) -> np.ndarray:
    """At each grid point b the sum of counts[c] * kernel(b - c); ``kernel`` begins at the most negative distance."""
    size = len(counts) + len(kernel)
    both = np.fft.irfft(np.fft.rfft(counts, size) * np.fft.rfft(kernel, size), size)
    return both[len(counts) - 1:2 * len(counts) - 1]


def pair_loss(total: np.ndarray, weights: np.ndarray) -> tuple[float, np.ndarray]:
    """Mean loss over all pairs of a good and a bad row, with its slope, from :func:`graded`'s sums."""
    bad, good = total
    lead = np.arange(1 - len(bad), len(bad)) * WIDTH  # of the good row's score
    doubt = 1.0 / (1.0 + np.exp(np.clip(lead, -700.0, 700.0)))
    pairs = bad[:, 0].sum() * good[:, 0].sum()
    loss = good[:, 0] @ _spread(bad[:, 0], np.logaddexp(0.0, -lead)) / pairs
    slope = (_spread(good[:, 0], doubt[::-1]) @ bad[:, 1:] - _spread(bad[:, 0], doubt) @ good[:, 1:]) / pairs
    return loss + RIDGE / 2 * weights @ weights, slope + RIDGE * weights


def climb(loss_at: Callable[[np.ndarray], tuple[float, np.ndarray]], curvature: np.ndarray) -> np.ndarray:
    """Weights of least loss by BFGS steps that begin with the curvature at zero.

    They are rounded, so that the order in which tasks' sums are added leaves no trace.
    """
    weights, inverse = np.zeros(len(curvature)), np.linalg.inv(curvature)
    (loss, slope), passes, size = loss_at(weights), 1, 1.0
    while passes < PASSES and np.abs(slope).max() > FLAT and size > 1e-3:
        way = -inverse @ slope
        trial = np.round(weights + size * way, 9)
        if RIDGE / 2 * trial @ trial > loss:  # worse whatever the pairs say
            size /= 2
            continue
        new_loss, new_slope = loss_at(trial)
        passes += 1
        if new_loss > loss + 1e-4 * size * (slope @ way):
            size /= 2
            continue
        step, change = trial - weights, new_slope - slope
        if step @ change > 0:
            turn = np.eye(len(step)) - np.outer(step, change) / (step @ change)
            inverse = turn @ inverse @ turn.T + np.outer(step, step) / (step @ change)
        weights, loss, slope, size = trial, new_loss, new_slope, 1.0
    return weights


def learn(sums: np.ndarray, graded_by: Callable[[Model], np.ndarray],
          cut_at: Callable[[Model, int], float]) -> Model:
    """Fit from the rows' :func:`moments` and what two functions count over the same rows.
    One class alone gives a model that accepts all."""
    k, n = len(FEATURES), sums[:, 0]
    rows = max(n.sum(), 1.0)
    mean = sums[:, 1:k + 1].sum(axis=0) / rows
    squares = sums[:, k + 1:].reshape(3, k, k)
    scale = np.sqrt(np.maximum(np.diagonal(squares.sum(axis=0)) / rows - mean ** 2, 0.0)) if n.sum() else np.ones(k)
    mean, scale = np.round(mean, 9), np.round(scale, 9) + 1e-6
    model = Model(mean, scale, np.zeros(k), 0.0)
    if not n[0] or not n[1]:
        return model
    centre = sums[:2, 1:k + 1] / n[:2, None]
    spread = sum(squares[c] / n[c] - np.outer(centre[c], centre[c]) for c in (0, 1))
    spread = (spread + np.outer(centre[1] - centre[0], centre[1] - centre[0])) / np.outer(scale, scale)

    def loss_at(weights: np.ndarray) -> tuple[float, np.ndarray]:
        return pair_loss(graded_by(Model(mean, scale, weights, 0.0)), weights)

    model.weights = climb(loss_at, spread / 4 + RIDGE * np.eye(k))
    model.cut = cut_at(model, int(min(max(n[0], 1), n.sum() - 1)))
    return model


def bradley_terry(x: np.ndarray, good: np.ndarray) -> Model:
    """Fit from features and labels (1: good) in memory; :func:`fit` does the same over a table."""
    return learn(moments([(x, good)]), lambda model: graded([(x, good)], model),
                 lambda model, bad: quantile_cut(model.raw(x), bad / len(x)))


def quantile_cut(raw: np.ndarray, share: float) -> float:
    """Score between the ``share`` quantile's two neighbours."""
    ordered = np.sort(raw)
    k = min(max(int(round(share * len(raw))), 1), len(raw) - 1) if len(raw) > 1 else 0
    return (ordered[k - 1] + ordered[k]) / 2 if k else ordered[0]


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, last, data, offsets in blocks(batch.column("text")):
            x = features(data, offsets)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(first, last - first),
                 pa.ListArray.from_arrays(
                     pa.array(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32)), pa.array(x.ravel()))],
                names=["doc_id", "x"])


def training_features(docs: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """(label, x) of every labelled row outside the held-out fifth.  Null labels and ids are left out.

    Texts stay where they are: their features (18 numbers) are joined with the labels.
    """
    known = (pick(labels, doc_id="doc_id", label=label)
             .filter(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & ~held_out(F.col("doc_id")))
             .groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.max("label").cast("int").alias("label")))
    texts = pick(docs, doc_id="doc_id", text="text").filter(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    return (texts.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
            .mapInArrow(_describe, "doc_id bigint, x array<double>")
            .join(known.hint("merge"), "doc_id").select("label", "x"))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    for batch in batches:
        x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(FEATURES))
        yield x, batch.column("label").to_numpy(zero_copy_only=False)


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    flat = moments(_rows(batches)).ravel()
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat), dtype=np.int32)), pa.array(flat)], names=["at", "v0"])


def _graded(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    total = graded(_rows(batches), model)
    flat = total.reshape(-1, total.shape[2])
    at = np.flatnonzero(flat[:, 0])
    yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), *(pa.array(v) for v in flat[at].T.copy())],
                                     names=["at", *(f"v{i}" for i in range(flat.shape[1]))])


def _summed(parts: DataFrame, shape: tuple[int, ...]) -> np.ndarray:
    """Tasks' partial sums (``at``, ``v0`` ..) added up by Spark and laid out as ``shape``."""
    values = parts.columns[1:]
    got = parts.groupBy("at").agg(*[F.sum(v).alias(v) for v in values]).toArrow()
    total = np.zeros((int(np.prod(shape)) // len(values), len(values)))
    total[got.column("at").to_numpy()] = np.column_stack([got.column(v).to_numpy() for v in values])
    return total.reshape(shape)


def _raw(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for x, _ in _rows(batches):
        yield pa.RecordBatch.from_arrays([pa.array(model.raw(x))], names=["raw"])


def cut_of(scores: DataFrame, rank: int) -> float:
    """Middle of the scores (``raw``) at ``rank`` and the one after, of all rows: they are counted in
    ``CUT_BINS`` ranges, then within the range that holds both, until they are parted or equal."""
    low, high = scores.agg(F.min("raw"), F.max("raw")).first()
    while low < high:
        place = F.floor((F.col("raw") - low) / ((high - low) / CUT_BINS)).alias("place")
        ranges = iter(scores.filter(F.col("raw").between(low, high)).groupBy(place)
                      .agg(F.count("*"), F.min("raw"), F.max("raw")).orderBy("place").collect())
        for _, count, low, high in ranges:  # at most CUT_BINS + 1
            if rank <= count:
                break
            rank -= count
        if rank == count:
            after = next(ranges, None)
            return (high + after[2]) / 2 if after else high
    return low


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality") -> Model:
    """The model of all labelled rows outside the held-out fifth; the driver sees sums only."""
    rows = written(docs.sparkSession, training_features(docs, labels, label), "quality-rows")
    k = len(FEATURES)

    def graded_by(model: Model) -> np.ndarray:
        names = ", ".join(f"v{i} double" for i in range(k + 1))
        return _summed(rows.mapInArrow(partial(_graded, model=model), f"at int, {names}"),
                       (2, 2 * _reach(model.weights) + 1, k + 1))

    def cut_at(model: Model, rank: int) -> float:
        scores = written(docs.sparkSession, rows.mapInArrow(partial(_raw, model=model), "raw double"), "quality-scores")
        return cut_of(scores, rank)

    sums = _summed(rows.mapInArrow(_moments, "at int, v0 double"), (3, 1 + k + k * k))
    return learn(sums, graded_by, cut_at)


def _score(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, last, data, offsets in blocks(batch.column("text")):
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(first, last - first),
                 pa.array(model.score(features(data, offsets)))], names=["doc_id", "score"])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every row.  A null or empty text has all features zero."""
    ids = pick(docs, doc_id="doc_id", text="text").select(F.col("doc_id").cast("bigint"), "text")
    return ids.mapInArrow(partial(_score, model=model), "doc_id bigint, score double")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: quality of every document, fitted on ``labels.quality``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= CUT).cast("int").alias("predicted"))


def _keep(batches: Iterator[pa.RecordBatch], model: Model, text: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        table = pa.Table.from_batches([batch])
        keep = np.ones(batch.num_rows, dtype=bool)
        for first, last, data, offsets in blocks(batch.column(text)):
            keep[first:last] = model.score(features(data, offsets)) >= CUT
        yield from table.filter(pa.array(keep)).to_batches()


def keep_good(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pipeline stage: documents below the cut go; the columns stay as they are."""
    names = docs.columns
    tagged = tag(docs)
    text = f"c{position(names, 'text')}"
    return tagged.mapInArrow(partial(_keep, model=fit(docs, labels), text=text),
                             tagged.schema).toDF(*names)



