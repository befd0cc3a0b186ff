"""Document quality by a factorisation machine.

Features of a text: its hashed words (square-rooted counts, scaled to length 1), its
structure statistics and numeric metadata (both one-hot over quantile bins).
The model adds to the linear part low-rank interactions of every feature
pair, scored in linear time by the sum-of-squares identity

    sum_{i<j} <v_i, v_j> x_i x_j = (|sum_i v_i x_i|^2 - sum_i |v_i|^2 x_i^2) / 2.

It is fitted on a bounded sample of labelled rows (``TRAIN_ROWS``); scoring is
one narrow pass over all rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.storage import free
from tillroll.llm.textarrays import Words, chunks
from tillroll.llm.workers import tidied

#: Most labelled rows that are fetched to fit the model: those with the smallest hash of their id.
TRAIN_ROWS = 8_000
BUCKETS = 1 << 13
FACTORS = 6
BINS = 12
STATS = ("words", "bytes_a_word", "upper", "digits", "symbols", "stops", "lines", "distinct", "stutter", "short")

_UPPER = np.zeros(256, np.int64)
_UPPER[0x41:0x5B] = 1
_DIGIT = np.zeros(256, np.int64)
_DIGIT[0x30:0x3A] = 1
_SYMBOL = np.zeros(256, np.int64)
_SYMBOL[[ord(c) for c in "#$%&*+/<=>@\\^_`{|}~"]] = 1
_STOP = np.zeros(256, np.int64)
_STOP[[ord(c) for c in "!?.,;:"]] = 1


def remainder(key: str, of: int) -> Column:
    """crc32 of a key as text, modulo ``of``: the fixed split of labelled rows."""
    return F.crc32(F.col(key).cast("string")) % of


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, train: Column, key: str = "doc_id",
                    text: str = "text", rows: int = TRAIN_ROWS, extra: tuple[str, ...] = (), most_bytes: int | None = None) -> DataFrame:
    """``key``, ``text`` and ``label`` of at most ``rows`` labelled rows for which ``train`` holds (those with the smallest key hash).

    Only the chosen ids and labels (``rows`` pairs at most) are broadcast. Of
    rows that share a key, the one with the smallest text hash is taken, on the
    executors. Null keys, null labels and texts of more than ``most_bytes``
    take no part.
    """
    chosen = (labels.filter(F.col(key).isNotNull() & F.col(label).isNotNull() & train)
              .select(F.col(key).alias("__key"), F.col(label).cast("int").alias("__label"))
              .orderBy(F.xxhash64("__key"), "__key", "__label").limit(rows))
    fit = docs if most_bytes is None else docs.filter(F.octet_length(F.coalesce(docs[text], F.lit(""))) <= most_bytes)
    found = (fit.join(F.broadcast(chosen), docs[key] == chosen["__key"])
             .select(docs[key].alias("__key"), docs[text].alias("__text"), "__label", *(docs[c].alias(f"__{i}") for i, c in enumerate(extra))))
    rest = [f"__{i}" for i in range(len(extra))]
    return (found.groupBy("__key", "__label").agg(F.min(F.struct(F.xxhash64("__text").alias("__hash"), "__text", *rest)).alias("__one"))
            .select("__key", "__one.__text", "__label", *(F.col(f"__one.{x}").alias(c) for x, c in zip(rest, extra, strict=True))))


def statistics(words: Words, raw: np.ndarray, offsets: np.ndarray, h: np.ndarray, distinct: np.ndarray) -> np.ndarray:
    """Structure statistics of each row, one column per entry of ``STATS``."""
    def per_row(table: np.ndarray) -> np.ndarray:
        total = np.append(0, np.cumsum(table[raw]))
        return (total[offsets[1:]] - total[offsets[:-1]]).astype(float)

    n = words.count.astype(float)
    one = np.maximum(n, 1)
    size = words.end - words.start
    solid = np.bincount(words.doc, size, len(n))
    full = np.maximum(solid, 1)
    line = np.zeros(256, np.int64)
    line[0x0A] = 1
    again = (h[1:] == h[:-1]) & (words.doc[1:] == words.doc[:-1])
    return np.stack([
        np.log1p(n), solid / one, per_row(_UPPER) / full, per_row(_DIGIT) / full, per_row(_SYMBOL) / full,
        per_row(_STOP) / full, per_row(line) / one, distinct / one,
        np.bincount(words.doc[1:], again, len(n)) / one, np.bincount(words.doc, size <= 2, len(n)) / one], axis=1)


@dataclass
class Features:
    """Sparse features of the rows of a chunk and their numbers (statistics, metadata) before binning."""

    row: np.ndarray
    index: np.ndarray
    value: np.ndarray
    numbers: np.ndarray


def features(buf: np.ndarray, offsets: np.ndarray, metadata: np.ndarray) -> Features:
    words = Words(buf, offsets)
    h = words.hashes()
    n = len(offsets) - 1
    key, count = np.unique(words.doc * BUCKETS + (h >> np.uint64(51)).astype(np.int64), return_counts=True)
    row, index = key // BUCKETS, key % BUCKETS
    value = np.sqrt(count)
    norm = np.sqrt(np.bincount(row, value * value, n))
    distinct = np.bincount(row, minlength=n).astype(float)
    numbers = np.concatenate([statistics(words, buf, offsets, h, distinct), metadata], axis=1)
    return Features(row, index, value / np.maximum(norm[row], 1e-12), numbers)


@dataclass
class Model:
    bias: float
    weight: np.ndarray
    factor: np.ndarray
    edges: np.ndarray  # quantile edges of each number

    def with_bins(self, f: Features) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, feature, value): words, then one bin of each number."""
        n, m = f.numbers.shape
        bins = np.stack([np.searchsorted(self.edges[j], f.numbers[:, j], side="right") for j in range(m)], axis=1)
        index = (BUCKETS + np.arange(m) * BINS + bins).ravel()
        return (np.concatenate([f.row, np.repeat(np.arange(n), m)]), np.concatenate([f.index, index]),
                np.concatenate([f.value, np.full(n * m, 1 / np.sqrt(m))]))

    def score(self, f: Features) -> np.ndarray:
        row, index, x = self.with_bins(f)
        n = len(f.numbers)
        z = self.bias + np.bincount(row, self.weight[index] * x, n)
        for k in range(self.factor.shape[1]):
            v = self.factor[index, k] * x
            z += 0.5 * (np.bincount(row, v, n) ** 2 - np.bincount(row, v * v, n))
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _metadata(batch: pa.RecordBatch, first: int, count: int) -> np.ndarray:
    """Numeric metadata columns as log1p of their size; -1 where null or not a number."""
    out = np.full((batch.num_rows, count), -1.0)
    for j in range(count):
        v = np.asarray(batch.column(first + j).cast(pa.float64()).to_numpy(zero_copy_only=False), float)
        out[:, j] = np.where(np.isfinite(v), np.log1p(np.abs(v)), -1.0)
    return out


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", train: Column | None = None, key: str = "doc_id",
        text: str = "text", metadata: tuple[str, ...] = ("n_chars",), rows: int = TRAIN_ROWS, epochs: int = 12,
        seed: int = 7) -> Model:
    """Fit the machine on at most ``rows`` labelled rows.

    Executors turn the sampled texts into features; the driver gets at most
    ``rows`` x ``BUCKETS`` numbers. Without any labelled row the model scores
    every text 0.5. Labels other than 0 count as 1; the fit does not depend on
    the order of the rows.
    """
    train = F.lit(True) if train is None else train
    sample = labelled_sample(docs, labels, label, train, key, text, rows, metadata)
    schema = T.StructType([T.StructField("key", T.StringType()), T.StructField("label", T.IntegerType()),
                           T.StructField("index", T.BinaryType()), T.StructField("value", T.BinaryType()),
                           T.StructField("numbers", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            meta = _metadata(b, 3, len(metadata))
            out: list[list] = [[], [], []]
            for first, end, buf, offsets in chunks(b.column(1)):
                f = features(buf, offsets, meta[first:end])
                edge = np.searchsorted(f.row, np.arange(end - first + 1))
                for d in range(end - first):
                    out[0].append(f.index[edge[d]:edge[d + 1]].astype("<u2").tobytes())
                    out[1].append(f.value[edge[d]:edge[d + 1]].astype("<f4").tobytes())
                    out[2].append(f.numbers[d].astype("<f8").tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.string()), b.column(2).cast(pa.int32()),
                                              *(pa.array(x, pa.binary()) for x in out)],
                                             [x.name for x in schema])

    got = sample.mapInArrow(tidied(run), schema).toArrow().to_pydict()
    order = sorted(range(len(got["key"])), key=lambda i: (got["key"][i], got["label"][i], got["index"][i], got["value"][i]))
    index = [np.frombuffer(got["index"][i], "<u2").astype(np.int64) for i in order]
    value = [np.frombuffer(got["value"][i], "<f4").astype(float) for i in order]
    numbers = np.array([np.frombuffer(got["numbers"][i], "<f8") for i in order]).reshape(len(order), len(STATS) + len(metadata))
    y = np.array([got["label"][i] != 0 for i in order], float)
    return train_machine(index, value, numbers, y, len(STATS) + len(metadata), epochs, seed)


def train_machine(index: list[np.ndarray], value: list[np.ndarray], numbers: np.ndarray, y: np.ndarray, m: int,
                  epochs: int, seed: int, batch: int = 128, rate: float = 0.03, decay: float = 1e-4) -> Model:
    """Adam on the logistic loss; the last factors are averaged over the second half of the steps."""
    size = BUCKETS + m * BINS
    rng = np.random.default_rng(seed)
    if not len(y):
        return Model(0.0, np.zeros(size), np.zeros((size, FACTORS)), np.zeros((m, BINS - 1)))
    edges = np.stack([np.quantile(numbers[:, j], np.linspace(0, 1, BINS + 1)[1:-1]) for j in range(m)])
    model = Model(0.0, np.zeros(size), rng.normal(0, 0.05, (size, FACTORS)), edges)
    row, idx, x = model.with_bins(Features(np.repeat(np.arange(len(y)), [len(i) for i in index]), np.concatenate(index),
                                           np.concatenate(value), numbers))
    order = np.argsort(row, kind="stable")
    idx, x = idx[order], x[order]
    edge = np.searchsorted(row[order], np.arange(len(y) + 1))
    theta = np.concatenate([model.weight[:, None], model.factor], axis=1)
    rate_share = np.clip(y.mean(), 0.01, 0.99)
    bias = float(np.log(rate_share / (1 - rate_share)))
    first, second, mean, kept = np.zeros_like(theta), np.zeros_like(theta), np.zeros_like(theta), 0
    b1 = b2 = bias_mean = 0.0
    step, steps = 0, epochs * -(-len(y) // batch)
    for _ in range(epochs):
        shuffled = rng.permutation(len(y))
        for at in range(0, len(y), batch):
            mine = shuffled[at:at + batch]
            n = len(mine)
            length = edge[mine + 1] - edge[mine]
            pick = np.repeat(edge[mine] - np.cumsum(length) + length, length) + np.arange(length.sum())
            r, i, v = np.repeat(np.arange(n), length), idx[pick], x[pick]
            w, f = theta[i, 0], theta[i, 1:]
            vx = f * v[:, None]
            total = np.stack([np.bincount(r, vx[:, k], n) for k in range(FACTORS)], axis=1)
            z = bias + np.bincount(r, w * v, n) + 0.5 * ((total ** 2).sum(1) - np.bincount(r, (vx * vx).sum(1), n))
            g = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[mine]) / n
            gv = g[r] * v
            parts = np.concatenate([gv[:, None], gv[:, None] * (total[r] - vx)], axis=1)
            grad = np.stack([np.bincount(i, parts[:, k], size) for k in range(FACTORS + 1)], axis=1) + decay * theta
            step += 1
            first = 0.9 * first + 0.1 * grad
            second = 0.999 * second + 0.001 * grad * grad
            theta = theta - rate * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-8)
            b1, b2 = 0.9 * b1 + 0.1 * g.sum(), 0.999 * b2 + 0.001 * g.sum() ** 2
            bias -= rate * (b1 / (1 - 0.9 ** step)) / (np.sqrt(b2 / (1 - 0.999 ** step)) + 1e-8)
            if 2 * step > steps:
                mean, bias_mean, kept = mean + theta, bias_mean + bias, kept + 1
    theta, bias = mean / kept, bias_mean / kept
    return Model(bias, theta[:, 0], theta[:, 1:], edges)


def score(df: DataFrame, model: Model, text: str = "text", metadata: tuple[str, ...] = ("n_chars",),
          out: str = "score") -> DataFrame:
    """``df`` with the probability of label 1 in column ``out`` (replaced if it exists).

    Null and empty texts are scored from their (empty) structure; null
    metadata falls into its own bin. All other columns are kept as they are.
    """
    kept = [c for c in df.columns if c != out]
    schema = T.StructType([*(df.schema[c] for c in kept), T.StructField(out, T.DoubleType())])
    shared = df.sparkSession.sparkContext.broadcast(model)  # a few hundred kB, fixed by BUCKETS and FACTORS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            meta = _metadata(b, len(kept) + 1, len(metadata))
            parts = [shared.value.score(features(buf, offsets, meta[first:end]))
                     for first, end, buf, offsets in chunks(b.column(len(kept)))]
            z = np.concatenate(parts) if parts else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(len(kept))), pa.array(z)], [*kept, out])

    body, *more = free(df, "__text", *(f"__meta{j}" for j in range(len(metadata))))
    return (df.select(*(df[c] for c in kept), df[text].alias(body), *(df[c].cast("double").alias(m) for m, c in zip(more, metadata, strict=True)))
            .mapInArrow(tidied(run), schema))


def keep_good(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """The rows that score at least ``least``, with the columns they came with."""
    names = docs.columns
    quality, = free(docs, "__quality")
    scored = score(docs, model, out=quality)
    return scored.filter(F.col(quality) >= least).select(*(F.col(f"`{c}`") for c in names))
