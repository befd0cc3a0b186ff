"""Toxic spans by a linear-chain conditional random field.

Token labels come from document labels: a word of a toxic training document
is labelled toxic when it, or how it begins, occurs in significantly more
toxic than clean training documents; every token of a clean document is
labelled clean. The field has two tags, emission weights for the hashed word,
its beginnings, its neighbours and its shape, and tag transitions, fitted by the gradient of the chain's
log-likelihood. Forward-backward marginals of every token then give the
offending offsets and, through three aggregates and a logistic link fitted on
the same rows, the document's score.
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
from tillroll.llm.quality import labelled_sample
from tillroll.llm.textarrays import Words, chunks, mix, span_hashes
from tillroll.llm.workers import tidied

#: Most labelled rows that are fetched to fit the model: those with the smallest hash of their id.
TRAIN_ROWS = 3_000
#: Labelled rows with longer texts (in bytes) are left out of the sample, which bounds what the driver holds.
TRAIN_BYTES = 1 << 16
BUCKETS = 1 << 18
SHAPES = 4
#: Lengths in bytes of the beginnings that stand beside a whole word.
BEGINNINGS = (4, 5, 6)
#: Least documents and z-score for a word or beginning to be a toxic token label.
LEAST_DOCS, LEAST_Z = 5, 6.0
#: Minimum hashes of five-word shingles by which copies among the training rows are told: two that an earlier row has.
SKETCH = 4

_ENDS = np.zeros(256, bool)
_ENDS[[ord(c) for c in ".!?"]] = True


class Tokens:
    """Words of a chunk without the marks around them, cut into sequences at sentence and line ends."""

    def __init__(self, buf: np.ndarray, offsets: np.ndarray):
        words = Words(buf, offsets)
        low = words.buf
        n = len(words.start)
        self.doc, self.first = words.doc, words.first
        stop = np.zeros(n, bool)
        if n:
            stop = _ENDS[low[words.end - 1]]
            line = np.append(0, np.cumsum(buf == 0x0A))
            stop[:-1] |= line[words.start[1:]] > line[words.end[:-1]]
            stop[:-1] |= words.doc[1:] != words.doc[:-1]
            stop[-1] = True
        start, end = words.core()
        self.start, self.end = start, end
        units = [span_hashes(low, start, end) if n else np.zeros(0, np.uint64)]
        for k in BEGINNINGS if n else ():  # shorter words have none: their unit is 0
            units.append(np.where(end - start > k, mix(span_hashes(low, start, np.minimum(start + k, end)) + np.uint64(k)), 0))
        self.units = np.stack(units) if n else np.zeros((1 + len(BEGINNINGS), 0), np.uint64)
        self.buckets = (self.units >> np.uint64(46)).astype(np.int32)
        self.bucket = self.buckets[0]
        upper = np.append(0, np.cumsum((buf >= 0x41) & (buf <= 0x5A)))
        size = end - start
        shouted = (upper[end] - upper[start] == size) & (size > 1)
        self.shape = shouted * 2 + (size <= 3)
        edge = np.flatnonzero(stop) + 1
        self.length = np.diff(np.append(0, edge))  # of each sequence
        self.begin = edge - self.length


@dataclass
class Chain:
    """Weights: ``unit`` (words and beginnings), ``before`` and ``after`` by bucket, ``shape``, ``move[a, b]`` from tag a to tag b (in logs, tag 0 clean)."""

    unit: np.ndarray
    before: np.ndarray
    after: np.ndarray
    shape: np.ndarray
    move: np.ndarray
    link: np.ndarray

    def emissions(self, t: Tokens) -> np.ndarray:
        """Log odds of tag 1 against tag 0 of every token by itself."""
        e = self.shape[t.shape]
        for b in t.buckets:
            e = e + self.unit[b]
        inner = np.ones(len(e), bool)
        inner[t.begin] = False
        at = np.flatnonzero(inner)
        e[at] += self.before[t.bucket[at - 1]]
        e[at - 1] += self.after[t.bucket[at]]
        return np.clip(e, -25, 25)

    def marginals(self, t: Tokens) -> np.ndarray:
        """P(tag 1) of every token by forward and backward ratios of the two tags, all sequences side by side."""
        return _both_ways(self.emissions(t), self.move, t.begin, t.length)[0]

    def document_values(self, t: Tokens, p: np.ndarray, docs: int) -> np.ndarray:
        """Aggregates of the marginals: largest, log of one plus the expected toxic tokens, noisy-or."""
        top = np.zeros(docs)
        np.maximum.at(top, t.doc, p)
        clear = np.bincount(t.doc, np.log1p(-np.minimum(p, 1 - 1e-9)), docs)
        return np.stack([top, np.log1p(np.bincount(t.doc, p, docs)), 1 - np.exp(clear)], axis=1)

    def score(self, t: Tokens, docs: int) -> tuple[np.ndarray, np.ndarray]:
        p = self.marginals(t)
        z = self.link[0] + self.document_values(t, p, docs) @ self.link[1:]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30))), p


def _both_ways(e: np.ndarray, move: np.ndarray, begin: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(P(tag 1) of each token, expected moves [a, b]) for emission log odds ``e``.

    ``r`` is the ratio of the two forward sums after each token, ``s`` that of
    the backward sums; both follow from the neighbour by one fraction, so the
    chains of a chunk advance together, longest first.
    """
    m = np.exp(move)
    odds = np.exp(e)
    order = np.argsort(-length, kind="stable")
    begin, length = begin[order], length[order]
    steps = int(length[0]) if len(length) else 0
    active = np.searchsorted(-length, -np.arange(steps), side="left")  # chains longer than each step
    r, s = np.zeros(len(e)), np.ones(len(e))
    for k in range(steps):
        at = begin[:active[k]] + k
        if k:
            q = r[at - 1]
            r[at] = odds[at] * (m[0, 1] + m[1, 1] * q) / (m[0, 0] + m[1, 0] * q)
        else:
            r[at] = odds[at]
    last = begin + length - 1
    for k in range(1, steps):
        at = last[:active[k]] - k
        q = odds[at + 1] * s[at + 1]
        s[at] = (m[1, 0] + m[1, 1] * q) / (m[0, 0] + m[0, 1] * q)
    p = r * s / (1 + r * s)
    inner = np.ones(len(e), bool)
    inner[begin] = False
    at = np.flatnonzero(inner)
    q, w = r[at - 1], odds[at] * s[at]
    pair = np.stack([np.full(len(at), m[0, 0]), m[0, 1] * w, m[1, 0] * q, m[1, 1] * q * w])
    pair /= pair.sum(0)
    return p, pair.sum(1).reshape(2, 2)


def toxic_units(t: Tokens, y: np.ndarray) -> np.ndarray:
    """Words and beginnings that occur in significantly more toxic than clean documents (two-proportion z-score)."""
    found = []
    bad, n = y.sum(), len(y)
    for unit in t.units:
        order = np.lexsort((t.doc, unit))
        u, d = unit[order], t.doc[order]
        new = np.append(True, (u[1:] != u[:-1]) | (d[1:] != d[:-1])) & (u != 0)
        word, number = np.unique(u[new], return_inverse=True)
        toxic = np.bincount(number, y[d[new]], len(word))
        every = np.bincount(number, minlength=len(word)).astype(float)
        share = every / n
        gap = toxic / max(bad, 1) - (every - toxic) / max(n - bad, 1)
        z = gap / np.sqrt(np.maximum(share * (1 - share), 1e-12) * (1 / max(bad, 1) + 1 / max(n - bad, 1)))
        found.append(word[(toxic >= LEAST_DOCS) & (z >= LEAST_Z)])
    return np.concatenate(found)


def first_of_copies(buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rows of whose ``SKETCH`` minimum shingle hashes fewer than two occur in earlier rows, so that copies weigh once."""
    doc, shingle = Words(buf, offsets).shingles(5)
    seen = np.zeros(len(offsets) - 1, np.int64)
    for k in range(SKETCH):
        low = np.full(len(seen), np.iinfo(np.uint64).max, np.uint64)
        np.minimum.at(low, doc, mix(shingle + np.uint64(k * 7919 + 1)))
        first = np.zeros(len(seen), bool)
        first[np.unique(low, return_index=True)[1]] = True
        seen += ~first & (low != np.iinfo(np.uint64).max)
    return seen < 2


def train_chain(t: Tokens, y: np.ndarray, epochs: int = 20, rate: float = 0.3, decay: float = 1e-3) -> Chain:
    """Fit the chain on labelled tokens, then the document link on its marginals (full-batch Adam, deterministic)."""
    chain = Chain(np.zeros(BUCKETS), np.zeros(BUCKETS), np.zeros(BUCKETS), np.zeros(SHAPES), np.zeros((2, 2)), np.zeros(4))
    if not len(y) or y.min() == y.max():
        share = float(np.clip(y.mean(), 0.01, 0.99)) if len(y) else 0.5
        chain.link[0] = np.log(share / (1 - share))
        return chain
    bad = toxic_units(t, y)
    tag = np.zeros(len(t.doc), bool)
    for unit in t.units:
        tag |= np.isin(unit, bad)
    tag &= y[t.doc] == 1
    t.units = t.units[:, :0]  # the fit needs the buckets only
    inner = np.ones(len(tag), bool)
    inner[t.begin] = False
    at = np.flatnonzero(inner)
    truth = np.bincount(tag[at - 1] * 2 + tag[at], minlength=4).reshape(2, 2)
    params = [chain.unit, chain.before, chain.after, chain.shape, chain.move]
    state = [[np.zeros_like(p), np.zeros_like(p)] for p in params]
    scale = max(1.0, float(tag.sum()))
    chain.shape -= 4.0
    for step in range(1, epochs + 1):
        p, moves = _both_ways(chain.emissions(t), chain.move, t.begin, t.length)
        gap = p - tag
        grads = [sum(np.bincount(b, gap, BUCKETS) for b in t.buckets), np.bincount(t.bucket[at - 1], gap[at], BUCKETS),
                 np.bincount(t.bucket[at], gap[at - 1], BUCKETS), np.bincount(t.shape, gap, SHAPES), moves - truth]
        for q, g, (a, b) in zip(params, grads, state, strict=True):
            g = g / scale + decay * q * (q is not chain.shape)
            a += 0.1 * (g - a)
            b += 0.01 * (g * g - b)
            q -= rate * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.99 ** step)) + 1e-6)
    x = chain.document_values(t, chain.marginals(t), len(y))
    x = np.concatenate([np.ones((len(y), 1)), x], axis=1)
    for _ in range(30):  # Newton steps of a ridge-penalised logistic link
        q = 1 / (1 + np.exp(-np.clip(x @ chain.link, -30, 30)))
        ridge = np.diag([1e-6, 1e-2, 1e-2, 1e-2])
        chain.link -= np.linalg.solve((x * (q * (1 - q))[:, None]).T @ x + ridge, x.T @ (q - y) + ridge @ chain.link)
    return chain


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", among: Column | None = None, key: str = "doc_id",
        text: str = "text", rows: int = TRAIN_ROWS) -> Chain:
    """Fit on at most ``rows`` labelled rows whose whole texts have at most ``TRAIN_BYTES`` (the product bounds what the driver holds).

    Without labelled rows, or with one label only, every text gets the share of label 1 (0.5 without any).
    """
    sample = labelled_sample(docs, labels, label, F.lit(True) if among is None else among, key, text, rows, most_bytes=TRAIN_BYTES)
    whole = F.coalesce("__text", F.lit(""))
    got = (sample.select(F.col("__key").cast("string").alias("key"), F.col("__label").alias("label"), whole.alias("text"))
           .toArrow().to_pydict())
    order = sorted(range(len(got["key"])), key=lambda i: (got["key"][i], got["label"][i], got["text"][i]))
    raw = [got["text"][i].encode() for i in order]
    y = np.array([got["label"][i] != 0 for i in order], float)
    return train(raw, y)


def flat(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(raw), np.uint8), np.append(0, np.cumsum([len(r) for r in raw])).astype(np.int64)


def train(raw: list[bytes], y: np.ndarray) -> Chain:
    """Chain of labelled UTF-8 texts; copies among them weigh once."""
    first = np.flatnonzero(first_of_copies(*flat(raw))) if raw else np.zeros(0, np.int64)
    return train_chain(Tokens(*flat([raw[i] for i in first])), y[first])


def score(df: DataFrame, chain: Chain, text: str = "text", out: str = "score", spans: str | None = None,
          least: float = 0.5) -> DataFrame:
    """``df`` with the probability that a text is toxic (column ``out``) and, if
    ``spans`` is given, an array of (start, end, probability) of its offending
    tokens: byte offsets into the UTF-8 text where P(toxic) >= ``least``.

    Null and empty texts have no tokens: they get the link's base score and no
    spans. Columns of the same names are replaced, all others kept. Narrow.
    """
    kept = [c for c in df.columns if c not in (out, spans)]
    item = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()),
                         T.StructField("probability", T.DoubleType())])
    schema = T.StructType([*(df.schema[c] for c in kept), T.StructField(out, T.DoubleType()),
                           *([T.StructField(spans, T.ArrayType(item))] if spans else [])])
    shared = df.sparkSession.sparkContext.broadcast(chain)  # about 6 MB, fixed by BUCKETS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            scores, found = [np.zeros(0)], []
            for first, end, buf, offsets in chunks(b.column(len(kept))):
                t = Tokens(buf, offsets)
                z, p = shared.value.score(t, end - first)
                scores.append(z)
                if spans:
                    for d in range(end - first):
                        at = t.first[d] + np.flatnonzero(p[t.first[d]:t.first[d + 1]] >= least)
                        found.append([{"start": int(t.start[i] - offsets[d]), "end": int(t.end[i] - offsets[d]),
                                       "probability": float(p[i])} for i in at])
            arrays = [*(b.column(i) for i in range(len(kept))), pa.array(np.concatenate(scores))]
            names = [*kept, out]
            if spans:
                arrays.append(pa.array(found, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()),
                                                                  ("probability", pa.float64())]))))
                names.append(spans)
            yield pa.RecordBatch.from_arrays(arrays, names)

    return df.select(*(df[c] for c in kept), df[text].alias(free(df, "__text")[0])).mapInArrow(tidied(run), schema)
