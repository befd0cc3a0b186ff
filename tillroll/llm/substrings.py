"""Substring deduplication by sliding sentence spans.

Every run of several consecutive sentences is hashed: from each sentence the
shortest run forwards, and the shortest backwards, of at least ``RUN_SENTENCES``
sentences and ``RUN_WORDS`` words (a sentence of ``LONG_SENTENCE`` words is a
run by itself). Equal runs meet by hash over all documents; the occurrence
with the smallest (document, position) stays and the sentences that any other
occurrence covers are removed.

A run that a third of all documents share does not gather in one task: within
an Arrow batch all but the first occurrence are decided on the spot and are
dealt out at random, so that at most one row of a run and batch goes to the
task of its hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.textarrays import Words, chunks, expand, mix
from tillroll.llm.storage import free
from tillroll.llm.workers import tidied

RUN_SENTENCES, RUN_WORDS, LONG_SENTENCE = 2, 20, 50
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_ENDS = np.zeros(256, bool)
_ENDS[[ord(c) for c in ".!?"]] = True
_NULL = np.iinfo(np.int64).min  # stands for a null key: it comes first

_OCCURRENCE = pa.schema([("deal", pa.int64()), ("run", pa.int64()), ("key", pa.int64()), ("mark", pa.int64()),
                         ("at", pa.int32()), ("words", pa.int32()), ("earlier", pa.int64()), ("repeat", pa.bool_())])
_OCCURRENCE_SQL = "deal bigint, run bigint, key bigint, mark bigint, at int, words int, earlier bigint, repeat boolean"


def _powers(base: int, n: int) -> np.ndarray:
    steps = np.full(n, base, np.uint64)
    steps[:1] = 1
    return np.cumprod(steps, dtype=np.uint64)


def sentence_runs(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, end word, hash) of every run of a chunk; words are compared
    without regard to case and white space."""
    n = len(words.start)
    none = np.zeros(0, np.int64)
    if not n:
        return none, none, np.zeros(0, np.uint64)
    stop = _ENDS[words.buf[words.end - 1]]
    line = np.append(0, np.cumsum(words.buf == 0x0A))
    stop[:-1] |= (line[words.start[1:]] > line[words.end[:-1]]) | (words.doc[1:] != words.doc[:-1])
    stop[-1] = True
    end = np.flatnonzero(stop) + 1  # of each sentence, in words
    start = np.append(0, end[:-1])
    doc = words.doc[start]
    m = len(start)
    number = np.arange(m)
    forward = np.maximum(number + RUN_SENTENCES - 1, np.searchsorted(end, start + RUN_WORDS))
    fits = forward < m
    fits[fits] = doc[forward[fits]] == doc[fits]
    backward = np.minimum(number - RUN_SENTENCES + 1, np.searchsorted(start, end - RUN_WORDS, side="right") - 1)
    back = backward >= 0
    back[back] = doc[backward[back]] == doc[back]
    long = end - start >= LONG_SENTENCE
    a = np.concatenate([start[fits], start[backward[back]], start[long]])
    z = np.concatenate([end[forward[fits]], end[back], end[long]])
    pair = np.unique(a * (n + 1) + z)
    a, z = pair // (n + 1), pair % (n + 1)
    total = np.append(np.uint64(0), np.cumsum(words.hashes() * _powers(_BASE, n), dtype=np.uint64))
    h = (total[z] - total[a]) * _powers(_INVERSE, n)[a]
    return a, z, mix(h + (z - a).astype(np.uint64))


def row_mark(text: Column) -> Column:
    """Tells rows of equal keys apart by their texts; rows equal in both are one document."""
    return F.xxhash64(text)


def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of every batch of (key, mark, text), decided within the batch where possible."""
    for b in batches:
        keys = b.column(0).fill_null(int(_NULL)).to_numpy(zero_copy_only=False)
        marks = b.column(1).to_numpy(zero_copy_only=False)
        key, mark, at, size, run = [], [], [], [], []
        for first, _, buf, offsets in chunks(b.column(2)):
            words = Words(buf, offsets)
            a, z, h = sentence_runs(words)
            doc = words.doc[a] if len(a) else a
            key.append(keys[first + doc])
            mark.append(marks[first + doc])
            at.append(a - words.first[doc])
            size.append(z - a)
            run.append(h)
        if not run:
            continue
        key, mark, at, size, run = map(np.concatenate, (key, mark, at, size, run))
        order, new, head = _grouped(run, key, mark, at)
        repeat = np.zeros(len(run), bool)
        repeat[order] = ~new
        earlier = np.zeros(len(run), np.int64)
        earlier[order] = key[order][head]
        spread = mix((key + at).astype(np.uint64)).view(np.int64)
        yield _rows(np.where(repeat, spread, run.view(np.int64)), run.view(np.int64), key, mark, at, size, earlier, repeat)


def _grouped(run: np.ndarray, key: np.ndarray, mark: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order by run, key, mark, place; whether each begins a run or repeats its row's very place; index of its run's first)."""
    order = np.lexsort((at, mark, key, run))
    r, k, m, a = run[order], key[order], mark[order], at[order]
    begins = np.append(True, r[1:] != r[:-1])[:len(r)]
    head = np.flatnonzero(begins)[np.cumsum(begins) - 1] if len(r) else order
    same = (k == k[head]) & (m == m[head]) & (a == a[head])  # copies of the first's row
    return order, begins | same, head


def _rows(deal, run, key, mark, at, size, earlier, repeat) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(deal), pa.array(run), pa.array(key), pa.array(mark), pa.array(at.astype(np.int32)),
         pa.array(size.astype(np.int32)), pa.array(earlier), pa.array(repeat)], schema=_OCCURRENCE)


def _decided(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences of a task's runs that are not the first: those known from their batch, then those found here."""
    held: list[list[np.ndarray]] = [[] for _ in range(5)]
    for b in batches:
        columns = [c.to_numpy(zero_copy_only=False) for c in b.columns]
        known = columns[7]
        yield b.filter(pa.array(known))
        for h, c in zip(held, (columns[i] for i in (1, 2, 3, 4, 5)), strict=True):
            h.append(c[~known])
    if not held[0]:
        return
    run, key, mark, at, size = (np.concatenate(h) for h in held)
    order, new, head = _grouped(run, key, mark, at)
    pick = order[~new]
    first = key[order][head[~new]]
    for i in range(0, len(pick), 100_000):
        p = pick[i:i + 100_000]
        yield _rows(run[p], run[p], key[p], mark[p], at[p], size[p], first[i:i + 100_000], np.ones(len(p), bool))


_SPANS = "key bigint, mark bigint, start array<int>, end array<int>, earlier array<bigint>"


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Overlapping and touching spans of each row as one, with the smallest key that has any of it earlier."""
    for b in batches:
        starts, ends, earliers = [], [], []
        for spans in b.column(2).to_pylist():
            got: list[list[int]] = []
            for at, size, early in sorted((s["at"], s["words"], s["earlier"]) for s in spans):
                if got and at <= got[-1][1]:
                    got[-1][1] = max(got[-1][1], at + size)
                    got[-1][2] = min(got[-1][2], early)
                else:
                    got.append([at, at + size, early])
            starts.append([g[0] for g in got])
            ends.append([g[1] for g in got])
            earliers.append([None if g[2] == _NULL else g[2] for g in got])
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), pa.array(starts, pa.list_(pa.int32())), pa.array(ends, pa.list_(pa.int32())),
             pa.array(earliers, pa.list_(pa.int64()))], ["key", "mark", "start", "end", "earlier"])


def repeated_spans(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document with something to remove: its integer ``key``, its
    ``mark``, and arrays of word offsets ``start`` and ``end`` (end exclusive)
    with ``earlier``, the smallest key among the earlier occurrences seen.

    Null and empty texts and texts below the least run have no spans. A null
    key comes before all others. Rows equal in key and text count as one
    document, and rows that share only the key are told apart by their text.
    A run that a document repeats itself is removed from its second place on.
    """
    rows = docs.select(F.col(key).cast("long").alias("key"), row_mark(F.col(text)).alias("mark"), F.col(text).alias("text"))
    met = rows.mapInArrow(tidied(_occurrences), _OCCURRENCE_SQL).repartition("deal").mapInArrow(tidied(_decided), _OCCURRENCE_SQL)
    spans = (met.groupBy("key", "mark", "at").agg(F.max("words").alias("words"), F.min("earlier").alias("earlier"))
             .groupBy("key", "mark").agg(F.collect_list(F.struct("at", "words", "earlier")).alias("spans")))
    null = F.lit(int(_NULL))
    return (spans.mapInArrow(tidied(_merged), _SPANS)
            .withColumn("key", F.when(F.col("key") != null, F.col("key"))))


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of (..., text, start, end) without their spans; untouched texts pass as they are."""
    for b in batches:
        n = b.num_columns
        out = b.column(n - 3).to_pylist()
        touched = [i for i, s in enumerate(b.column(n - 2)) if s.is_valid]
        for i in touched:
            raw = (out[i] or "").encode()
            words = Words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
            edge = np.append(words.start, len(raw))
            start = np.array(b.column(n - 2)[i].as_py(), np.int64)
            end = np.array(b.column(n - 1)[i].as_py(), np.int64)
            keep = np.ones(len(raw), bool)
            keep[expand(edge[start], edge[end] - edge[start])] = False
            cut = np.frombuffer(raw, np.uint8)[keep].tobytes().decode()
            out[i] = cut.rstrip() if len(end) and end[-1] == len(words.start) else cut
        yield pa.RecordBatch.from_arrays([*b.columns[:n - 3], pa.array(out, pa.string())], b.schema.names[:n - 2])


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", chars: str | None = "n_chars") -> DataFrame:
    """``docs``, with the same rows and columns, without the repeated spans.

    ``chars``, if it is a column, is set to the length of each changed text. A
    text that is all repeats becomes empty; its row stays. Other columns, null
    texts and unchanged texts stay as they are, whatever their names.
    """
    own, mark, start, end, cut, body = free(docs, "__key", "__mark", "__start", "__end", "__cut", "__text")
    spans = repeated_spans(docs, key, text).select(
        F.col("key").alias(own), F.col("mark").alias(mark), F.col("start").alias(start), F.col("end").alias(end))
    rest = [c for c in docs.columns if c != text]
    joined = docs.join(spans, docs[key].cast("long").eqNullSafe(F.col(own)) & (row_mark(docs[text]) == F.col(mark)), "left")
    fed = joined.select(*(docs[c] for c in rest), F.col(start).isNotNull().alias(cut), docs[text].alias(body), start, end)
    schema = T.StructType([*(docs.schema[c] for c in rest), T.StructField(cut, T.BooleanType()),
                           T.StructField(body, T.StringType())])
    done = fed.mapInArrow(tidied(_without), schema)
    columns = [F.col(body).alias(text) if c == text else
               F.when(F.col(cut), F.length(body)).otherwise(F.col(f"`{c}`")).cast(docs.schema[c].dataType).alias(c)
               if c == chars else F.col(f"`{c}`") for c in docs.columns]
    return done.select(*columns)
