"""Benchmark decontamination by n-gram seeds and local alignment.

1. Three-word grams of all benchmark items go into a bitmap of fixed size.
   Every gram is a seed, however many documents or items have it: a rule on
   frequencies would lose the copies that many documents hold.
2. One pass over the corpus cuts, around every seed, a passage of the document
   wide enough for the longest item; equi-joins on the seed give (passage, item).
3. A pair that has too few of the item's words in the passage cannot reach the
   score and goes without alignment (an upper bound, so nothing is lost).
4. Smith-Waterman alignment over word hashes scores each remaining pair: the
   best local alignment as a share of a perfect one. Copies with words replaced,
   dropped or added score less than 1 but far above chance.
5. A long excerpt of an item is contamination too, however long the item is:
   an alignment of ``EXCERPT`` or more whose aligned parts are nearly the same.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.storage import free, written
from tillroll.llm.textarrays import Words, chunks, mix, span_hashes
from tillroll.llm.workers import tidied

GRAM = 3
#: Bits of a gram bitmap (8 MB, whatever the size of the benchmark).
BITS = 1 << 26
MATCH, MISMATCH, GAP = 1.0, -0.5, -0.5
#: Least share of the perfect score that counts as contamination.
LEAST = 0.6
#: Score (matched words, less the edits) from which an excerpt of any share of an item counts, and its least share of the aligned words.
EXCERPT, ALIKE = 25.0, 0.8


def _word_hashes(buf: np.ndarray, offsets: np.ndarray) -> tuple[Words, np.ndarray]:
    """Words of a chunk and their hashes without case and surrounding marks."""
    words = Words(buf, offsets)
    start, end = words.core()
    return words, span_hashes(words.buf, start, end) if len(start) else np.zeros(0, np.uint64)


def _grams(words: Words, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first word, hash) of every gram that lies within one row."""
    n = len(h) - GRAM + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    rolled = np.zeros(n, np.uint64)
    for k in range(GRAM):
        rolled = rolled * np.uint64(0x9E3779B97F4A7C15) + h[k:n + k]
    at = np.flatnonzero(words.doc[:n] == words.doc[GRAM - 1:])
    return at, mix(rolled[at])


def _item_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(item, word hashes, distinct grams) of every (item, text)."""
    for b in batches:
        packed, grams = [], []
        for first, end, buf, offsets in chunks(b.column(1)):
            words, h = _word_hashes(buf, offsets)
            at, g = _grams(words, h)
            for d in range(end - first):
                low, high = words.first[d], words.first[d + 1]
                packed.append(h[low:high].tobytes())
                grams.append(np.unique(g[np.searchsorted(at, low):np.searchsorted(at, high)]).view(np.int64))
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(packed, pa.binary()), pa.array(grams, pa.list_(pa.int64()))],
                                         ["item", "words", "grams"])


def bitmap(grams: DataFrame) -> np.ndarray:
    """Bitmap of column ``gram``: set bits are combined on the executors; at most BITS / 64 words reach the driver."""
    at = F.pmod("gram", F.lit(BITS))
    one = F.expr(f"shiftleft(1L, CAST(pmod(gram, {BITS}) % 64 AS INT))")
    rows = grams.select(F.floor(at / 64).cast("int").alias("word"), one.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits"))
    got = rows.toArrow()
    out = np.zeros(BITS // 64, np.uint64)
    out[got.column("word").to_numpy()] = got.column("bits").to_numpy().view(np.uint64)
    return out


def _has(bits: np.ndarray, grams: np.ndarray) -> np.ndarray:
    at = grams & np.uint64(BITS - 1)
    return (bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1


def passages(docs: DataFrame, key: str, text: str, bits: np.ndarray, reach: int) -> DataFrame:
    """(key, mark, at, words, grams): passages of ``reach`` words around seeds; those that touch are one."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, at_, packed, grams = [], [], [], []
            for first, _, buf, offsets in chunks(b.column(2)):
                words, h = _word_hashes(buf, offsets)
                at, g = _grams(words, h)
                hit = np.flatnonzero(_has(shared.value, g))
                if not len(hit):
                    continue
                place, doc = at[hit], words.doc[at[hit]]
                new = np.append(True, (doc[1:] != doc[:-1]) | (place[1:] - place[:-1] > 2 * reach))
                begin = np.flatnonzero(new)
                for s, e in zip(begin.tolist(), np.append(begin[1:], len(hit)).tolist(), strict=True):
                    d = doc[s]
                    low = max(words.first[d], place[s] - reach)
                    high = min(words.first[d + 1], place[e - 1] + GRAM + reach)
                    rows.append(first + d)
                    at_.append(low - words.first[d])
                    packed.append(h[low:high].tobytes())
                    grams.append(np.unique(g[hit[s:e]]).view(np.int64))
            pick = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0).take(pick), b.column(1).take(pick), pa.array(at_, pa.int32()),
                                              pa.array(packed, pa.binary()), pa.array(grams, pa.list_(pa.int64()))],
                                             ["key", "mark", "at", "words", "grams"])

    return (docs.select(F.col(key).cast("long").alias("key"), F.xxhash64(text).alias("mark"), F.col(text).alias("text"))
            .mapInArrow(tidied(run), "key bigint, mark bigint, at int, words binary, grams array<bigint>"))


def align(a: np.ndarray, b: np.ndarray) -> tuple[float, int, int]:
    """(score, start, end) of the best local alignment of ``a`` within ``b``; start and end are places in ``b`` (end exclusive).

    Smith-Waterman with linear gaps, one array operation per word of ``a``:
    gaps along ``b`` follow from a running maximum.
    """
    n = len(b)
    slope = -GAP * np.arange(n + 1)
    row, begin = np.zeros(n + 1), np.arange(n + 1)
    best, found = 0.0, (0, 0)
    for x in a:
        diagonal = row[:-1] + np.where(b == x, MATCH, MISMATCH)
        up = row[1:] + GAP
        now = np.maximum(diagonal, up)
        start = np.where(diagonal >= up, begin[:-1], begin[1:])
        fresh = now <= 0
        now = np.append(0.0, np.where(fresh, 0.0, now))
        start = np.append(0, np.where(fresh, np.arange(1, n + 1), start))
        lifted = now + slope
        top = np.maximum.accumulate(lifted)
        source = np.maximum.accumulate(np.where(lifted >= top, np.arange(n + 1), 0))
        row = top - slope
        begin = np.where(row > 0, start[source], np.arange(n + 1))
        k = int(row.argmax())
        if row[k] > best:
            best, found = float(row[k]), (int(begin[k]), k)
    return best, *found


def _excerpt(item: np.ndarray, part: np.ndarray, score: float) -> bool:
    """Whether an alignment of ``item`` with the whole of ``part`` is long, and close on both sides."""
    if score < EXCERPT:
        return False
    _, low, high = align(part, item)
    return score >= ALIKE * MATCH * max(len(part), high - low)


def _aligned(least: float):
    """Alignments of at least ``least`` of the item, or of a long excerpt, of every (key, mark, at, words, item, item words)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, score, start, end = [], [], [], []
            for i, (at, words, item) in enumerate(zip(*(b.column(c).to_pylist() for c in (2, 3, 5)), strict=True)):
                a, p = np.frombuffer(item, np.uint64), np.frombuffer(words, np.uint64)
                # every match takes one of the item's words that the passage has
                most = MATCH * np.isin(a, p).sum()
                if most / (MATCH * len(a)) < least and most < EXCERPT:
                    continue
                s, low, high = align(a, p)
                if s / (MATCH * len(a)) >= least or _excerpt(a, p[low:high], s):
                    rows.append(i)
                    score.append(s / (MATCH * len(a)))
                    start.append(at + low)
                    end.append(at + high)
            pick = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0).take(pick), b.column(1).take(pick), b.column(4).take(pick),
                                              pa.array(score, pa.float64()), pa.array(start, pa.int32()), pa.array(end, pa.int32())],
                                             ["key", "mark", "item", "score", "start", "end"])
    return run


def contamination(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
                  item_text: str = "text", least: float = LEAST) -> DataFrame:
    """(key, mark, item, score, start, end) of every passage of ``docs`` that aligns with a benchmark item.

    ``score`` is the share of the item's perfect alignment score: ``least`` to
    1, or less for a nearly verbatim excerpt of ``EXCERPT`` words or more.
    ``start`` and ``end`` are word offsets in the document. ``key`` and
    ``item`` are integers (null stays null), ``mark`` is the hash of the text.
    Null, empty and very short texts, and items of fewer than three words, have
    no grams and match nothing. Equal items are each reported; repeated rows of
    ``docs`` are reported as often as they occur. Other columns are not read.
    """
    items = written(benchmark.select(F.col(item).cast("long").alias("item"), F.col(item_text).alias("text"))
                    .mapInArrow(_item_words, "item bigint, words binary, grams array<bigint>")
                    .withColumn("number", F.monotonically_increasing_id()), "decontaminate-items")
    grams = items.select("number", F.explode("grams").alias("gram"))
    reach = (items.agg(F.max(F.octet_length("words"))).first()[0] or 0) // 8
    found = written(passages(docs, key, text, bitmap(grams.select("gram")), reach).withColumn("id", F.monotonically_increasing_id()),
                    "decontaminate-passages")
    pairs = found.select("id", F.explode("grams").alias("gram")).join(grams, "gram").select("id", "number").distinct()
    fed = (pairs.join(found.select("id", "key", "mark", "at", "words"), "id")
           .join(items.select("number", "item", F.col("words").alias("item_words")), "number")
           .select("key", "mark", "at", "words", "item", "item_words"))
    return fed.mapInArrow(tidied(_aligned(least)), "key bigint, mark bigint, item bigint, score double, start int, end int")


def without_contaminated(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no benchmark passage, with the columns they came with."""
    own, mark = free(docs, "__key", "__mark")
    bad = contamination(docs, benchmark, key, text).select(F.col("key").alias(own), F.col("mark").alias(mark)).distinct()
    return docs.join(bad, docs[key].cast("long").eqNullSafe(F.col(own)) & (F.xxhash64(docs[text]) == F.col(mark)), "left_anti")
