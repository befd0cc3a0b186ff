"""Token counts by rank-synchronous merging.

The distinct pre-tokens of a batch that are not known yet are held together
as one ragged array of symbols. In every round each sequence's lowest-ranked
adjacent pair is found (one table search and one segmented minimum for all
sequences) and applied everywhere in its sequence at the same time; sequences
without a mergeable pair leave. What survives is counted.

Long sequences (scripts without spaces, encoded data) would take a round over
all of their symbols for every rank they hold. A merge that uses a symbol comes
after the merge that made it in every trained vocabulary (checked when the file
is read), so ranks only rise: for long sequences the positions of pairs are
queued by rank, every rank is applied once in all of them at the same time, and
only the neighbours of what was merged are looked up again.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tillroll.llm.pretoken import TOKEN_CHUNK_BYTES, PreTokens, row_sums
from tillroll.llm.textarrays import chunks, expand
from tillroll.llm.workers import tidied

VOCABULARY = "byte_bpe_50k.json"
#: Distinct pre-tokens whose counts a Python worker keeps between batches; the store is emptied when full.
KEPT = 500_000
#: Symbols from which a sequence is merged by queued positions.
LONG = 256


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: printable Latin-1 as itself, the rest from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


class Merges:
    """Merge table of a byte-level vocabulary file, as sorted pair keys."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, pairs = spec["model"]["vocab"], spec["model"]["merges"]
        pairs = [p.split(" ") if isinstance(p, str) else p for p in pairs]
        self.byte_id = np.array([vocab[c] for c in _byte_letters()], np.int64)
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        key = left << 32 | right
        self.order = np.argsort(key, kind="stable")
        self.key, self.made = key[self.order], made[self.order]
        self.none = len(pairs)
        first = dict(zip(made.tolist()[::-1], range(len(pairs) - 1, -1, -1), strict=True))
        #: Whether every merge comes after those that make its two symbols.
        self.rising = all(first.get(a, -1) < r and first.get(b, -1) < r for r, (a, b) in enumerate(zip(left.tolist(), right.tolist(), strict=True)))
        #: Added tokens stand for themselves wherever their text occurs; longest first where several begin.
        self.special = sorted((t["content"] for t in spec.get("added_tokens", [])), key=len, reverse=True)

    def rank(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, merged symbol) of each pair; rank ``none`` where it is no merge."""
        key = left << 32 | right
        i = np.searchsorted(self.key, key)
        i[i == len(self.key)] = 0
        hit = self.key[i] == key
        return np.where(hit, self.order[i], self.none), self.made[i]

    def counts(self, symbols: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Symbols left of each sequence when no pair of it can be merged."""
        long = (lengths >= LONG) & self.rising
        if not long.any():
            return self._short_counts(symbols, lengths)
        out = np.zeros(len(lengths), np.int64)
        each = np.repeat(long, lengths)
        out[long] = self._long_counts(symbols[each], lengths[long])
        out[~long] = self._short_counts(symbols[~each], lengths[~long])
        return out

    def _long_counts(self, symbols: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """``counts`` by positions queued by rank; every rank is applied once."""
        n, end = len(symbols), np.cumsum(lengths)
        symbols, alive = symbols.copy(), np.ones(n, bool)
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        after[end - 1], before[end - lengths] = -1, -1
        now = np.full(n, self.none)     # rank of the pair that begins here
        waiting: dict[int, list[np.ndarray]] = {}
        ranks: list[int] = []

        def look(at: np.ndarray) -> None:
            pairs = at[after[at] >= 0]
            now[at] = self.none
            now[pairs] = self.rank(symbols[pairs], symbols[after[pairs]])[0]
            pairs = pairs[now[pairs] < self.none]
            pairs = pairs[np.argsort(now[pairs], kind="stable")]
            found = now[pairs]
            cut = np.flatnonzero(np.diff(found)) + 1
            for part in np.split(pairs, cut) if len(pairs) else ():
                r = int(now[part[0]])
                if r not in waiting:
                    waiting[r] = []
                    heapq.heappush(ranks, r)
                waiting[r].append(part)

        look(np.arange(n))
        while ranks:
            r = heapq.heappop(ranks)
            at = np.unique(np.concatenate(waiting.pop(r)))
            at = at[(now[at] == r) & alive[at]]
            if not len(at):
                continue
            # of overlapping equal pairs (aaa) the first, third, ... are joined, as left to right does
            begins = np.append(True, after[at[:-1]] != at[1:])
            at = at[(np.arange(len(at)) - np.flatnonzero(begins)[np.cumsum(begins) - 1]) % 2 == 0]
            gone = after[at]
            symbols[at] = self.rank(symbols[at[:1]], symbols[gone[:1]])[1][0]
            alive[gone], now[gone] = False, self.none
            after[at] = after[gone]
            has = after[at] >= 0
            before[after[at][has]] = at[has]
            left = before[at]
            look(np.unique(np.concatenate([at, left[left >= 0]])))
        return np.add.reduceat(alive.astype(np.int64), end - lengths)

    def _short_counts(self, symbols: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """``counts`` by rounds over all symbols."""
        out = lengths.astype(np.int64).copy()
        live = np.flatnonzero(lengths > 1)
        symbols = symbols[np.repeat(lengths > 1, lengths)]
        while len(live):
            size = out[live]
            end = np.cumsum(size)
            rank, made = self.rank(symbols[:-1], symbols[1:])
            rank[end[:-1] - 1] = self.none  # pairs across two sequences
            rank = np.append(rank, self.none)
            best = np.minimum.reduceat(rank, end - size)
            going = best < self.none
            joined = (rank == np.repeat(best, size)) & (rank < self.none)
            # of overlapping equal pairs (aaa) the first, third, ... are joined, as left to right does
            at = np.flatnonzero(joined)
            run = np.cumsum(np.append(True, np.diff(at) > 1)) if len(at) else at
            if len(at):
                begin = np.flatnonzero(np.append(True, np.diff(at) > 1))
                odd = (at - at[begin[run - 1]]) % 2 == 1
                at = at[~odd]
            keep = np.ones(len(symbols), bool)
            symbols[at] = made[at]
            keep[at + 1] = False
            out[live] = np.add.reduceat(keep.astype(np.int64), end - size)
            keep &= np.repeat(going & (out[live] > 1), size)
            live = live[going & (out[live] > 1)]
            symbols = symbols[keep]
        return out


@lru_cache(maxsize=4)
def merges(path: str) -> Merges:
    return Merges(path)


_kept: dict[str, dict[int, int]] = {}


def _chunk_counts(m: Merges, known: dict[int, int], buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    pre = PreTokens(buf, offsets)
    if not len(pre.start):
        return np.zeros(len(offsets) - 1, np.int64)
    key, where, number = pre.unique()
    got = [known.get(k, -1) for k in key.tolist()]
    count = np.array(got, np.int64)
    new = np.flatnonzero(count < 0)
    if len(new):
        starts, lengths = pre.start[where[new]], (pre.end - pre.start)[where[new]]
        count[new] = m.counts(m.byte_id[buf[expand(starts, lengths)]], lengths)
        if len(known) + len(new) > KEPT:
            known.clear()
        known.update(zip(key[new].tolist(), count[new].tolist(), strict=True))
    return row_sums(count[number], pre.first)


def text_counts(texts: pa.Array, path: str, limit: int = TOKEN_CHUNK_BYTES) -> np.ndarray:
    """Tokens of every text (null: none)."""
    m = merges(path)
    known = _kept.setdefault(path, {})
    out = np.zeros(len(texts), np.int64)
    for first, end, buf, offsets in chunks(texts, limit):
        raw = buf.tobytes()
        if any(s.encode() in raw for s in m.special):
            cut = re.compile(b"|".join(re.escape(s.encode()) for s in m.special))
            rows = [cut.split(raw[offsets[d]:offsets[d + 1]]) for d in range(end - first)]
            size = np.array([len(r) for r in rows])
            parts = [p for r in rows for p in r]
            edge = np.append(0, np.cumsum([len(p) for p in parts]))
            part = _chunk_counts(m, known, np.frombuffer(b"".join(parts), np.uint8), edge)
            out[first:end] = row_sums(part, np.append(0, np.cumsum(size))) + size - 1
        else:
            out[first:end] = _chunk_counts(m, known, buf, offsets)
    return out


def count_tokens(df: DataFrame, text: str = "text", keys: tuple[str, ...] = ("doc_id",),
                 vocabulary: str | None = None, limit: int = 1024) -> DataFrame:
    """``keys``, ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` (more than
    ``limit`` tokens; limit is at least 1) of every row of ``df``.

    Null and empty texts have 0 bytes and 0 tokens. Repeated rows are counted
    each for itself, keys may be null or repeated, columns besides ``keys`` and
    ``text`` are not read and may have any names (keys must not be called like
    the three results). The text of an added token counts as that token. One
    narrow pass without a shuffle; a lost task is simply run again.
    """
    path = vocabulary or public_tokenizers.path(VOCABULARY)
    clash = {"n_bytes", "n_tokens", "over_limit"} & set(keys)
    if clash or limit < 1:
        raise ValueError(f"keys named like results: {sorted(clash)}" if clash else "limit must be at least 1")
    fields = [df.schema[k] for k in keys]
    schema = T.StructType([*fields, T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType()),
                           T.StructField("over_limit", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc
        for b in batches:
            texts = b.column(len(keys))
            n = pa.array(text_counts(texts, path))
            size = pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(len(keys))), size, n, pc.greater(n, limit)],
                                             [*keys, "n_bytes", "n_tokens", "over_limit"])

    return df.select(*(df[k] for k in keys), df[text].alias("__text")).mapInArrow(tidied(run, _kept.clear), schema)
