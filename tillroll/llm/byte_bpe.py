"""Byte-level BPE encoding and decoding with a two-tier lookup.

Tier one: a minimal perfect hash over the vocabulary (one slot per token, one
displacement per bucket) resolves whole pre-tokens, all distinct ones of a
chunk at once. Tier two: a pre-token that is no vocabulary entry is merged by
a heap of ranked neighbour pairs over a linked list of its bytes.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.pretoken import TOKEN_CHUNK_BYTES, PreTokens, row_sums
from tillroll.llm.textarrays import chunks, expand, mix, span_hashes
from tillroll.llm.workers import tidied

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Distinct pre-tokens whose ids a Python worker keeps between chunks; the store is emptied when full.
KEPT = 200_000


class PerfectHash:
    """Minimal perfect hash of distinct 64-bit keys by hash and displace.

    Buckets are placed in order of falling size; each takes the first
    displacement that sends all its keys to free slots. There are exactly as
    many slots as keys. ``slots(h)`` gives a slot for any key; whether the key
    is a member is told by comparing what that slot holds.
    """

    def __init__(self, keys: np.ndarray, per_bucket: int = 3):
        self.n = n = len(keys)
        self.buckets = max(1, n // per_bucket)
        self.shift = np.zeros(self.buckets, np.int64)
        taken = np.zeros(n, bool)
        if not n:
            return
        bucket, a, b = self._parts(keys)
        order = np.argsort(bucket, kind="stable")
        edge = np.searchsorted(bucket[order], np.arange(self.buckets + 1))
        tries = np.arange(256)
        for k in np.argsort(-np.diff(edge), kind="stable"):
            mine = order[edge[k]:edge[k + 1]]
            if not len(mine):
                break
            start = 0
            while True:
                d = tries + start
                spots = self._slot(a[mine, None], b[mine, None], d[None, :])
                fits = ~taken[spots].any(axis=0)
                if len(mine) > 1:
                    ranked = np.sort(spots, axis=0)
                    fits &= (np.diff(ranked, axis=0) > 0).all(axis=0)
                good = np.flatnonzero(fits)
                if len(good):
                    self.shift[k] = d[good[0]]
                    taken[spots[:, good[0]]] = True
                    break
                start += len(tries)

    def _parts(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        again = mix(keys ^ np.uint64(0xA0761D6478BD642F))
        return ((keys >> np.uint64(33)).astype(np.int64) % self.buckets,
                (again >> np.uint64(32)).astype(np.int64) % self.n, (again & np.uint64(0xFFFFFFFF)).astype(np.int64))

    def _slot(self, a: np.ndarray, b: np.ndarray, d: np.ndarray) -> np.ndarray:
        spread = mix((b.astype(np.uint64) << np.uint64(24)) + d.astype(np.uint64))
        return (a + (spread >> np.uint64(1)).astype(np.int64) % self.n) % self.n

    def slots(self, keys: np.ndarray) -> np.ndarray:
        bucket, a, b = self._parts(keys)
        return self._slot(a, b, self.shift[bucket])


class Encoder:
    """Vocabulary of a rank file with both lookup tiers and the decoder's byte table."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.rank = {base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(None, map(bytes.strip, f)))}
        self.size = 1 + max(self.rank.values(), default=-1)
        pieces = [b""] * self.size
        for piece, r in self.rank.items():
            pieces[r] = piece
        self.pieces = pieces
        self.length = np.array([len(p) for p in pieces], np.int64)
        self.at = np.cumsum(self.length) - self.length
        self.flat = np.frombuffer(b"".join(pieces), np.uint8)
        ids = np.flatnonzero(self.length)
        keys = span_hashes(self.flat, self.at[ids], (self.at + self.length)[ids])
        self.hash = PerfectHash(keys)
        slot = self.hash.slots(keys)
        self.slot_key, self.slot_id = np.zeros(len(ids), np.uint64), np.zeros(len(ids), np.int64)
        self.slot_key[slot], self.slot_id[slot] = keys, ids

    def whole(self, keys: np.ndarray) -> np.ndarray:
        """Id of each pre-token that is one vocabulary entry, else -1."""
        if not self.hash.n:
            return np.full(len(keys), -1)
        slot = self.hash.slots(keys)
        return np.where(self.slot_key[slot] == keys, self.slot_id[slot], -1)

    def merge(self, piece: bytes) -> list[int]:
        """Ids of a pre-token by a heap over its linked bytes: the lowest rank first, the leftmost of equal ranks."""
        rank, n = self.rank, len(piece)
        stop = list(range(1, n + 1))  # node i covers piece[i:stop[i]] and is followed by the node at stop[i]
        before = list(range(-1, n))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank.get(piece[i:i + 2])) is not None]
        heapq.heapify(heap)
        pop, push = heapq.heappop, heapq.heappush
        while heap:
            r, i, end = pop(heap)
            middle = stop[i]
            if middle < 0 or middle >= n or stop[middle] != end:
                continue  # one of the two has been merged meanwhile
            stop[i], stop[middle] = end, -1
            if end < n:
                before[end] = i
                if (s := rank.get(piece[i:stop[end]])) is not None:
                    push(heap, (s, i, stop[end]))
            left = before[i]
            if left >= 0 and (s := rank.get(piece[left:end])) is not None:
                push(heap, (s, left, end))
        out, i = [], 0
        while i < n:
            out.append(rank[piece[i:stop[i]]])
            i = stop[i]
        return out

    def encode_chunk(self, known: dict[int, bytes], buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows one after another, ids of each row)."""
        pre = PreTokens(buf, offsets)
        if not len(pre.start):
            return np.zeros(0, np.uint32), np.zeros(len(offsets) - 1, np.int64)
        key, where, number = pre.unique()
        whole = self.whole(key)
        held = [b""] * len(key)
        missing = np.flatnonzero(whole < 0)
        raw = buf.tobytes()
        if len(known) > KEPT:
            known.clear()
        for u, k, a, z in zip(missing.tolist(), key[missing].tolist(), pre.start[where[missing]].tolist(),
                              pre.end[where[missing]].tolist(), strict=True):
            ids = known.get(k)
            if ids is None:
                ids = known[k] = np.array(self.merge(raw[a:z]), "<u4").tobytes()
            held[u] = ids
        for u, i in zip(np.flatnonzero(whole >= 0).tolist(), whole[whole >= 0].astype("<u4").tolist(), strict=True):
            held[u] = i.to_bytes(4, "little")
        length = np.array([len(x) for x in held], np.int64) // 4
        flat = np.frombuffer(b"".join(held), "<u4")
        at = np.cumsum(length) - length
        return flat[expand(at[number], length[number])], row_sums(length[number], pre.first)

    def decode(self, ids: np.ndarray) -> bytes:
        ids = ids.astype(np.int64)
        return self.flat[expand(self.at[ids], self.length[ids])].tobytes()


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    return Encoder(path)


_kept: dict[str, dict[int, bytes]] = {}


def encode_rows(texts: pa.Array, path: str, limit: int = TOKEN_CHUNK_BYTES) -> Iterator[np.ndarray]:
    """Ids of every text in turn (null: none)."""
    e = encoder(path)
    known = _kept.setdefault(path, {})
    for _, _, buf, offsets in chunks(texts, limit):
        ids, count = e.encode_chunk(known, buf, offsets)
        yield from np.split(ids, np.cumsum(count)[:-1])


def _path(vocabulary: str | None) -> str:
    return vocabulary or public_tokenizers.path(VOCABULARY)


def encode(df: DataFrame, text: str = "text", ids: str = "ids", vocabulary: str | None = None) -> DataFrame:
    """``df`` with a column ``ids`` (array of int) holding the tokens of each text.

    Null and empty texts give an empty array; a column already called ``ids``
    is replaced; all other columns, null keys and repeated rows stay as they
    are. Narrow: no shuffle, one chunk of texts in memory at a time.
    """
    path = _path(vocabulary)
    kept = [c for c in df.columns if c != ids]
    schema = T.StructType([*(df.schema[c] for c in kept), T.StructField(ids, T.ArrayType(T.IntegerType()))])
    at = kept.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [r.astype(np.int32) for r in encode_rows(b.column(at), path)]
            values = pa.array(np.concatenate(rows) if rows else np.zeros(0, np.int32))
            edges = pa.array(np.append(0, np.cumsum([len(r) for r in rows])).astype(np.int32))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.ListArray.from_arrays(edges, values)], [*kept, ids])

    return df.select(*(df[c] for c in kept)).mapInArrow(tidied(run, _kept.clear), schema)


def decode(df: DataFrame, ids: str = "ids", text: str = "text", vocabulary: str | None = None) -> DataFrame:
    """``df`` with a binary column ``text``: the bytes of each array of tokens (null and empty arrays: no bytes)."""
    path = _path(vocabulary)
    kept = [c for c in df.columns if c != text]
    schema = T.StructType([*(df.schema[c] for c in kept), T.StructField(text, T.BinaryType())])
    at = kept.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path)
        for b in batches:
            out = [e.decode(np.asarray(x.values if x.is_valid else [], np.int64)) for x in b.column(at)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.binary())], [*kept, text])

    return df.select(*(df[c] for c in kept)).mapInArrow(tidied(run, _kept.clear), schema)


def round_trip(df: DataFrame, text: str = "text", keys: tuple[str, ...] = ("doc_id",),
               vocabulary: str | None = None) -> DataFrame:
    """``keys`` with ``n_tokens``, ``ids_sha256`` (ids as little-endian unsigned
    32-bit integers) and ``decoded_sha256`` (the bytes decoded from those ids).

    The same encoder and decoder as :func:`encode` and :func:`decode`, with the
    digests taken in the task so that neither ids nor texts are carried on.
    Null and empty texts: 0 tokens and the digest of nothing. Keys may be null
    or repeated; other columns are not read.
    """
    path = _path(vocabulary)
    names = ("n_tokens", "ids_sha256", "decoded_sha256")
    if clash := set(keys) & set(names):
        raise ValueError(f"keys named like results: {sorted(clash)}")
    schema = T.StructType([*(df.schema[k] for k in keys), T.StructField("n_tokens", T.LongType()),
                           T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path)
        for b in batches:
            n, digest, back = [], [], []
            for ids in encode_rows(b.column(len(keys)), path):
                n.append(len(ids))
                digest.append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
                back.append(hashlib.sha256(e.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [*(b.column(i) for i in range(len(keys))), pa.array(n, pa.int64()), pa.array(digest, pa.string()),
                 pa.array(back, pa.string())], [*keys, *names])

    return df.select(*(F.col(f"`{k}`") for k in keys), df[text].alias("__text")).mapInArrow(tidied(run, _kept.clear), schema)
