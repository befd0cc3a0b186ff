"""Texts of an Arrow batch as flat numpy arrays: bytes, words and span hashes.

Tasks work on chunks of whole rows (about ``CHUNK_BYTES`` of text, of which the
arrays take some forty times; a longer
row is a chunk of its own), so memory follows the longest single text and not
the partition. Words are runs outside ``[\\x20\\x09-\\x0D]``; hashes are 64-bit
and computed for all words of a chunk at once from a running polynomial sum.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 19
#: Powers that a worker keeps, enough for the largest chunk of usual rows.
KEPT_POWERS = (1 << 20) + 1

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20

_MARK = np.zeros(256, bool)
_MARK[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = True

_BASE = 0x9E3779B97F4A7C55
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE_VALUE = np.random.default_rng(20240917).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_powers: dict[str, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; those of a usual chunk are kept per worker."""
    have = _powers.get(str(base))
    if have is None or len(have) < n:
        steps = np.full(max(n, KEPT_POWERS), base, np.uint64)
        steps[0] = 1
        have = np.cumprod(steps, dtype=np.uint64)
        _powers[str(base)] = have[:KEPT_POWERS].copy() if n > KEPT_POWERS else have  # a longer text's are not kept
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (the public splitmix64 constants)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span ``buf[starts[i]:ends[i]]``."""
    total = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(_BYTE_VALUE[buf] * _power(_BASE, len(buf)), out=total[1:], dtype=np.uint64)
    h = (total[ends] - total[starts]) * _power(_INVERSE, len(buf) + 1)[starts]
    return mix(h + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of each chunk; null texts are empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    n = len(texts)
    if not n:
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + n + 1]
    data = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        end = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        end = min(n, max(end, first + 1))
        yield first, end, data[offsets[first]:offsets[end]], offsets[first:end + 1] - offsets[first]
        first = end


class Words:
    """Words of one chunk: byte ``start``/``end``, ``doc`` (row within the chunk) and ``first``: ``first[d]:first[d+1]`` are the words of row d."""

    def __init__(self, buf: np.ndarray, offsets: np.ndarray, lower: bool = True):
        self.buf = _LOWER[buf] if lower else buf
        n = len(buf)
        solid = ~_SPACE[buf]
        edge = np.zeros(n + 1, bool)
        edge[offsets] = True
        begins = solid.copy()
        begins[1:] &= ~solid[:-1] | edge[1:n]
        stops = solid.copy()
        stops[:-1] &= ~solid[1:] | edge[1:n]
        self.start = np.flatnonzero(begins)
        self.end = np.flatnonzero(stops) + 1
        self.first = np.searchsorted(self.start, offsets)
        self.count = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(offsets) - 1), self.count)

    def hashes(self) -> np.ndarray:
        return span_hashes(self.buf, self.start, self.end)

    def core(self) -> tuple[np.ndarray, np.ndarray]:
        """(start, end) of every word without the marks around it (one byte is always left)."""
        start, end = self.start.copy(), self.end.copy()
        while len(start):
            lead = (start < end - 1) & _MARK[self.buf[start]]
            tail = (end - 1 > start) & _MARK[self.buf[end - 1]]
            tail &= ~lead | (end - start > 2)
            if not (lead.any() or tail.any()):
                break
            start += lead
            end -= tail
        return start, end

    def shingles(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """(row, hash) of every ``width``-word shingle; a row with fewer words
        (but any) has its whole sequence as one, a row without words none."""
        h = self.hashes()
        n = len(h)
        out_doc, out = [], []
        if n >= width:
            rolled = np.zeros(n - width + 1, np.uint64)
            for k in range(width):
                rolled = rolled * np.uint64(0x9E3779B97F4A7C15) + h[k:n - width + 1 + k]
            inside = self.doc[:n - width + 1] == self.doc[width - 1:]
            out_doc.append(self.doc[:n - width + 1][inside])
            out.append(mix(rolled[inside]))
        for d in np.flatnonzero((self.count > 0) & (self.count < width)):
            total = np.uint64(self.count[d])
            with np.errstate(over="ignore"):
                for v in h[self.first[d]:self.first[d + 1]]:
                    total = total * np.uint64(0xC2B2AE3D27D4EB4F) + v
            out_doc.append(np.array([d]))
            out.append(mix(np.array([total ^ np.uint64(0x5851F42D4C957F2D)], np.uint64)))
        if not out:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        return np.concatenate(out_doc), np.concatenate(out)


def expand(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start, start+1, ... of every ragged piece, one after another."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(total)
