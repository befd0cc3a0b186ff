"""Pre-token boundaries of the public byte-level tokenizers, for whole chunks.

``public_tokenizers.PATTERN`` cuts a text into contractions, letter runs,
number runs, runs of other marks (each with at most one leading space) and
white space. The cuts follow from the class of neighbouring characters, so
they are found for all texts of a chunk at once with array comparisons
instead of a regular-expression scan; a test compares both on random texts.
"""

from __future__ import annotations

import numpy as np
import regex

from tillroll.llm.textarrays import span_hashes

LETTER, NUMBER, SPACE, OTHER = 0, 1, 2, 3
#: Larger chunks than elsewhere: the distinct pre-tokens of a chunk are looked up once.
TOKEN_CHUNK_BYTES = 1 << 20
_classes: np.ndarray | None = None


def classes() -> np.ndarray:
    """Class of every code point, from the Unicode properties; made once per worker."""
    global _classes
    if _classes is None:
        table = np.full(0x110000, OTHER, np.uint8)
        points = [*range(0xD800), *range(0xE000, 0x110000)]
        every = "".join(map(chr, points))
        at = np.array(points)
        for name, kind in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER), (r"\p{White_Space}+", SPACE)):
            for m in regex.finditer(name, every):
                table[at[m.start():m.end()]] = kind
        _classes = table
    return _classes


class PreTokens:
    """Pre-tokens of one chunk: byte ``start``/``end`` and ``first`` (``first[d]:first[d+1]`` belong to row d)."""

    def __init__(self, buf: np.ndarray, offsets: np.ndarray):
        self.buf = buf
        point = np.frombuffer(buf.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        n = len(point)
        if not n:
            self.start = self.end = np.zeros(0, np.int64)
            self.first = np.zeros(len(offsets), np.int64)
            return
        kind = classes()[point]
        # first byte of each character: every byte that is not a continuation byte
        at = np.append(np.flatnonzero((buf & 0xC0) != 0x80), len(buf))
        begin = np.zeros(n + 1, bool)  # a row begins at this character (or the chunk ends)
        begin[np.searchsorted(at, offsets)] = True
        cut = begin.copy()
        cut[1:n] |= kind[1:] != kind[:-1]
        # white space before a visible character of the same row gives up its last character,
        # which leads the next token if it is a plain space
        last = np.flatnonzero((kind[:-1] == SPACE) & (kind[1:] != SPACE) & ~begin[1:n])
        cut[last] = True
        plain = last[point[last] == 0x20]
        cut[plain + 1] = False
        # contractions: an apostrophe at a cut, directly before their letters
        quote = np.flatnonzero((point == 0x27) & cut[:n])
        if len(quote):
            def follows(k: int, letter: str) -> np.ndarray:
                q = np.minimum(quote + k, n - 1)
                same = quote + k < n
                for j in range(1, k + 1):
                    same &= ~begin[np.minimum(quote + j, n)]
                return same & (point[q] == ord(letter))

            two = np.zeros(len(quote), bool)
            for pair in ("re", "ve", "ll"):
                two |= follows(1, pair[0]) & follows(2, pair[1])
            one = np.zeros(len(quote), bool)
            for letter in "stmd":
                one |= follows(1, letter)
            for found, size in ((quote[one], 1), (quote[two & ~one], 2)):
                cut[found + 1] = False
                cut[found + size + 1] = True
        cuts = np.append(np.flatnonzero(cut[:n]), n)
        edges = at[cuts]
        self.start, self.end = edges[:-1], edges[1:]
        self.first = np.searchsorted(self.start, offsets)

    def unique(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(hash of each distinct pre-token, an index of one of it, number of the distinct one for each pre-token)."""
        h = span_hashes(self.buf, self.start, self.end)
        return np.unique(h, return_index=True, return_inverse=True)


def row_sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of ``values[first[d]:first[d+1]]`` for every row d."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[first[1:]] - total[first[:-1]]
