"""Vectorised scanning of texts: words, lines, shingles and character n-grams of a whole
batch of documents as numpy arrays, with no Python loop over words.

All hashes are 64-bit polynomials over bytes with fixed odd constants and a final mix; two
different strings meet with a probability of about 2**-64 a pair.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 output bits."""
    x = x.astype(U, copy=True)
    x ^= x >> U(30)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


BYTE = mix(np.arange(1, 257, dtype=U) * U(0x9E3779B97F4A7C15))
STEP = U(0xD6E8FEB86659FD93)
_power = np.ones(1, U)

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(9, 14)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def powers(n: int) -> np.ndarray:
    global _power
    if len(_power) < n:
        steps = np.full(max(n, 2 * len(_power)), STEP, U)
        steps[0] = 1
        _power = np.multiply.accumulate(steps)
    return _power


def flat(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts of a string column (null: none) and where each text begins."""
    col = pc.fill_null(col, "")
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if not len(col):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    kind = np.int64 if pa.types.is_large_string(col.type) else np.int32
    _, offsets, data = col.buffers()
    off = np.frombuffer(offsets, kind)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, off - off[0]


class Runs:
    """Maximal runs of the bytes where ``inside`` holds, never across two texts."""

    def __init__(self, data: np.ndarray, off: np.ndarray, inside: np.ndarray):
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        last = inside.copy()
        last[:-1] &= ~inside[1:]
        cut = off[:-1][off[:-1] < len(data)]
        first[cut] = inside[cut]
        cut = off[1:][off[1:] > 0] - 1
        last[cut] = inside[cut]
        self.data, self.inside, self.n = data, inside, len(off) - 1
        self.start = np.flatnonzero(first)
        self.length = np.flatnonzero(last) + 1 - self.start
        self.doc = np.searchsorted(off, self.start, "right") - 1
        self.counts = np.bincount(self.doc, minlength=self.n)

    def hashes(self, table: np.ndarray = BYTE) -> np.ndarray:
        """One 64-bit hash of each run's bytes."""
        if not len(self.start):
            return np.zeros(0, U)
        at = np.cumsum(self.length) - self.length
        own = self.data[self.inside]
        place = np.arange(len(own)) - np.repeat(at, self.length)
        return mix(np.add.reduceat(table[own] * powers(int(self.length.max()))[place], at) + self.length.astype(U))


def words(data: np.ndarray, off: np.ndarray) -> Runs:
    return Runs(data, off, ~SPACE[data])


def windows(h: np.ndarray, doc: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` neighbouring items within a document, and the place of each window's first item."""
    m = len(h) - size + 1
    if m <= 0:
        return np.zeros(0, U), np.zeros(0, np.int64)
    at = np.flatnonzero(doc[:m] == doc[size - 1 :])
    out = h[at].copy()
    for k in range(1, size):
        out *= STEP
        out += h[at + k]
    return mix(out + U(size)), at


def shingle_sets(col: pa.Array, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """The sets of word shingles of every text, lower-cased in A-Z: (shingles, begin), where
    the sorted distinct hashes of text i are shingles[begin[i]:begin[i + 1]]. A text of fewer
    words is one shingle, a text without words has none."""
    data, off = flat(col)
    data = LOWER[data]
    w = words(data, off)
    h = w.hashes()
    s, at = windows(h, w.doc, size)
    doc = w.doc[at]
    short = np.flatnonzero((w.counts > 0) & (w.counts < size))
    if len(short):
        begin = np.concatenate([[0], np.cumsum(w.counts)])
        extra = np.zeros(len(short), U)
        for k in range(size - 1):
            more = w.counts[short] > k
            extra[more] = extra[more] * STEP + h[begin[short[more]] + k]
        s = np.concatenate([s, mix(extra + w.counts[short].astype(U))])
        doc = np.concatenate([doc, short])
        order = np.argsort(doc, kind="stable")
        s, doc = s[order], doc[order]
    counts = np.bincount(doc, minlength=w.n)
    begin = np.concatenate([[0], np.cumsum(counts)])
    keep = np.ones(len(s), bool)
    for i in np.flatnonzero(counts > 1):
        part = s[begin[i] : begin[i + 1]]
        part.sort()
        keep[begin[i] + 1 : begin[i + 1]] = part[1:] != part[:-1]
    counts = np.bincount(doc[keep], minlength=w.n)
    return s[keep], np.concatenate([[0], np.cumsum(counts)])


def letter_stream(col: pa.Array, digits: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Texts as letters (and digits) in lower case, everything else one blank, with a blank
    before and after: the stream that character n-grams are taken from."""
    blank = pa.scalar(" ", col.type)
    col = pc.binary_join_element_wise(blank, pc.fill_null(col, ""), blank, pa.scalar("", col.type))
    data, off = flat(col)
    table = np.full(256, 0x20, np.uint8)
    for lo, hi in ((ord("a"), ord("z")), (0x80, 0xFF), *(((ord("0"), ord("9")),) if digits else ())):
        table[lo : hi + 1] = np.arange(lo, hi + 1)
    table[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)
    out = table[data]
    # capital letters of the Latin-1 supplement are the bytes C3 80 to C3 9E
    caps = (out >= 0x80) & (out <= 0x9E) & (out != 0x97)
    caps[1:] &= out[:-1] == 0xC3
    caps[:1] = False
    out[caps] += 0x20
    blank = out == 0x20
    keep = ~blank
    keep[1:] |= ~blank[:-1]
    keep[off[:-1][off[:-1] < len(out)]] = True
    return out[keep], np.concatenate([[0], np.cumsum(keep)])[off]


def ngram_buckets(stream: np.ndarray, off: np.ndarray, n: int, bits: int) -> np.ndarray:
    """The bucket of ``bits`` bits of the byte n-gram (n <= 8) that begins at each place of
    the stream; 1 << bits where it would run into the next text."""
    m = len(stream) - n + 1
    out = np.full(len(stream), 1 << bits, np.int32)
    if m <= 0:
        return out
    key = stream[:m].astype(U)
    for k in range(1, n):
        key <<= U(8)
        key |= stream[k : k + m]
    key += U(n << 60)
    key *= U(0x9E3779B97F4A7C15)
    key ^= key >> U(29)
    key *= U(0xBF58476D1CE4E5B9)
    out[:m] = key >> U(64 - bits)
    for k in range(1, n):
        cut = off[1:] - k
        out[cut[cut >= 0]] = 1 << bits
    return out
