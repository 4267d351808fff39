"""TextRank scores of one document's sentences.

Two sentences are joined with the weight (matching word pairs) / (ln a + ln b)
for a and b words, or the plain number of pairs when both have one word; the
pair of a sentence with itself counts, so rank is conserved. Up to ``PAIRS``
sentences the weights are one small matrix. Beyond, as the weight depends on
shared words and the two lengths only, W q is built from sums per (word,
sentence length): work and memory follow the number of words, and no matrix of
sentence pairs exists.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa

WORD = re.compile("[a-z0-9]+")
#: (word, length) sums held at once; above it lengths are taken one by one.
DENSE = 1 << 21
#: Sentences of a document whose pairs are held as a matrix.
PAIRS = 256
#: Documents that are Python objects at once.
ROWS = 256


def graph(sentences: list[str]):
    """(sentence, word, count) triples by sentence, and the sentence lengths."""
    ids: dict[str, int] = {}
    sid, wid, size = [], [], []
    for i, s in enumerate(sentences):
        words = [ids.setdefault(w, len(ids)) for w in WORD.findall(s.lower())]
        sid += [i] * len(words)
        wid += words
        size.append(len(words))
    v = max(len(ids), 1)
    key, count = np.unique(np.array(sid, np.int64) * v + np.array(wid, np.int64), return_counts=True)
    return key // v, key % v, count.astype(float), np.array(size, np.int64), v


def ranks(sentences: list[str], iterations: int, damping: float) -> np.ndarray:
    n = len(sentences)
    if not n:
        return np.zeros(0)
    sid, wid, count, size, v = graph(sentences)
    lengths, kind = np.unique(size, return_inverse=True)
    m, begin = len(lengths), np.searchsorted(sid, np.arange(n))
    log = np.log(np.maximum(lengths, 1).astype(float))
    total = log[:, None] + log[None, :]
    scale = np.where(total > 0, 1 / np.where(total > 0, total, 1), 1.0)[kind]  # of a sentence with each length

    pairs = None
    if n <= PAIRS and n * v <= DENSE:
        held = np.zeros((n, v))
        held[sid, wid] = count
        pairs = (held @ held.T) * scale[:, kind]

    def joined(q: np.ndarray) -> np.ndarray:
        if pairs is not None:
            return pairs @ q
        own = count * q[sid]
        if v * m <= DENSE:
            sums = np.bincount(wid * m + kind[sid], own, v * m).reshape(v, m)
            return (np.add.reduceat(count[:, None] * sums[wid], begin, axis=0) * scale).sum(axis=1)
        out = np.zeros(n)
        for k in range(m):
            here = kind[sid] == k
            sums = np.bincount(wid[here], own[here], v)
            out += np.add.reduceat(count * sums[wid], begin) * scale[:, k]
        return out

    weight, r = joined(np.ones(n)), np.full(n, 1.0 / n)
    for _ in range(iterations):
        r = (1 - damping) / n + damping * joined(r / weight)
    return r


def ranks_udf(iterations: int, damping: float, digits: int):
    """Rounded ranks of an array of sentences; each must hold a word."""
    from pyspark.sql.functions import arrow_udf

    @arrow_udf("array<double>")
    def score(col: pa.Array) -> pa.Array:
        out = [pa.array([], pa.list_(pa.float64()))]
        for lo in range(0, len(col), ROWS):
            docs = col.slice(lo, ROWS).to_pylist()
            out.append(pa.array([None if x is None else np.round(ranks(x, iterations, damping), digits) for x in docs], pa.list_(pa.float64())))
        return pa.concat_arrays(out)

    return score
