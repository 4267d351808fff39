"""Toxicity by a character n-gram linear classifier with naive Bayes scaling.

Features are the distinct character n-grams of a text (hashed). Each is scaled by its naive
Bayes log-count ratio between toxic and other labelled texts, and a logistic regression with
an L2 penalty is trained on the scaled features. The score is its probability on a
sample with as many documents of either kind as there are up to a bound; it is not calibrated to their share in the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.llm import base, scan

ORDERS = (4, 5, 6)
BITS = 20


@dataclass
class ToxicityModel:
    weights: np.ndarray  # bucket -> weight times log-count ratio
    bias: float
    threshold: float = 0.3


def features(col: pa.Array, used: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, bucket) pairs of a string column; only of buckets where ``used`` holds."""
    stream, off = scan.letter_stream(col)
    keys = []
    for n in ORDERS:
        b = scan.ngram_buckets(stream, off, n, BITS)
        at = np.flatnonzero(used[b] if used is not None else b < 1 << BITS)
        doc = np.searchsorted(off, at, "right") - 1
        keys.append(doc.astype(np.int64) << BITS | b[at])
    key = np.concatenate(keys)
    key.sort()
    key = key[np.concatenate([[True], key[1:] != key[:-1]])] if len(key) else key
    return key >> BITS, (key & ((1 << BITS) - 1)).astype(np.int32)


def fit_texts(texts: list[str], toxic: list[int], least: int = 4, ratio: float = 1.5, steps: int = 200, penalty: float = 1e-3) -> ToxicityModel:
    """N-grams in under ``least`` texts or with a log-count ratio below ``ratio`` carry no
    weight. Without texts of both kinds the score is the share of toxic ones for all."""
    y = np.array(toxic, np.float64)
    empty = np.zeros(1 << BITS, np.float32)
    if not len(y) or y.min() == y.max():
        share = (y.sum() + 0.5) / (len(y) + 1) if len(y) else 0.0
        return ToxicityModel(empty, float(np.log(max(share, 1e-6) / max(1 - share, 1e-6))))
    # two passes over the sample, so that only the few n-grams that carry weight are held
    parts = range(0, len(texts), 128)
    batch = lambda lo: pa.array(texts[lo : lo + 128], pa.large_string())
    pos, neg = np.zeros(1 << BITS), np.zeros(1 << BITS)
    for lo in parts:
        d, b = features(batch(lo))
        bad = y[d + lo] == 1
        np.add.at(pos, b[bad], 1)
        np.add.at(neg, b[~bad], 1)
    # the share of documents with the n-gram, smoothed by a document of each kind
    r = np.log((pos + 1) / (y.sum() + 2)) - np.log((neg + 1) / ((1 - y).sum() + 2))
    r[(pos + neg < least) | (np.abs(r) < ratio)] = 0
    doc, bucket = [], []
    for lo in parts:
        d, b = features(batch(lo), np.append(r != 0, False))
        doc.append((d + lo).astype(np.int32))
        bucket.append(b)
    doc, bucket = np.concatenate(doc), np.concatenate(bucket)
    ids, col = np.unique(bucket, return_inverse=True)
    scale = r[ids]
    w, bias = np.zeros(len(ids)), float(np.log(y.mean() / (1 - y.mean())))
    # gradient descent with a step per weight (Adagrad), every step over all of the sample
    g2, b2 = np.full(len(ids), 1e-8), 1e-8
    for _ in range(steps):
        z = np.bincount(doc, (w * scale)[col], len(y)) + bias
        d = 1 / (1 + np.exp(-np.clip(z, -40, 40))) - y
        g = np.bincount(col, d[doc], len(ids)) * scale / len(y) + penalty * w
        g2 += g * g
        w -= 0.1 * g / np.sqrt(g2)
        gb = d.mean()
        b2 += gb * gb
        bias -= 0.1 * gb / np.sqrt(b2)
    out = empty.copy()
    out[ids] = w * scale
    return ToxicityModel(out, float(bias))


def fit(docs: DataFrame, labels: DataFrame, max_docs: int = 3000, max_bytes: int = 8 << 20) -> ToxicityModel:
    """Learn ``labels.toxic`` (1 if any label of a document says so) from the labelled
    documents that are not held out: at most ``max_docs`` and ``max_bytes`` of text of either
    kind, in the order of a hash of the id."""
    known = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~base.held_out("doc_id"))
        .groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    )
    known = base.stage(known, "toxicity-labels")
    texts, toxic = [], []
    for k in (0, 1):
        sample = base.sampled_texts(base.chosen(docs, known.where(F.col("toxic") == k), max_docs), max_docs, max_bytes)
        texts += [r["text"] for r in sample]
        toxic += [k] * len(sample)
    return fit_texts(texts, toxic)


def score_column(model: ToxicityModel, col: pa.Array) -> np.ndarray:
    used, out = np.append(model.weights != 0, False), np.zeros(len(col))
    for lo, part in base.passes(col):
        doc, bucket = features(part, used)
        z = np.bincount(doc, model.weights[bucket], len(part)) + model.bias
        out[lo : lo + len(part)] = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
    return out


def score(docs: DataFrame, model: ToxicityModel, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` and the score (0 to 1) of every whole text, and predicted
    (1 from the model's threshold on). Null and empty texts have no feature and get the
    score of the bias alone; repeated rows give repeated rows, an empty table none."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(*keep, F.col("text").alias("__text"))
    schema = rows.drop("__text").schema.add("score", "double").add("predicted", "integer")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = score_column(sent.value, b.column(len(keep)))
            yield base.frame_of(b.select(list(range(len(keep)))), score=s, predicted=(s >= sent.value.threshold).astype(np.int32))

    return rows.mapInArrow(base.tidy(run), schema)
