"""Quality by ordinal cumulative-link regression on graded ratings.

A text is the frequencies of its hashed byte n-grams (case, digits and marks as they are).
One weight per bucket, shared by all grades, gives a text's place on a line; ordered
thresholds cut the line into grades: P(grade <= k) = logistic(threshold[k] - place). Weights
and thresholds are fitted together to the log-likelihood. The model gives the expected grade
and the probability of a grade from a limit on, by which documents are selected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.llm import base, scan

ORDERS = (2, 3)
BITS = 17
SCALE = 30.0
MOST = 10  # the largest grade


@dataclass
class GradeModel:
    weights: np.ndarray  # per bucket, and a last one that holds nothing
    thresholds: np.ndarray  # ascending; one less than grades


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def places(weights: np.ndarray, col: pa.Array) -> np.ndarray:
    """Where the texts lie on the model's line; without an n-gram at 0."""
    data, off = scan.flat(col)
    z, n = np.zeros(len(col)), np.zeros(len(col))
    held = np.flatnonzero(np.diff(off))
    if len(held):
        for order in ORDERS:
            bucket = scan.ngram_buckets(data, off, order, BITS)
            z[held] += np.add.reduceat(weights[bucket], off[held])
            n += np.maximum(np.diff(off) - order + 1, 0)
    return SCALE * z / np.maximum(n, 1)


def fit_texts(texts: list[str], grades: list[int], steps: int = 150, penalty: float = 1e-5) -> GradeModel:
    """Fit on whole texts with grades from 0 on. Without texts there is one grade."""
    weights = np.zeros((1 << BITS) + 1)
    if not texts:
        return GradeModel(weights, np.zeros(0))
    y, top = np.array(grades), max(grades)
    doc, bucket, value = [], [], []
    for lo in range(0, len(texts), 256):
        data, off = scan.flat(pa.array(texts[lo : lo + 256], pa.large_string()))
        d = np.repeat(np.arange(len(off) - 1), np.diff(off))
        key = np.concatenate([d << (BITS + 1) | scan.ngram_buckets(data, off, n, BITS) for n in ORDERS])
        key, n = np.unique(key[key & (1 << BITS) == 0], return_counts=True)
        d = key >> (BITS + 1)
        doc.append(d + lo)
        bucket.append(key & ((1 << BITS) - 1))
        value.append(SCALE * n / np.bincount(d, n, len(off) - 1)[d])
    doc, bucket, value = np.concatenate(doc), np.concatenate(bucket), np.concatenate(value)
    share = np.cumsum(np.bincount(y, minlength=top + 1))[:-1] / len(y)
    cut = np.log((share + 1e-3) / (1 - share + 1e-3))
    gaps = np.log(np.maximum(np.diff(cut), 0.1))  # thresholds stay ordered: first, then exp(gap) apart
    first = cut[:1].copy()
    w2, c2, g2 = np.full(1 << BITS, 1e-10), 1e-8, np.full(len(gaps), 1e-8)
    w = np.zeros(1 << BITS)
    for _ in range(steps if top else 0):
        cut = np.concatenate([first, first + np.cumsum(np.exp(gaps))])
        s = np.bincount(doc, w[bucket] * value, len(y))
        edge = np.concatenate([[-np.inf], cut, [np.inf]])
        hi, lo = logistic(edge[y + 1] - s), logistic(edge[y] - s)
        p = np.maximum(hi - lo, 1e-9)
        ds = 1 - hi - lo  # of the negative log-likelihood
        g = np.bincount(bucket, ds[doc] * value, 1 << BITS) / len(y) + penalty * w
        w2 += g * g
        w -= 0.1 * g / np.sqrt(w2)
        up, down = hi * (1 - hi) / p, lo * (1 - lo) / p
        dcut = np.array([(down[y == k + 1].sum() - up[y == k].sum()) / len(y) for k in range(top)])
        c2 += dcut.sum() ** 2
        first = first - 0.1 * dcut.sum() / np.sqrt(c2)
        dg = np.array([dcut[k + 1 :].sum() * np.exp(gaps[k]) for k in range(len(gaps))])
        g2 += dg * dg
        gaps = gaps - 0.1 * dg / np.sqrt(g2)
    weights[:-1] = w
    return GradeModel(weights, np.concatenate([first, first + np.cumsum(np.exp(gaps))]) if top else np.zeros(0))


def ratings(labels: DataFrame) -> DataFrame:
    """(doc_id, grade) of labelled documents: 0 of poor quality, 1 good but toxic, 2 good.
    A document labelled more than once has its lowest grade; a null toxic counts as 0."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
    grade = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).otherwise(2)
    return known.select("doc_id", grade.alias("grade")).groupBy("doc_id").agg(F.min("grade").alias("grade"))


def fit(docs: DataFrame, rated: DataFrame, max_docs: int = 1500, max_bytes: int = 6 << 20) -> GradeModel:
    """Learn from the rated documents that are not held out: at most ``max_docs`` and
    ``max_bytes`` of text of each grade, in the order of a hash of the id. Grades are whole
    numbers from 0 to ``MOST``; others are refused. A null grade is no rating."""
    rated = base.stage(rated.where(F.col("grade").isNotNull() & ~base.held_out("doc_id")), "grades-rated")
    held = sorted(r["grade"] for r in rated.select("grade").distinct().limit(MOST + 2).collect())
    if wrong := [k for k in held if k not in range(MOST + 1)]:
        raise ValueError(f"grades are whole numbers from 0 to {MOST}, not {wrong[:3]}")
    texts, grades = [], []
    for k in map(int, held):
        sample = base.sampled_texts(base.chosen(docs, rated.where(F.col("grade") == k), max_docs), max_docs, max_bytes)
        texts += [r["text"] for r in sample]
        grades += [k] * len(sample)
    return fit_texts(texts, grades)


def grade_column(model: GradeModel, col: pa.Array, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Expected grade and P(grade >= limit) of every text."""
    s = np.zeros(len(col))
    for lo, part in base.passes(col):
        s[lo : lo + len(part)] = places(model.weights, part)
    above = 1 - logistic(model.thresholds[None, :] - s[:, None])  # P(grade > k)
    if limit <= 0 or not len(model.thresholds):
        return above.sum(axis=1), np.full(len(col), float(limit <= 0))
    return above.sum(axis=1), above[:, limit - 1] if limit <= len(model.thresholds) else np.zeros(len(col))


def grade(docs: DataFrame, model: GradeModel, limit: int = 1, least: float = 0.5, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep``, expected_grade, tail (the probability of a grade from ``limit``
    on) and kept (tail >= ``least``) of every whole text.

    Null texts, and texts too short for an n-gram, lie at 0 on the model's line; repeated rows
    give repeated rows; an empty table gives none."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(*keep, F.col("text").alias("__text"))
    schema = rows.drop("__text").schema.add("expected_grade", "double").add("tail", "double").add("kept", "boolean")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            expected, tail = grade_column(sent.value, b.column(len(keep)), limit)
            yield base.frame_of(b.select(list(range(len(keep)))), expected_grade=expected, tail=tail, kept=tail >= least)

    return rows.mapInArrow(base.tidy(run), schema)
