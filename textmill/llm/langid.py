"""Language identification by averaged hashed subword embeddings and a linear softmax.

A text is a bag of hashed subwords (byte 2- to 4-grams of its letters, with blanks at word
ends). The mean of their embeddings goes through a linear softmax; both are trained by
stochastic gradient descent in numpy on a bounded sample of documents and of their single
lines. A temperature and a rejection threshold are set on documents left out of the descent.
For scoring, embeddings and weights are multiplied out once, so a whole text costs one table
look-up per subword.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textmill.llm import base, scan

ORDERS = (2, 3, 4)
BITS = 16
UNKNOWN = "und"
MAX_TEXT_BYTES = 1 << 20  # longer texts are not trained on


@dataclass
class LanguageModel:
    languages: list[str]
    logits: np.ndarray  # bucket (and a last one that holds nothing) x language: embedding times weights
    bias: np.ndarray
    temperature: float
    threshold: float  # smallest score that is not rejected


def streams(col: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The letter streams of a string column, and whether each text has a letter."""
    stream, off = scan.letter_stream(col, digits=False)
    ascii_letter = (stream >= ord("a")) & (stream <= ord("z"))
    has = np.add.reduceat(ascii_letter.astype(np.int32), off[:-1]) > 0 if len(off) > 1 else np.zeros(0, bool)
    for i in np.flatnonzero(~has):  # other scripts, or no letter at all
        text = col[int(i)].as_py()
        has[i] = bool(text) and any(c.isalpha() for c in text)
    return stream, off, has


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def mean_logits(model: LanguageModel, col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    stream, off, has = streams(col)
    if not len(col) or not model.languages:
        return np.zeros((len(col), len(model.languages))), has
    z, n = 0.0, 0
    for order in ORDERS:
        bucket = scan.ngram_buckets(stream, off, order, BITS)
        z = z + np.stack([np.add.reduceat(x[bucket], off[:-1]) for x in model.logits.T], axis=1)
        n = n + np.maximum(np.diff(off) - order + 1, 0)
    return z / np.maximum(n, 1)[:, None] + model.bias, has


def _bags(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    out = []
    for lo in range(0, len(texts), 256):
        stream, off, _ = streams(pa.array(texts[lo : lo + 256], pa.large_string()))
        doc = np.repeat(np.arange(len(off) - 1), np.diff(off))
        key = np.concatenate([doc << (BITS + 1) | scan.ngram_buckets(stream, off, n, BITS) for n in ORDERS])
        key, n = np.unique(key[key & (1 << BITS) == 0], return_counts=True)
        cut = np.searchsorted(key >> (BITS + 1), np.arange(len(off)))
        out += [((key[a:b] & ((1 << BITS) - 1)).astype(np.int32), n[a:b].astype(np.float32)) for a, b in zip(cut, cut[1:])]
    return out


def fit_texts(texts: list[str], langs: list[str], dims: int = 8, epochs: int = 3, rate: float = 1.0, seed: int = 1, reject: float = 0.001) -> LanguageModel:
    """Train on whole texts and their lines; every tenth text of a language only calibrates.

    ``reject`` is the share of rightly labelled calibration texts that the threshold may turn
    away. Without any text the model knows no language and rejects everything."""
    names = sorted(set(langs))
    if not names:
        return LanguageModel([], np.zeros(((1 << BITS) + 1, 0)), np.zeros(0), 1.0, 1.0)
    y_of = {x: i for i, x in enumerate(names)}
    fit_x, fit_y, cal_x, cal_y = [], [], [], []
    seen: Counter = Counter()
    for text, lang in zip(texts, langs):
        seen[lang] += 1
        if seen[lang] % 10 == 0:
            cal_x.append(text)
            cal_y.append(y_of[lang])
            continue
        lines = [x for x in text.split("\n") if len(x) > 20]
        for x in [text, *(lines if len(lines) > 1 else [])]:
            fit_x.append(x)
            fit_y.append(y_of[lang])
    bags, y = _bags(fit_x), np.array(fit_y)
    rng = np.random.default_rng(seed)
    emb = rng.normal(0, 0.1, (1 << BITS, dims)).astype(np.float32)
    w = np.zeros((dims, len(names)), np.float32)
    bias = np.zeros(len(names), np.float32)
    ok = np.array([len(b[0]) > 0 for b in bags], bool)
    weight = 1 / np.maximum(np.bincount(y, minlength=len(names)), 1)  # languages weigh alike
    weight = (weight / weight[y].mean()).astype(np.float32)
    steps = max(1, epochs * (int(ok.sum()) // 32 + 1))
    done = 0
    for _ in range(epochs):
        order = rng.permutation(np.flatnonzero(ok))
        for lo in range(0, len(order), 32):
            now = rate * (1 - done / steps)
            done += 1
            take = order[lo : lo + 32]
            ids = np.concatenate([bags[i][0] for i in take])
            c = np.concatenate([bags[i][1] / bags[i][1].sum() for i in take])
            at = np.cumsum([0, *(len(bags[i][0]) for i in take[:-1])])
            m = np.add.reduceat(emb[ids] * c[:, None], at)
            p = softmax(m @ w + bias)
            p[np.arange(len(take)), y[take]] -= 1
            p *= weight[y[take]][:, None]
            g = p @ w.T
            w -= now * m.T @ p / len(take) * 8
            bias -= now * p.mean(0)
            # the embeddings of a bucket take the sum of its documents' steps
            change = now * 8 * c[:, None] * np.repeat(g, np.diff([*at, len(ids)]), axis=0)
            for k in range(dims):
                emb[:, k] -= np.bincount(ids, change[:, k], 1 << BITS)
    logits = np.zeros(((1 << BITS) + 1, len(names)))
    logits[:-1] = emb @ w
    model = LanguageModel(names, np.asfortranarray(logits), bias.astype(np.float64), 1.0, 0.0)
    cal_x, cal_y = (cal_x, np.array(cal_y)) if cal_x else (texts, np.array([y_of[x] for x in langs]))
    z, has = mean_logits(model, pa.array(cal_x, pa.large_string()))
    z, cal_y = z[has], cal_y[has]
    if len(z):
        loss = lambda t: -np.log(softmax(z * t)[np.arange(len(z)), cal_y] + 1e-9).mean()
        model.temperature = min(2.0 ** np.arange(-3, 6), key=loss)
        p = softmax(z * model.temperature)
        right = p.max(1)[p.argmax(1) == cal_y]
        model.threshold = float(min(0.5, np.quantile(right, reject))) if len(right) else 0.0
    return model


#: Rows of a language and hash bucket that are ranked; Spark limits groups early up to 1000.
BUCKET = 500


def fit(docs: DataFrame, max_docs: int = 3000, max_bytes: int = 8 << 20) -> LanguageModel:
    """Learn from text and non-null lang of the documents that are not held out, in each
    language in the order of a hash of the id. ``max_docs`` documents and ``max_bytes`` of
    text are shared out evenly over the languages; what a rare one leaves goes to the others,
    and every language has a document at least."""
    rows = docs.select("doc_id", "text", "lang").where(F.col("lang").isNotNull() & ~base.held_out("doc_id") & (F.col("lang") != UNKNOWN))
    rows = rows.where(F.col("text").isNotNull() & (F.octet_length("text") <= MAX_TEXT_BYTES))
    key = F.xxhash64(F.col("doc_id").cast("string"), F.lit(7))
    # the smallest hashes of each language: first of each of its buckets, by a limit that Spark
    # applies within the map tasks, then of what is left, a bounded number
    sizes = rows.select("lang", "doc_id", key.alias("key"), F.octet_length("text").alias("n"))
    sizes = sizes.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(-(-2 * max_docs // BUCKET))))
    in_bucket = F.row_number().over(Window.partitionBy("lang", "bucket").orderBy("key", "doc_id"))
    sizes = sizes.withColumn("r", in_bucket).where(F.col("r") <= BUCKET)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("key", "doc_id"))
    sizes = sizes.withColumn("r", rank).where(F.col("r") <= max_docs)
    by_lang: dict[str, list] = {}
    for x in sizes.orderBy("lang", "r").collect():
        by_lang.setdefault(x["lang"], []).append(x)
    n_docs = shares({k: len(v) for k, v in by_lang.items()}, max_docs)
    n_bytes = shares({k: sum(x["n"] for x in v[: n_docs[k]]) for k, v in by_lang.items()}, max_bytes)
    ids = []
    for k, held in by_lang.items():
        total = 0
        for x in held[: max(1, n_docs[k])]:
            total += x["n"]
            if total > n_bytes[k] and total > x["n"]:  # the first is taken anyway
                break
            ids.append((x["doc_id"], k))
    if not ids:
        return fit_texts([], [])
    wanted = docs.sparkSession.createDataFrame(ids, rows.select("doc_id", "lang").schema).distinct()
    sample = rows.join(F.broadcast(wanted), ["doc_id", "lang"], "left_semi").groupBy("doc_id", "lang").agg(F.min("text").alias("text")).orderBy(key, "doc_id", "lang").collect()
    return fit_texts([x["text"] for x in sample], [x["lang"] for x in sample])


def shares(held: dict[str, int], total: int) -> dict[str, int]:
    """``total`` shared out evenly, to none more than it holds."""
    out, left = {}, total
    for i, k in enumerate(sorted(held, key=lambda k: (held[k], k))):
        out[k] = min(held[k], left // (len(held) - i))
        left -= out[k]
    return out


def predict_column(model: LanguageModel, col: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    lang, score = np.full(len(col), UNKNOWN, object), np.zeros(len(col))
    for lo, part in base.passes(col):
        z, has = mean_logits(model, part)
        if model.languages and len(part):
            p = softmax(z * model.temperature)
            lang[lo : lo + len(part)][has] = np.array(model.languages, object)[p.argmax(1)[has]]
            score[lo : lo + len(part)][has] = p.max(1)[has]
    return lang, score, (lang == UNKNOWN) | (score < model.threshold)


def identify(docs: DataFrame, model: LanguageModel, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` of ``docs`` and lang_pred, score, rejected for every whole text.

    Null texts and texts without a letter are ``und`` with score 0 and rejected; the others
    get a learned language, and are rejected when their score is below the calibrated
    threshold. Repeated rows give repeated rows; an empty table gives none. Columns of
    ``docs`` that are not in ``keep`` play no part."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(model)
    rows = docs.select(*keep, F.col("text").alias("__text"))
    schema = rows.drop("__text").schema.add("lang_pred", "string").add("score", "double").add("rejected", "boolean")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lang, score, rejected = predict_column(sent.value, b.column(len(keep)))
            yield base.frame_of(b.select(list(range(len(keep)))), lang_pred=pa.array(lang, pa.string()), score=score, rejected=rejected)

    return rows.mapInArrow(base.tidy(run), schema)
