"""Scores of the classifiers against plain Python, one n-gram at a time."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest

from textmill.llm import base, grades, langid, toxicity

MASK = (1 << 64) - 1


def bucket(gram: bytes, bits: int) -> int:
    """The bucket of a byte n-gram: its bytes and length through two odd factors."""
    key = (int.from_bytes(gram) + (len(gram) << 60)) & MASK
    key = (key * 0x9E3779B97F4A7C15) & MASK
    key ^= key >> 29
    return ((key * 0xBF58476D1CE4E5B9) & MASK) >> (64 - bits)


def letters(text: str | None, digits: bool) -> bytes:
    """Letters (and digits) in lower case, all else one blank, with a blank before and after.
    Capitals of ASCII and of the Latin-1 supplement are lowered."""
    out = " "
    for c in (text or "") + " ":
        if c.isascii():
            c = c.lower() if c.isalpha() or digits and c.isdigit() else " "
        elif "À" <= c <= "Þ" and c != "×":
            c = c.lower()
        out += "" if c == " " and out[-1] == " " else c
    return out.encode()


def ngrams(data: bytes, orders, bits: int) -> list[int]:
    return [bucket(data[k : k + n], bits) for n in orders for k in range(len(data) - n + 1)]


def logistic(x: float) -> float:
    return 1 / (1 + math.exp(-x))


def texts():
    r = random.Random(4)
    words = ["the", "Café", "ÜBER", "straße", "a1b2", "99", "don't", "日本語", "x", "Mañana", "und", "no!", "×", "ok\n\n"]
    return [" ".join(r.choice(words) for _ in range(r.randint(0, 25))) for _ in range(80)] + ["", None, "a", "  \t ", "12 34"]


TEXTS = texts()


def test_toxicity_scores():
    rng = np.random.default_rng(1)
    weights = rng.normal(size=1 << toxicity.BITS).astype(np.float32)
    weights[rng.random(len(weights)) < 0.5] = 0
    got = toxicity.score_column(toxicity.ToxicityModel(weights, -0.25), pa.array(TEXTS, pa.string()))
    for text, score in zip(TEXTS, got):
        held = set(ngrams(letters(text, True), toxicity.ORDERS, toxicity.BITS))  # each n-gram once
        assert score == pytest.approx(logistic(sum(float(weights[b]) for b in held) - 0.25), abs=1e-9)


def test_toxicity_ratios_are_naive_bayes_log_count_ratios():
    """With one n-gram set in all toxic texts and no other in either kind often enough, only
    its buckets carry weight, and with the sign of their ratio."""
    toxic = [f"zzqq {i}" for i in range(30)]
    clean = [f"plain {i}" for i in range(30)]
    model = toxicity.fit_texts(toxic + clean, [1] * 30 + [0] * 30)
    used = set(np.flatnonzero(model.weights))
    want = set()
    for b in {b for t in toxic + clean for b in ngrams(letters(t, True), toxicity.ORDERS, toxicity.BITS)}:
        pos, neg = (sum(b in set(ngrams(letters(t, True), toxicity.ORDERS, toxicity.BITS)) for t in kind) for kind in (toxic, clean))
        ratio = math.log((pos + 1) / 32) - math.log((neg + 1) / 32)
        if pos + neg >= 4 and abs(ratio) >= 1.5:
            want.add(b)
            assert model.weights[b] * ratio > 0
    assert used == want


def test_grade_scores():
    rng = np.random.default_rng(2)
    weights = np.append(rng.normal(size=1 << grades.BITS), 0.0)
    model = grades.GradeModel(weights, np.array([-1.0, 0.5, 2.0]))
    expected, tail = grades.grade_column(model, pa.array(TEXTS, pa.string()), 2)
    for text, e, t in zip(TEXTS, expected, tail):
        held = ngrams((text or "").encode(), grades.ORDERS, grades.BITS)
        place = grades.SCALE * sum(weights[b] for b in held) / max(len(held), 1)
        above = [1 - logistic(max(min(c - place, 40), -40)) for c in model.thresholds]
        assert e == pytest.approx(sum(above), abs=1e-9) and t == pytest.approx(above[1], abs=1e-9)


def test_language_scores():
    rng = np.random.default_rng(3)
    logits = np.vstack([rng.normal(size=(1 << langid.BITS, 3)), np.zeros((1, 3))])
    model = langid.LanguageModel(["aa", "bb", "cc"], np.asfortranarray(logits), np.array([0.1, 0.0, -0.1]), 2.0, 0.6)
    lang, score, rejected = langid.predict_column(model, pa.array(TEXTS, pa.string()))
    for text, name, s, out in zip(TEXTS, lang, score, rejected):
        if not text or not any(c.isalpha() for c in text):
            assert (name, s, out) == ("und", 0.0, True)
            continue
        held = ngrams(letters(text, False), langid.ORDERS, langid.BITS)
        z = [2.0 * (sum(logits[b, k] for b in held) / max(len(held), 1) + model.bias[k]) for k in range(3)]
        p = [math.exp(x) / sum(map(math.exp, z)) for x in z]
        assert name == model.languages[p.index(max(p))] and s == pytest.approx(max(p), abs=1e-9) and out == (max(p) < 0.6)


def test_training_ids_are_chosen_among_the_documents_there(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(0, 3000, 50)], "doc_id long, text string")
    known = spark.createDataFrame([(i,) for i in range(3000)], "doc_id long")
    got = {r["doc_id"] for r in base.chosen(docs, known, 40).collect()}
    assert len(got) == 40 and all(i % 50 == 0 for i in got)  # a limit on labels alone would leave one or two
