"""Indexed pattern search: the same rows as a scan, whatever the pattern."""

import random
import re

import pytest

from textmill.operators import search as Q
from textmill.operators import trigrams as T


def grams(*words):
    return tuple(sorted({int.from_bytes(b[k : k + 3]) for b in (w.encode() for w in words) for k in range(len(b) - 2)}))


@pytest.mark.parametrize("pattern,want", [
    ("license", [grams("license")]),
    ("License", [grams("license")]),
    ("schaft|ung", [grams("schaft"), grams("ung")]),
    ("th[a-z]*tion", [grams("tion")]),
    ("ción", [grams("ción")]),
    ("ab(cd|ef)gh", [grams("abcdgh"), grams("abefgh")]),
    ("(abc)+def", [grams("abc", "def")]),
    ("abcx?def", [grams("abc", "def")]),
    ("abcx{2,}def", [grams("abcx", "def")]),
    (r"foo\.bar", [grams("foo.bar")]),
    (r"\bword\b", [grams("word")]),
    ("^begin", [grams("begin")]),
    ("(?:one|two) three", [grams("one three"), grams("two three")]),
    ("abc.def", [grams("abc", "def")]),
])
def test_trigrams_that_a_match_must_hold(pattern, want):
    assert T.required(pattern) == sorted(want)


@pytest.mark.parametrize("pattern", ["[0-9]+", "ab", "abc|x", "(?i)abcdef", r"\Qabc\E", r"(abc)\1", "abc++d", "[a[bcd]]efg", "[a&&b]cdef", r"\p{L}abc", "(?<=abc)def", "(abc)?", r"a\x41bcd"])
def test_patterns_that_are_scanned(pattern):
    assert T.required(pattern) is None


def texts():
    r = random.Random(4)
    words = ["alpha", "beta", "license", "lizenz", "ción", "Über", "ung", "schaft", "the", "nation", "a", "9"]
    return [(i, " ".join(r.choice(words) + r.choice(["", "", "x", "."]) for _ in range(r.randint(0, 30)))) for i in range(400)] + [(900, None), (901, ""), (902, "ab"), (3, "license twice")]


PATTERNS = ["license", "schaft|ung", "(alpha|beta)x license", "th[a-z]* nation", "ción", "über", "[0-9]+", "licensex?\\. the", "absent words", "a.{0,3}ung", "(the )+alpha"]


@pytest.mark.parametrize("block", [7, 32_768])
def test_the_index_finds_what_a_scan_finds(spark, monkeypatch, block):
    monkeypatch.setattr(T, "BLOCK", block)
    monkeypatch.setattr(T, "PASS_BYTES", 300)
    docs = spark.createDataFrame(texts(), "doc_id long, text string").repartition(3)
    index = T.build_index(docs)
    for p in PATTERNS:
        want = sorted((r["doc_id"], r["score"], r["snippet"]) for r in Q.match_score(docs, p).collect())
        assert sorted((r["doc_id"], r["score"], r["snippet"]) for r in T.match_score(index, p).collect()) == want
        assert T.search_documents(index, p, 5).collect() == Q.search_documents(docs, p, 5).collect()
    # and reads no more than what holds the trigrams
    low = [t.lower() for _, t in texts() if t is not None]
    report = {r["qid"]: r for r in T.search_report(index, {p: p for p in PATTERNS}).collect()}
    for p in PATTERNS:
        sets = T.required(p)
        held = [t for t in low if sets is None or any(set(s) <= set(grams(t)) for s in sets)]
        assert (report[p]["n_texts"], report[p]["n_read"], report[p]["n_matched"]) == (len(low), len(held), sum(bool(re.search(p, t)) for t in low))


def test_a_pattern_with_too_many_candidates_is_scanned(spark, monkeypatch):
    monkeypatch.setattr(T, "BLOCK", 10)
    monkeypatch.setattr(T, "BLOCKS", 3)
    index = T.build_index(spark.createDataFrame([(i, "common text") for i in range(100)], "doc_id long, text string").repartition(4))
    assert T.survivors(index, "common").count() == 100 and T.match_score(index, "common").count() == 100
    empty = T.build_index(spark.createDataFrame([], "doc_id long, text string"))
    assert T.match_score(empty, "common").count() == 0


def test_bad_patterns_are_refused(spark):
    index = T.build_index(spark.createDataFrame([(1, "x")], "doc_id long, text string"))
    for p in ("", "a*", "("):
        with pytest.raises(ValueError):
            T.match_score(index, p)
