import hashlib

import pytest
from pyspark.sql import functions as F

from textmill.functions import text as T
from textmill.functions import lang as LANG


def one(spark, col, value):
    return spark.createDataFrame([(value,)], "text string").select(col.alias("x")).first()["x"]


@pytest.mark.parametrize("raw,expected", [
    ("line1\r\nline2", "line1\nline2"),
    ("a\rb", "a\nb"),
    ("a   b", "a b"),
    ("a\t\tb", "a b"),
    ("a\n\n\n\nb", "a\n\nb"),
    ("a\n\nb", "a\n\nb"),
    ("  hello  ", "hello"),
    ("  x  ", "x"),
])
def test_normalize_whitespace(spark, raw, expected):
    assert one(spark, T.normalize_whitespace("text"), raw) == expected


@pytest.mark.parametrize("raw,n", [
    ("hello world foo", 3), ("", 0), ("word", 1), ("  a  b  ", 2), ("a\nb\nc", 3),
    ("a b c\x1cd  e", 5),
])
def test_token_count(spark, raw, n):
    assert one(spark, T.token_count("text"), raw) == n


def test_content_hash(spark):
    assert one(spark, T.content_hash("text"), "") == hashlib.sha256(b"").hexdigest()
    h = one(spark, T.content_hash("text"), "café")
    assert h == hashlib.sha256("café".encode()).hexdigest() and len(h) == 64


@pytest.mark.parametrize("s", ["abc", "é" * 10, "a€b€c", "x😀y😀z", "日本語テキスト"])
def test_truncate_bytes_matches_python(spark, s):
    for n in range(0, len(s.encode()) + 2):
        expected = s.encode()[:n].decode("utf-8", errors="ignore")
        assert one(spark, T.truncate_bytes("text", n), s) == expected, (s, n)


def test_sentences_and_words(spark):
    got = one(spark, T.sentences("text"), "One. Two!  Three?\n... four")
    assert got == ["One.", "Two!", "Three?", "four"]
    assert one(spark, T.words("text"), "Hello, World 42!") == ["hello", "world", "42"]


def test_language_vote(spark):
    assert one(spark, LANG.detect_language(F.col("text")), "the cat is on the mat and it was a hat") == "en"
    assert one(spark, LANG.detect_language(F.col("text")), "der Hund und die Katze sind nicht hier") == "de"
    assert one(spark, LANG.detect_language(F.col("text")), "xyz qqq") is None
    # only the first 500 characters are sampled
    assert one(spark, LANG.detect_language(F.col("text")), "x" * 1000 + " the and of") is None
