"""White space, tokens and language at a cost that a large corpus can bear."""

import time

from pyspark.sql import functions as F

from textmill.functions import lang as L
from textmill.functions import text as T


def points(spark):
    """Every code point of the first two planes but surrogates, and the last one."""
    return spark.createDataFrame([(chr(i),) for i in (*range(0xD800), *range(0xE000, 0x20000), 0x10FFFF)], "c string")


def test_java_class_and_trim_equal_the_pattern(spark):
    d = points(spark).select("c", F.concat(F.lit("a"), "c", F.lit("b")).alias("mid"), F.concat("c", F.lit("x y"), "c", "c").alias("ends"))
    differs = d.where(
        (F.regexp_count("mid", F.lit(T.NON_WS_RUN)) != T.token_count("mid"))
        | (F.regexp_count("ends", F.lit(T.NON_WS_RUN)) != T.token_count("ends"))
        | (F.regexp_replace("ends", f"^{T.WS}+|{T.WS}+$", "") != T.ustrip("ends")))
    assert differs.count() == 0
    assert d.where(T.ustrip("c") == "").count() == len(T.WS_CHARS) == 29


def test_tokens_are_counted_faster_than_by_the_negated_class(spark):
    d = spark.range(0, 64, 1, 1).select(F.repeat(F.concat(F.col("id").cast("string"), F.lit("abcdef ghijkl ")), 8_000).alias("text"))

    def seconds(count):
        begin = time.perf_counter()
        d.select(count.alias("n")).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - begin

    plain = F.regexp_count("text", F.lit(T.NON_WS_RUN))
    assert min(seconds(T.token_count("text")) for _ in range(3)) < 0.6 * min(seconds(plain) for _ in range(2))


def test_language_reads_its_text_once(spark):
    d = spark.createDataFrame([(1, "the cat and the dog"), (2, "der Hund und die Katze"), (3, "123"), (4, None), (5, "the le")], "id int, text string")
    out = d.select("id", L.detect_language(F.regexp_replace("text", "marker_once", "x")).alias("lang"))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("marker_once") == 1
    assert {r["id"]: r["lang"] for r in out.collect()} == {1: "en", 2: "de", 3: None, 4: None, 5: "en"}


def plain_whitespace(text):
    t = F.regexp_replace(F.col(text), r"\r\n|\r", "\n")
    return T.ustrip(F.regexp_replace(F.regexp_replace(t, r"[ \t]+", " "), r"\n{3,}", "\n\n"))


def test_white_space_equals_the_plain_patterns(spark):
    import itertools

    runs = ["".join(p) for n in range(6) for p in itertools.product(" \t\r\n", repeat=n)]
    texts = [None, "", "$1 \\ $0", *(a + r + b for r in runs for a, b in (("", ""), ("a", "b"), ("\u00e9 ", "\U0001F600")))]
    d = spark.createDataFrame([(t,) for t in texts], "text string")
    differs = d.where(~T.normalize_whitespace("text").eqNullSafe(plain_whitespace("text")))
    assert differs.count() == 0 and d.count() == len(texts) > 4000


def test_white_space_of_clean_texts_costs_little(spark):
    d = spark.range(0, 64, 1, 1).select(F.repeat(F.concat(F.col("id").cast("string"), F.lit("abcd efg hijk ")), 8_000).alias("text"))

    def seconds(out):
        begin = time.perf_counter()
        d.select(F.length(out).alias("n")).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - begin

    assert min(seconds(T.normalize_whitespace("text")) for _ in range(3)) < 0.6 * min(seconds(plain_whitespace("text")) for _ in range(2))
