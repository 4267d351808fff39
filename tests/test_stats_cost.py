"""Corpus statistics take each text once, and the helpers they use are the plain ones' equals."""

from pyspark.sql import functions as F

from textmill.functions import text as T
from textmill.operators import stats as D


def test_histogram_evaluates_its_column_once_a_row(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def value(i):
        seen.add(1)
        return None if i % 10 == 9 else float(i % 7)

    h = D.histogram(spark.range(0, 100, 1, 4).select(value("id").alias("v")), "v", 3).orderBy("bin").collect()
    want = [i % 7 for i in range(100) if i % 10 != 9]
    assert [r.n for r in h] == [sum(lo <= x < lo + 2 for x in want) for lo in (0, 2)] + [sum(x >= 4 for x in want)]
    assert (h[0].lo, h[-1].hi) == (0.0, 6.0) and seen.value == 100


def test_histogram_of_nothing_keeps_its_bins(spark):
    h = D.histogram(spark.createDataFrame([(None,), (None,)], "v double"), "v", 2).orderBy("bin").collect()
    assert [(r.bin, r.lo, r.hi, r.n) for r in h] == [(0, None, None, 0), (1, None, None, 0)]


def test_lead_sentences_are_the_first_of_the_whole_text(spark):
    edge = T.LEAD_CHARS
    texts = [None, "", " \n\t", "One. Two! Three? Four. Five.", "no end", "... !!! \n\n ??? a", "e@x.org 3.14 ok. b\nc\n\n\nd. e"]
    texts += ["x" * k + end + "b. c d\n\n e? f. g" for k in (1, edge // 2, edge * 2) for end in (". ", "\n", "...  \n ", "! ")]
    # sentence ends, runs of them and of blanks, and characters of two units on both sides of the edge
    texts += ["A. B. C. " + "\U0001F600" * (edge - 9 - k) + end + "z. y. x" for k in range(6) for end in (". ", "..  \n", " \n ", ".a ", "")]
    texts += ["A. " + "w" * (edge - 3 - k) + end + "z. y. x" for k in range(-3, 6) for end in (". ", "..  \n", " \n ", ".a ", "")]
    d = spark.createDataFrame([(t,) for t in texts], "text string")
    for n in (1, 3):
        rows = d.select("text", T.lead_sentences("text", n).alias("lead"), F.slice(T.sentences("text"), 1, n).alias("whole")).collect()
        assert [r.text for r in rows if r.lead != r.whole] == []


def test_summary_tokens_of_a_null_stay_null(spark):
    d = spark.createDataFrame([("a b.", None), ("a", "x y z"), ("", "")], "text string, reference_summary string")
    rows = [(r.char_count, r.sent_count, r.summary_token_count) for r in D.doc_lengths(d).collect()]
    assert rows == [(4, 1, None), (1, 0, 3), (0, 0, 0)]


def test_summary_is_evaluated_once_for_its_tokens(spark):
    d = spark.createDataFrame([("a b. c",)], "text string").withColumn("reference_summary", F.regexp_replace("text", "marker_once", "x"))
    plan = D.doc_lengths(d).select("summary_token_count")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("marker_once") == 1


def test_content_words_equal_the_plain_way(spark):
    texts = [None, "", "The THE the cat\u212aat -- it's caf\u00e9 abc_def Abc12 abc", "was will WILL you not who WHICH which ones", "\u0130stanbul ist\u0131l abc\u0301def"]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    plain = F.transform(F.regexp_extract_all("text", F.lit(D.WORD3_PATTERN), 0), lambda w: F.lower(w))
    stop = F.array(*[F.lit(w) for w in D.EDA_STOPWORDS])
    want = d.select("doc_id", F.filter(plain, lambda w: ~F.array_contains(stop, w)).alias("toks"))
    assert D.content_tokens(d).collect() == want.collect()
    counts = want.select(F.explode("toks").alias("word")).groupBy("word").count()
    assert sorted(D.word_counts(d).collect()) == sorted(counts.collect()) != []


def test_stopwords_are_no_array_that_is_searched_for_every_word(spark):
    d = spark.createDataFrame([(1, "The cat")], "doc_id long, text string")
    for out in (D.content_tokens(d), D.word_counts(d)):
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert "array_contains" not in plan and " INSET " in plan
