"""Entities without a search of every text for every pattern, and with its words taken once."""

from pyspark.sql import functions as F

from textmill.operators import entities as EN


def test_mentions_equal_a_search_for_every_pattern(spark):
    texts = ["Mail a.b@c.org or see https://x.org/y, call 555-123-4567.", "Costs €5, $1,000.50 or 12.5% on 2024-01-02.", "On May 3, 2020 and 1234567.",
             "The Apache License and the BSD License.", "Anna Maria met Bob Ray in New York.", "nothing here", "", "% $ @ :// License", "A+@ 1@b.co £7", None]
    d = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    plain = F.concat(*[F.transform(F.regexp_extract_all("text", F.lit(p), 0), EN._mention_struct(lab)) for lab, p in EN.PATTERNS.items()])
    rows = d.select("text", EN.mentions_of("text").alias("a"), plain.alias("b")).collect()
    for r in rows:
        assert (r["a"] or []) == (r["b"] or []), r["text"]
    assert {m["raw_label"] for r in rows for m in r["a"] or []} == set(EN.PATTERNS)


def test_own_patterns_are_searched_as_given(spark):
    d = spark.createDataFrame([("at 5 percent, x 7",)], "text string")
    out = d.select(EN.mentions_of("text", {"PERCENT": "[0-9] percent", "X": "x [0-9]", "CARDINAL": EN.PATTERNS["CARDINAL"]}).alias("m")).first()["m"]
    assert [tuple(x) for x in out] == [("5 percent", "PERCENT"), ("x 7", "X")]


def test_only_sentences_with_mentions_are_scored(spark):
    d = spark.createDataFrame([("A good day. Bob Ray had a good, great and bad day. The worst.",)], "text string")
    out = d.select(EN.sentence_scores("text").alias("s")).first()["s"]
    assert [(x["i"], [m["name"] for m in x["m"]], x["v"]) for x in out] == [(1, ["Bob Ray"], 1 / 3)]


def test_categories_take_the_words_once(spark):
    d = spark.createDataFrame([(1, "The law and the court.\n" * 20), (2, "The law and the court."), (3, None)], "doc_id int, text string")
    out = EN.document_categories(d)
    assert out._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract_all") == 1
    assert {r["doc_id"]: r["categories"] for r in out.collect()} == {1: ["/Law & Government"], 2: [], 3: []}
