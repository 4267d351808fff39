import pytest
from pyspark.sql import functions as F

from textmill.functions import text as T
from textmill.operators import aggregate as A
from textmill.operators import entities as EN
from textmill.operators import search as Q


def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string")


def test_match_count_is_non_overlapping(spark):
    out = Q.search_documents(docs(spark, [(1, "aaaa"), (2, "xaax"), (3, "zzz")]), "aa", top_k=5).collect()
    assert [(r.doc_id, r.score) for r in out] == [(1, 2), (2, 1)]


def test_search_case_insensitive_snippet_and_empty(spark):
    d = docs(spark, [(1, "Hello " + "x" * 400)])
    r = Q.search_documents(d, "HELLO", top_k=1).first()
    assert r.score == 1 and len(r.snippet) == 300
    assert Q.search_documents(d, "absent", top_k=3).count() == 0


@pytest.mark.parametrize("k", [0, 11, -1])
def test_top_k_bounds(spark, k):
    with pytest.raises(ValueError):
        Q.search_documents(docs(spark, [(1, "a")]), "a", top_k=k)


def test_pattern_validation(spark):
    for bad in ("", "x*", "("):
        with pytest.raises(ValueError):
            Q.search_documents(docs(spark, [(1, "a")]), bad)


def test_top_k_plan_is_take_ordered(spark):
    plan = Q.search_documents(docs(spark, [(1, "a")]), "a", 3)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_search_batch_top_k_per_query(spark):
    d = docs(spark, [(i, "ab " * i) for i in range(1, 8)])
    out = Q.search_batch(d, {"a": "ab", "b": "b a"}, top_k=2).orderBy("qid", "rank").collect()
    assert [(r.qid, r.doc_id) for r in out] == [("a", 7), ("a", 6), ("b", 7), ("b", 6)]


def test_label_map(spark):
    df = spark.createDataFrame([("ORG",), ("GPE",), ("NORP",), ("XYZ",)], "l string")
    got = [r.t for r in df.select(EN.label_type("l").alias("t")).collect()]
    assert got == ["ORGANIZATION", "LOCATION", "ORGANIZATION", "OTHER"]


def test_mentions_dedupe_and_salience(spark):
    text = "Mail bob@example.com now. Again bob@example.com and Apache License rules. Call 555-123-4567."
    ents = EN.extract_entities(docs(spark, [(1, text)])).collect()
    by = {(e.entity_name, e.raw_label): e for e in ents}
    assert by[("bob@example.com", "EMAIL")].n_mentions == 2
    assert ("Apache License", "LAW") in by and ("555-123-4567", "PHONE") in by
    assert abs(sum(e.salience for e in ents) - 1.0) < 1e-3
    frame = EN.entity_salience(EN.dedupe_mentions(EN.extract_mentions(docs(spark, [(1, text)])))).collect()
    assert {(r.name, r.n_mentions) for r in frame} == {(e.entity_name, e.n_mentions) for e in ents}


def test_gazetteer(spark):
    gz = spark.createDataFrame([("General Public License", "LAW"), ("France", "GPE")], "name string, raw_label string")
    out = EN.extract_gazetteer(docs(spark, [(1, "GNU General  Public License in FRANCE.")]), gz).collect()
    assert {(r.name, r.raw_label) for r in out} == {("General Public License", "LAW"), ("FRANCE", "GPE")}


def entity_rows(spark, rows):
    return spark.createDataFrame(
        [(d, n, t, s, "pattern") for d, n, t, s in rows],
        "doc_id bigint, entity_name string, entity_type string, sentiment_score double, extractor string",
    ).withColumn("extracted_at", F.current_timestamp())


def test_aggregate_frequency_and_mean(spark):
    e = entity_rows(spark, [(1, "Google", "ORGANIZATION", 0.5), (2, "Google", "ORGANIZATION", 0.3),
                            (1, "CEO", "PERSON", 0.0), (1, "A", None, 0.4), (2, "A", None, 0.6), (2, "N", None, None)])
    ids = spark.createDataFrame([(1,), (2,)], "doc_id bigint")
    top = A.aggregate_entities(e, ids, top_n=10).collect()
    assert top[0].entity_name == "A" and top[1].entity_name == "Google" and top[1].frequency == 2
    assert {r.entity_name: r.avg_sentiment for r in top}["A"] == 0.5
    assert {r.entity_name: r.entity_type for r in top}["A"] == "OTHER"
    assert {r.entity_name: r.avg_sentiment for r in top}["N"] == 0.0


def test_sentiment_distribution_on_sum(spark):
    e = entity_rows(spark, [(1, "P", None, 0.5), (1, "M", None, -0.5), (1, "Z", None, 0.0),
                            (1, "E", None, 0.1), (2, "E", None, 0.0)])
    ids = spark.createDataFrame([(1,), (2,), (2,), (99,)], "doc_id bigint")
    r = A.aggregate_entities_summary(e, ids).first()
    assert (r.doc_count, r.positive, r.negative, r.neutral) == (4, 1, 1, 2)


def test_top_n_bounds_and_empty_ids(spark):
    e = entity_rows(spark, [(1, f"n{i:02d}", None, 0.0) for i in range(20)])
    ids = spark.createDataFrame([(1,)], "doc_id bigint")
    assert A.aggregate_entities(e, ids, top_n=5).count() == 5
    with pytest.raises(ValueError):
        A.aggregate_entities(e, ids, top_n=51)
    with pytest.raises(ValueError):
        A.require_ids([])


@pytest.mark.parametrize("pattern", [r"\b", "(?=a)", r"a|\b", "x*", "$", ""])
def test_zero_width_patterns_are_rejected(spark, pattern):
    with pytest.raises(ValueError):
        Q.validate_pattern(pattern)


def test_patterns_are_read_in_the_dialect_that_runs_them(spark):
    assert Q.validate_pattern(r"a\h+b") == r"a\h+b"
    with pytest.raises(ValueError):
        Q.validate_pattern("(?P<n>a)")


def test_entities_beyond_the_first_ten_thousand_characters_count(spark):
    df = spark.createDataFrame([(1, "word " * 2500 + "write to john@good.com today.")], "doc_id bigint, text string")
    assert [r.name for r in EN.extract_mentions(df).collect()] == ["john@good.com"]
    assert [r.entity_name for r in EN.extract_entities(df).collect()] == ["john@good.com"]
    assert EN.extract_mentions(df, max_chars=EN.NER_CHARS).count() == 0
    assert EN.extract_entities(df, max_bytes=12_510).count() == 0


def test_dots_inside_names_end_no_sentence(spark):
    df = spark.createDataFrame([(1, "A good day for john@good.com at 3.5% growth. See https://bad.org/x.y? It was a crisis! JOHN@GOOD.COM said so.")], "doc_id bigint, text string")
    got = {(r.entity_name, r.raw_label): (r.sentiment_score, r.sentiment_magnitude) for r in EN.extract_entities(df).collect()}
    assert got[("3.5%", "PERCENT")] == (1.0, 1.0)
    # both spellings of the address, of which the second sentence says neither good nor bad
    assert got[("john@good.com", "EMAIL")] == (1.0, 2.0)
    assert T.SENTENCE_END and df.select(T.sentences("text").alias("s")).first().s[1] == "See https://bad.org/x.y?"


def test_redaction(spark):
    from textmill.operators.redact import redact

    df = spark.createDataFrame([(1, "mail a@b.org or c@d.net, call 555-123-4567"), (2, None), (3, "none")], "doc_id bigint, text string")
    got = {r.doc_id: (r.text, r.n_email, r.n_phone) for r in redact(df).collect()}
    assert got == {1: ("mail [EMAIL] or [EMAIL], call [PHONE]", 2, 1), 2: (None, None, None), 3: ("none", 0, 0)}


def test_sentiment_comes_from_sentences_that_mention_the_name(spark):
    text = ("Ann Lee had a good day. The Lee family saw Joann Leeson fail. ANN LEE was bad at it! "
            "Ann Lee met Ann Lee again, a great success. Nothing bad here.")
    df = spark.createDataFrame([(1, text), (2, "no names here"), (3, None), (4, "")], "doc_id long, text string")
    got = {(r["doc_id"], r["entity_name"]): r for r in EN.extract_entities(df).collect()}
    assert set(got) == {(1, "Ann Lee"), (1, "Joann Leeson"), (1, "The Lee")}
    ann, joann = got[1, "Ann Lee"], got[1, "Joann Leeson"]
    # twice in one sentence is one sentence; inside Joann Leeson, or in capitals, it is not mentioned
    assert (ann["n_mentions"], ann["pos"], ann["sentiment_score"], ann["sentiment_magnitude"]) == (3, 1, 1.0, 2.0)
    assert (joann["n_mentions"], joann["sentiment_score"]) == (1, -1.0)


def test_entities_of_a_text_with_many_mentions(spark):
    names = [f"{a}{b} Smith" for a in ("Ba", "Ce", "Do", "Fu") for b in ("na", "ra", "la", "mi")]
    text = " ".join(f"{names[i % 16]} did a good thing on day {100000 + i}." for i in range(4000))
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    rows = EN.extract_entities(df).where("raw_label = 'PROPN'").collect()
    assert len(rows) == 16 and sum(r["n_mentions"] for r in rows) == 4000 and {r["sentiment_score"] for r in rows} == {1.0}
