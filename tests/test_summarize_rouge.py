import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from textmill.operators import rouge as V
from textmill.operators import summarize as Z


def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string")


TEXT = ("The cat sat on the mat. The dog sat on the log. A cat and a dog met. "
        "Birds fly high. The mat was red and the log was brown.")


def test_textrank_mass_and_summary(spark):
    tr = Z.textrank(docs(spark, [(1, TEXT), (2, "Only one sentence here.")])).orderBy("doc_id").collect()
    assert abs(sum(tr[0].ranks) - 1.0) < 1e-6 and len(tr[0].sents) == 5
    assert tr[1].ranks == [1.0]
    s = Z.textrank_summary(docs(spark, [(1, TEXT)])).first()
    assert s.n_sentences == 5 and s.summary.count(".") == 3
    # sentences appear in document order
    picked = [x + "." for x in s.summary.split(". ") if x]
    positions = [TEXT.find(p.rstrip(".")) for p in picked]
    assert positions == sorted(positions)


def test_summary_styles_limits(spark):
    r = Z.summary_styles(docs(spark, [(1, TEXT * 5)])).first()
    assert len(r.tldr.split()) <= 25 and len(r.bullets) == 3 and len(r.abstract.split()) <= 80


def test_chunks_concatenate_back(spark):
    text = "abcdefghij" * 25 + "xyz"
    ch = Z.chunk_documents(docs(spark, [(1, text), (2, "")]), size=40).orderBy("doc_id", "chunk_no").collect()
    assert "".join(r.chunk for r in ch if r.doc_id == 1) == text
    assert [r.chunk_no for r in ch if r.doc_id == 1] == list(range(7))
    assert not [r for r in ch if r.doc_id == 2]


def test_map_reduce_routes(spark):
    long_text = TEXT * 20
    out = Z.map_reduce_summary(docs(spark, [(1, TEXT), (2, long_text)]), threshold=500, chunk=200)
    got = {r.doc_id: r.route for r in out.collect()}
    assert got == {1: "direct", 2: "map_reduce"}


def test_style_validation(spark):
    with pytest.raises(ValueError):
        Z.validate_style("poem")


def test_compare_caps_and_order(spark):
    req = spark.createDataFrame([("g", i, 100 - i) for i in range(10)], "group_id string, pos int, doc_id bigint")
    summ = spark.createDataFrame([(100 - i, f"abs {i}") for i in range(10) if i != 2],
                                 "doc_id bigint, abstract string")
    r = Z.compare_summaries(req, summ, F.lit("why?")).first()
    assert r.doc_ids_requested.split("|") == [str(100 - i) for i in range(8)]
    assert "98" not in r.doc_ids_used.split("|") and r.n_used == 7
    assert r.prompt.index("[100]") < r.prompt.index("[99]")


def score(spark, pairs):
    df = spark.createDataFrame([(i, "m", a, b) for i, (a, b) in enumerate(pairs)],
                               "doc_id bigint, model string, reference string, hypothesis string")
    return [(r.rouge1, r.rouge2, r.rougeL) for r in V.rouge_scores(df).orderBy("doc_id").collect()]


def test_rouge_cases(spark):
    got = score(spark, [("the cat sat", "the cat sat"), ("the cat", ""), ("a b c", "x y z"),
                        ("a small boat left the old harbour", "the small boat has left a harbour")])
    assert got[0] == (1.0, 1.0, 1.0)
    assert got[1] == (0.0, 0.0, 0.0)
    assert got[2] == (0.0, 0.0, 0.0)
    assert got[3] == (0.8571, 0.1667, 0.5714)


def test_rouge_corpus_average(spark):
    s = spark.createDataFrame([(1, "m", 0.5, 0.25, 0.5), (2, "m", 1.0, 0.75, 0.0)],
                              "doc_id bigint, model string, rouge1 double, rouge2 double, rougeL double")
    r = V.rouge_corpus(s).first()
    assert (r.n_docs, r.rouge1, r.rouge2, r.rougeL) == (2, 0.75, 0.5, 0.25)


def plain_lcs(a, b):
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            t[i][j] = t[i - 1][j - 1] + 1 if a[i - 1] == b[j - 1] else max(t[i - 1][j], t[i][j - 1])
    return t[-1][-1]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("abcde"), max_size=30), st.lists(st.sampled_from("abcde"), max_size=30))
def test_lcs_bits_matches_plain(a, b):
    assert V.lcs_bits(a, b) == plain_lcs(a, b)


def test_lcs_native_matches_plain(spark):
    rnd = random.Random(3)
    pairs = [([rnd.choice("abcd") for _ in range(rnd.randint(0, 15))],
              [rnd.choice("abcd") for _ in range(rnd.randint(0, 15))]) for _ in range(40)]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a array<string>, b array<string>")
    got = {r.i: r.l for r in df.select("i", V.lcs(F.col("a"), F.col("b")).alias("l")).collect()}
    assert all(got[i] == plain_lcs(a, b) for i, (a, b) in enumerate(pairs))


def test_eval_unpaired(spark):
    r = spark.createDataFrame([(1,), (2,)], "doc_id bigint")
    h = spark.createDataFrame([(2,), (3,)], "doc_id bigint")
    got = {(x.doc_id, x.missing_side) for x in V.eval_unpaired(r, h).collect()}
    assert got == {(1, "hypothesis"), (3, "reference")}


def test_porter_published_examples():
    from textmill.functions.porter import stem
    cases = {"caresses": "caress", "ponies": "poni", "agreed": "agre", "motoring": "motor", "hopping": "hop",
             "filing": "file", "happy": "happi", "relational": "relat", "generalizations": "gener",
             "oscillators": "oscil", "adoption": "adopt", "controll": "control", "cease": "ceas"}
    assert {w: stem(w) for w in cases} == cases


def test_rouge_with_stemmer(spark):
    df = spark.createDataFrame([(1, "m", "cats running fast", "cat runs fast")],
                               "doc_id bigint, model string, reference string, hypothesis string")
    plain = V.rouge_scores(df, stem=False).first()
    stemmed = V.rouge_scores(df, stem=True).first()
    assert plain.rouge1 < 1.0 and stemmed.rouge1 == 1.0 and stemmed.rougeL == 1.0


def test_map_reduce_has_one_level_whatever_the_length(spark):
    long_text = TEXT * 120   # more than 64 chunks of 200 characters
    d = docs(spark, [(1, long_text)])
    out = Z.map_reduce_summary(d, threshold=500, chunk=200).first()
    assert out.route == "map_reduce" and len(out.bullets) == 3 and len(out.abstract.split()) <= 80
    chunks = Z.chunk_documents(d, size=200)
    assert chunks.count() > 64
    parts = {r.doc_id: r.abstract for r in Z.summary_styles(chunks.select(F.col("chunk_no").alias("doc_id"), F.col("chunk").alias("text"))).collect()}
    text = "\n\n".join(f"[Part {i + 1}]: {parts[i]}" for i in range(len(parts)))
    assert out.abstract == Z.summary_styles(docs(spark, [(1, text)])).first().abstract


def plain_ranks(sentences, iterations=20, d=0.85):
    """TextRank with the full matrix of sentence pairs."""
    import math
    import re
    from collections import Counter

    bags = [Counter(re.findall("[a-z0-9]+", s.lower())) for s in sentences]
    size = [sum(b.values()) for b in bags]
    n = len(bags)
    w = [[0.0] * n for _ in range(n)]
    for i in range(n):
        for j in range(n):
            den = math.log(size[i]) + math.log(size[j])
            w[i][j] = sum(c * bags[j][x] for x, c in bags[i].items()) / (den if den > 0 else 1)
    total = [sum(row) for row in w]
    r = [1 / n] * n
    for _ in range(iterations):
        r = [(1 - d) / n + d * sum(w[i][j] * r[j] / total[j] for j in range(n)) for i in range(n)]
    return r


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from("a b c d e f g".split()), min_size=1, max_size=9).map(" ".join), min_size=1, max_size=12))
def test_textrank_matches_the_full_matrix(sentences):
    from textmill.functions import textrank

    exp = plain_ranks(sentences)
    got = textrank.ranks(sentences, 20, 0.85)
    assert max(abs(a - b) for a, b in zip(got, exp)) < 1e-12 and abs(sum(got) - 1) < 1e-12
    dense, textrank.DENSE = textrank.DENSE, 0
    try:
        assert max(abs(a - b) for a, b in zip(textrank.ranks(sentences, 20, 0.85), exp)) < 1e-12
    finally:
        textrank.DENSE = dense


def test_textrank_of_many_short_lines_is_quick(spark):
    import time

    text = "\n".join(f"w{i % 900}" for i in range(5000))
    t0 = time.time()
    r = Z.textrank_summary(docs(spark, [(1, text)])).first()
    assert r.n_sentences == 5000 and time.time() - t0 < 20


def test_a_reference_without_hypothesis_counts_as_failed(spark):
    ref = spark.createDataFrame([(1, "a b c"), (2, "d e f")], "doc_id bigint, text string")
    hyp = spark.createDataFrame([(1, "m", "a b c"), (3, "m", "x")], "doc_id bigint, model string, text string")
    r = V.rouge_corpus(V.rouge_scores(V.pair_frame(ref, hyp, ["m", "n"]))).orderBy("model").collect()
    assert [(x.model, x.n_docs, x.rouge1) for x in r] == [("m", 2, 0.5), ("n", 2, 0.0)]
