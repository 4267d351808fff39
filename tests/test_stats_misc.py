import os
import tempfile

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from textmill import schemas
from textmill.operators import rouge as V
from textmill.operators import stats as D
from textmill.sources import tables as S


def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string")


def test_describe_exact_and_approx(spark):
    df = spark.createDataFrame([(float(x),) for x in [1, 2, 3, 4, 100]], "v double")
    ex = D.describe(df, ["v"]).first()
    assert (ex["count"], ex["min"], ex["p25"], ex["p50"], ex["p75"], ex["max"]) == (5, 1.0, 2.0, 3.0, 4.0, 100.0)
    assert ex["mean"] == 22.0 and ex["std"] == 43.6
    ap = D.describe(df, ["v"], approx=True).first()
    assert ap["p50"] == 3.0


def test_histogram_edges_and_constant(spark):
    df = spark.createDataFrame([(float(x),) for x in [0, 1, 2, 3, 10]], "x double")
    h = D.histogram(df, "x", 5).orderBy("bin").collect()
    assert [r.n for r in h] == [2, 2, 0, 0, 1] and h[-1].hi == 10.0
    c = D.histogram(spark.createDataFrame([(7.0,), (7.0,)], "x double"), "x", 4).orderBy("bin").collect()
    assert sum(r.n for r in c) == 2 and c[0].lo == 6.5 and c[-1].hi == 7.5


def test_vocabulary_and_bigrams(spark):
    d = docs(spark, [(1, "Apple banana apple. The cherry"), (2, "x"), (3, "banana cherry")])
    v = D.vocabulary_stats(d).first()
    assert (v.vocab_size, v.total_tokens, v.type_token_ratio) == (3, 6, 0.5)
    assert D.vocabulary_stats(d, approx=True).first().vocab_size == 3
    bi = {r.bigram: r.freq for r in D.top_bigrams(d, 10).collect()}
    assert bi == {"apple banana": 1, "banana apple": 1, "apple cherry": 1, "banana cherry": 1}


def test_word_boundaries_are_unicode(spark):
    toks = docs(spark, [(1, "café Éthe the-cat don't naïve abc")]).select(D.words3("text").alias("t")).first().t
    assert toks == ["the", "cat", "don", "abc"]


def test_seeded_sample_is_stable(spark):
    d = docs(spark, [(i, "t") for i in range(50)])
    a = [r.doc_id for r in D.sample_documents(d, 5, 42).collect()]
    b = [r.doc_id for r in D.sample_documents(d.repartition(7), 5, 42).collect()]
    assert a == b and len(set(a)) == 5


def test_create_table_if_absent(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="tm-tbl-"), "summaries")
    S.create_table_if_absent(spark, path, schemas.SUMMARIES)
    assert spark.read.parquet(path).count() == 0
    S.create_table_if_absent(spark, path, schemas.SUMMARIES)
    assert set(spark.read.parquet(path).columns) == {f.name for f in schemas.SUMMARIES.fields}


words = st.lists(st.sampled_from(["a", "b", "c", "d"]), min_size=1, max_size=12).map(" ".join)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(words, words), min_size=1, max_size=5))
def test_rouge_f1_symmetric(spark, pairs):
    fwd = spark.createDataFrame([(i, "m", a, b) for i, (a, b) in enumerate(pairs)],
                                "doc_id bigint, model string, reference string, hypothesis string")
    rev = fwd.select("doc_id", "model", F.col("hypothesis").alias("reference"), F.col("reference").alias("hypothesis"))
    f = {r.doc_id: (r.rouge1, r.rouge2, r.rougeL) for r in V.rouge_scores(fwd).collect()}
    g = {r.doc_id: (r.rouge1, r.rouge2, r.rougeL) for r in V.rouge_scores(rev).collect()}
    assert f == g
