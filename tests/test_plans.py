"""Plan-shape checks: shuffles only where the design puts them, Python only in
the model call, ROUGE-L and the TextRank iteration (Arrow batches), top-k
operators planned as partial limits."""

from pyspark.sql import functions as F

from textmill.operators import clean as C
from textmill.operators import entities as EN
from textmill.operators import search as Q
from textmill.operators import summarize as Z
from textmill.session import table

from conftest import SF


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def docs(spark):
    return table(spark, SF, "documents").select("doc_id", "text", "source")


def test_clean_has_one_hash_shuffle_and_pushes_no_python(spark):
    p = plan(C.clean_documents(docs(spark)))
    assert p.count("hashpartitioning") == 1 and "text_hash" in p
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p


def test_entity_extraction_and_textrank_are_map_only(spark):
    for df, python in ((EN.extract_entities(docs(spark)), 0), (Z.textrank(docs(spark)), 1), (Z.summary_styles(docs(spark)), 1)):
        p = plan(df)
        assert "Exchange" not in p, p
        # one Arrow-batched evaluation of the ranks, nothing row by row
        assert p.count("ArrowEvalPython") == python and "BatchEvalPython" not in p


def test_search_batch_uses_window_group_limit(spark):
    p = plan(Q.search_batch(docs(spark), {"a": "th", "b": "en"}, top_k=3))
    assert "WindowGroupLimit" in p
    assert p.count("FileScan") == 1


def test_scan_prunes_columns(spark):
    p = plan(Q.search_documents(docs(spark), "th", 3))
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in p


def test_dedupe_is_partial_aggregate(spark):
    d = docs(spark).select("doc_id", "source", F.sha2("text", 256).alias("text_hash"))
    p = plan(C.dedupe_exact(d))
    assert "partial_min" in p
