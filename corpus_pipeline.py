"""A training corpus from raw documents: language, toxicity, near-duplicates, source mix, packing.

Each stage takes the documents that the one before it kept. All but the last return the
columns of documents, whatever columns these are: rows pass through the operators as one
struct, so no name of theirs can meet one of the operators'. Every stage takes an empty table
and gives one; null ids and repeated rows are documents each, unless a stage says otherwise.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.llm import base, jaccard, langid, mix, pack, queries, toxicity
from textmill.session import ensure_checkpoint_dir

#: Some stages train models or number sequences, which SQL cannot express.
ORACLE_SQL = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognisable language go: null texts, texts without a letter, and
    those whose best language has a score below the calibrated threshold (ties of score go to
    the first language by name)."""
    out = langid.identify(base.packed(docs, "text"), langid.fit(docs), keep=("row",))
    return base.unpacked(out.where(~F.col("rejected")), docs.columns)


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are predicted to be toxic go. Null and empty texts get the score of the
    model's bias alone, which without any labels is 0: they stay."""
    ensure_checkpoint_dir(spark)
    model = toxicity.fit(docs, base.documents(spark, sf_dir, "labels"))
    out = toxicity.score(base.packed(docs, "text"), model, keep=("row",))
    return base.unpacked(out.where("predicted = 0"), docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest doc_id stays (null last; of
    repeated rows one). Texts without words link with nothing and all stay."""
    ensure_checkpoint_dir(spark)
    return jaccard.representatives(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target takes them. A null source is a source of its
    own; null and empty texts have size 0 and are drawn like the others of their source; a
    source without any words is dropped. Repeated rows with one doc_id are drawn alike."""
    ensure_checkpoint_dir(spark)
    return mix.mix(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces and their places in sequences; a document taken twice is packed twice, a
    null or empty text is its end mark alone."""
    ensure_checkpoint_dir(spark)
    return pack.pack(docs, queries.tokenizer("word_bpe_49k.json"))


STAGES = [
    ("language", language),
    ("toxicity", toxic),
    ("near_duplicates", near_duplicates),
    ("source_mix", source_mix),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn; each result is written as Parquet in the shared folder and read again."""
    docs = base.documents(spark, sf_dir)
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        path = f"{root}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
