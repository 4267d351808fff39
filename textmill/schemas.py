"""Table schemas (nullable=False marks a REQUIRED field)."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _f(name, dtype, required=False):
    return StructField(name, dtype, nullable=not required)


DOCUMENTS = StructType([
    _f("doc_id", StringType(), True),
    _f("text", StringType(), True),
    _f("reference_summary", StringType()),
    _f("source", StringType()),
    _f("ingested_at", TimestampType(), True),
])

DOCUMENTS_CLEAN = StructType(DOCUMENTS.fields + [
    _f("token_count", LongType(), True),
    _f("lang", StringType(), True),
    _f("text_hash", StringType(), True),
])

ENTITIES = StructType([
    _f("doc_id", StringType(), True),
    _f("entity_name", StringType(), True),
    _f("entity_type", StringType()),
    _f("salience", DoubleType()),
    _f("sentiment_score", DoubleType()),
    _f("sentiment_magnitude", DoubleType()),
    _f("extractor", StringType(), True),
    _f("extracted_at", TimestampType(), True),
])

ACTOR = StructType([_f("name", StringType()), _f("role", StringType())])
DATE_EVENT = StructType([_f("date", StringType()), _f("event", StringType())])

# Structured extraction record (model response), nested.
EXTRACTION = StructType([
    _f("core_issue", StringType()),
    _f("actors", ArrayType(ACTOR)),
    _f("key_metrics", ArrayType(StringType())),
    _f("dates", ArrayType(DATE_EVENT)),
    _f("sentiment_label", StringType()),
    _f("sentiment_reason", StringType()),
])

EXTRACTIONS = StructType([_f("doc_id", StringType(), True)] + EXTRACTION.fields
                         + [_f("extracted_at", TimestampType(), True)])

SUMMARY = StructType([
    _f("tldr", StringType()),
    _f("bullets", ArrayType(StringType())),
    _f("abstract", StringType()),
])

SUMMARIES = StructType([_f("doc_id", StringType(), True)] + SUMMARY.fields
                       + [_f("summarized_at", TimestampType(), True)])

EVALUATION_RESULTS = StructType([
    _f("doc_id", StringType(), True),
    _f("model", StringType(), True),
    _f("rouge1", DoubleType(), True),
    _f("rouge2", DoubleType(), True),
    _f("rougeL", DoubleType(), True),
    _f("evaluated_at", TimestampType(), True),
])

SESSION_TURNS = StructType([
    _f("session_id", StringType(), True),
    _f("ts", TimestampType(), True),
    _f("role", StringType(), True),
    _f("content", StringType()),
    _f("tool_name", StringType()),
    _f("args", StringType()),
    _f("observation", StringType()),
])

CACHE_LOG = StructType([
    _f("doc_id", StringType(), True),
    _f("key", StringType(), True),
    _f("value", StringType()),
    _f("ts", TimestampType(), True),
])
