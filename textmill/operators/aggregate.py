"""Entity aggregation across documents.

Request ids are a DataFrame (any size): a ``left_semi`` join restricts the
entities table, which is duplicate-safe and never splices ids into SQL text.
Per-name aggregates are partial, so a name present in a third of all rows
is combined map-side before the shuffle. Sentiment sums use decimal(18,4):
inputs are already rounded to 4 dp, so totals are exact and independent of
partition order, and the +-0.1 class thresholds cannot flip on float drift.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOP_N_DEFAULT = 10
TOP_N_MIN, TOP_N_MAX = 1, 50
THRESHOLD = 0.1


def validate_top_n(top_n: int) -> int:
    if not isinstance(top_n, int) or isinstance(top_n, bool) or not TOP_N_MIN <= top_n <= TOP_N_MAX:
        raise ValueError(f"top_n must be an integer in [{TOP_N_MIN}, {TOP_N_MAX}]")
    return top_n


def select_entities(entities: DataFrame, ids: DataFrame, extractor: str | None, key: str = "doc_id") -> DataFrame:
    """A1: rows of the requested documents (and extractor)."""
    ents = entities if extractor is None else entities.filter(F.col("extractor") == F.lit(extractor))
    return ents.join(ids.select(key), key, "left_semi")


def per_entity(rows: DataFrame) -> DataFrame:
    """A2-A4: frequency, sentiment sum (decimal), mean sentiment (nulls as 0, 3 dp),
    representative type (latest row wins: extracted_at, then doc id)."""
    s = F.coalesce(F.col("sentiment_score"), F.lit(0.0)).cast("decimal(18,4)")
    return rows.groupBy("entity_name").agg(
        F.count(F.lit(1)).alias("frequency"),
        F.sum(s).alias("sentiment_sum"),
        F.max_by(F.coalesce(F.col("entity_type"), F.lit("OTHER")),
                 F.struct("extracted_at", "doc_id", "entity_type")).alias("entity_type"),
    ).withColumn("avg_sentiment", F.round(F.col("sentiment_sum").cast("double") / F.col("frequency"), 3))


def aggregate_entities(entities: DataFrame, ids: DataFrame, top_n: int = TOP_N_DEFAULT,
                       extractor: str | None = "pattern", key: str = "doc_id") -> DataFrame:
    """A1-A5: top-n names by frequency (ties by name); empty frame when none."""
    validate_top_n(top_n)
    agg = per_entity(select_entities(entities, ids, extractor, key))
    return agg.select("entity_name", "entity_type", "frequency", "avg_sentiment").orderBy(
        F.desc("frequency"), "entity_name").limit(top_n)


def sentiment_distribution(entities: DataFrame, ids: DataFrame, extractor: str | None = "pattern",
                           on: str = "sum", key: str = "doc_id") -> DataFrame:
    """Positive / negative / neutral counts over all names (not only the top-n),
    classifying the per-name sentiment ``sum`` (reference behaviour) or ``mean``."""
    agg = per_entity(select_entities(entities, ids, extractor, key))
    v = F.col("sentiment_sum") if on == "sum" else F.col("sentiment_sum") / F.col("frequency")
    t = F.lit(THRESHOLD).cast("decimal(18,4)")
    return agg.agg(
        F.count_if(v > t).alias("positive"),
        F.count_if(v < -t).alias("negative"),
        F.count_if(v.between(-t, t)).alias("neutral"),
    )


def aggregate_entities_summary(entities: DataFrame, ids: DataFrame, extractor: str | None = "pattern",
                               key: str = "doc_id") -> DataFrame:
    """A7 + A6 in one row: requested documents (duplicates and absent ids
    included), distinct names found, and the sentiment classes."""
    dist = sentiment_distribution(entities, ids, extractor, "sum", key)
    n_req = ids.agg(F.count(F.lit(1))).scalar()
    return dist.select(n_req.alias("doc_count"), "positive", "negative", "neutral")


def require_ids(ids: list) -> list:
    """An empty id list is an argument error (raised before any job)."""
    if not ids:
        raise ValueError("there are no documents to aggregate: no id was given")
    return ids
