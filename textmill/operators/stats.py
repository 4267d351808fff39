"""Corpus statistics (D1-D12): lengths, describe, histograms, seeded samples,
n-gram frequencies, vocabulary.

All aggregates are partial (map-side combine) so frequent words or a single
hot metric never concentrate raw rows in one task; one-row results are
combined through scalar subqueries, not cross joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.functions import text as T
from textmill.session import barrier

# The notebook's stopword set (49 entries).
EDA_STOPWORDS = (
    "the", "a", "an", "and", "or", "but", "in", "on", "at", "to", "for",
    "of", "with", "is", "was", "are", "were", "he", "she", "they", "it",
    "his", "her", "their", "this", "that", "have", "has", "had", "be",
    "been", "by", "from", "as", "said", "will", "i", "we", "you", "not",
    "--", "also", "who", "its", "about", "up", "after", "more", "which",
)
WORD3_PATTERN = r"(?U)\b[a-zA-Z]{3,}\b"
LONG_DOC_TOKENS = 3_000


def doc_lengths(df: DataFrame, text_col: str = "text", summary_col: str | None = "reference_summary") -> DataFrame:
    """char_count, sent_count (runs of .!?), summary_token_count (null stays null)."""
    out = df.withColumn("char_count", F.length(text_col).cast("bigint")).withColumn(
        "sent_count", F.regexp_count(F.col(text_col), F.lit("[.!?]+")).cast("bigint"))
    if summary_col:
        out = out.withColumn("summary_token_count", T.token_count(summary_col))
    return out


def describe(df: DataFrame, columns: list[str], approx: bool = False, digits: int = 1) -> DataFrame:
    """Count, mean, sample std, min, quartiles, max per column, nulls skipped.

    Columns are unpivoted (``stack``) and aggregated by metric name. The exact
    ``percentile`` interpolates linearly (pandas ``describe``); its buffer is a
    value->count map, small for integer lengths. ``approx=True`` swaps in the
    bounded-memory ``percentile_approx`` for unbounded value domains.
    """
    stacked = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("v")) for c in columns
    ])).alias("s")).select("s.*")

    def pct(p):
        return F.percentile_approx("v", p, 10_000) if approx else F.percentile("v", p)

    return stacked.groupBy("metric").agg(
        F.count("v").alias("count"),
        F.round(F.avg("v"), digits).alias("mean"),
        F.round(F.stddev_samp("v"), digits).alias("std"),
        F.round(F.min("v"), digits).alias("min"),
        F.round(pct(0.25), digits).alias("p25"),
        F.round(pct(0.5), digits).alias("p50"),
        F.round(pct(0.75), digits).alias("p75"),
        F.round(F.max("v"), digits).alias("max"),
    )


def histogram(df: DataFrame, col: str, bins: int) -> DataFrame:
    """D3: equal-width bins over [min, max], last bin right-closed, empty bins kept.

    Rows are counted by value in one pass, in which ``col`` is evaluated once a row. min/max
    come from the counts by one scalar subquery, bound once per side as a column; it takes the
    sum of the counts as well, so that it needs the same columns and reads the same exchange.
    When min == max the range is widened to +-0.5 as numpy does.
    """
    spark: SparkSession = df.sparkSession
    vals = barrier(df.select(F.col(col).cast("double").alias("x"))).filter(F.col("x").isNotNull())
    values = vals.groupBy("x").agg(F.count(F.lit(1)).alias("n"))
    mm = values.select(F.struct(F.min("x").alias("lo"), F.max("x").alias("hi"), F.sum("n").alias("n")).alias("mm")).scalar()

    def bounds(frame: DataFrame) -> DataFrame:
        b = frame.withColumn("_mm", mm)
        same = F.col("_mm.lo") == F.col("_mm.hi")
        b = b.withColumn("_lo", F.when(same, F.col("_mm.lo") - 0.5).otherwise(F.col("_mm.lo"))) \
             .withColumn("_hi", F.when(same, F.col("_mm.hi") + 0.5).otherwise(F.col("_mm.hi")))
        return b.withColumn("_w", (F.col("_hi") - F.col("_lo")) / F.lit(bins))

    binned = barrier(bounds(values)).select(
        F.least(F.floor((F.col("x") - F.col("_lo")) / F.col("_w")), F.lit(bins - 1)).cast("int").alias("bin"), "n")
    counts = binned.groupBy("bin").agg(F.sum("n").alias("n"))
    domain = barrier(bounds(spark.range(bins).select(F.col("id").cast("int").alias("bin"))))
    return (
        domain.join(counts, "bin", "left")
        .select(
            "bin",
            F.round(F.col("_lo") + F.col("bin") * F.col("_w"), 4).alias("lo"),
            F.round(F.col("_lo") + (F.col("bin") + 1) * F.col("_w"), 4).alias("hi"),
            F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("n"),
        )
    )


def sample_documents(df: DataFrame, n: int, seed: int, key: str = "doc_id") -> DataFrame:
    """Deterministic seeded sample: order by md5(seed || key), first n.

    Independent of partitioning, repeatable in SQL; planned as
    TakeOrderedAndProject (n rows per task)."""
    order = F.md5(F.concat(F.lit(str(seed)), F.lit(":"), F.col(key).cast("string")))
    return df.withColumn("_o", order).orderBy("_o", key).limit(n).drop("_o")


def words3(text: Column | str) -> Column:
    """Lower-cased ``\\b[a-zA-Z]{3,}\\b`` tokens (Unicode word boundaries)."""
    return F.transform(raw_words3(text), lambda w: F.lower(w))


def raw_words3(text: Column | str) -> Column:
    c = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(c, F.lit(WORD3_PATTERN), 0)


def drop_stopwords(tokens: Column, stopwords=EDA_STOPWORDS) -> Column:
    """Remove a small literal stopword set inside the array (no join). The set is a list of
    literals, which Spark looks up by hash; an array would be searched for every token."""
    return F.filter(tokens, lambda w: ~w.isin(*stopwords))


def content_tokens(df: DataFrame, text_col: str = "text", key: str = "doc_id") -> DataFrame:
    return df.select(key, drop_stopwords(words3(text_col)).alias("toks"))


def word_counts(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Content words with their counts. The words of a text become rows as they stand; lower case and
    stopwords are matters of the rows, in generated code."""
    words = df.select(F.explode(raw_words3(text_col)).alias("word")).select(F.lower("word").alias("word"))
    return words.where(~F.col("word").isin(*EDA_STOPWORDS)).groupBy("word").agg(F.count(F.lit(1)).alias("freq"))


def top_unigrams(df: DataFrame, n: int = 20, text_col: str = "text") -> DataFrame:
    """Most frequent content words, ties by word."""
    return word_counts(df, text_col).orderBy(F.desc("freq"), "word").limit(n)


def bigrams(tokens: Column) -> Column:
    """Adjacent pairs inside one document; empty for fewer than 2 tokens
    (``sequence(1, 0)`` would count down)."""
    pairs = F.transform(F.sequence(F.lit(1), F.size(tokens) - 1),
                        lambda i: F.concat_ws(" ", F.element_at(tokens, i), F.element_at(tokens, i + 1)))
    return F.when(F.size(tokens) >= 2, pairs).otherwise(F.array().cast("array<string>"))


def top_bigrams(df: DataFrame, n: int = 20, text_col: str = "text") -> DataFrame:
    """Most frequent adjacent content-word pairs (within documents)."""
    toks = content_tokens(df, text_col)
    return (
        toks.select(F.explode(bigrams(F.col("toks"))).alias("bigram"))
        .groupBy("bigram").agg(F.count(F.lit(1)).alias("freq"))
        .orderBy(F.desc("freq"), "bigram").limit(n)
    )


def vocabulary_stats(df: DataFrame, text_col: str = "text", approx: bool = False) -> DataFrame:
    """Vocabulary size, total tokens, type-token ratio (3 dp).

    Counted from the per-word aggregate (partial counts per task), never a
    ``countDistinct`` over raw tokens; ``approx`` uses HyperLogLog instead.
    """
    if approx:
        toks = content_tokens(df, text_col).select(F.explode("toks").alias("word"))
        agg = toks.agg(F.approx_count_distinct("word").alias("vocab_size"), F.count(F.lit(1)).alias("total_tokens"))
    else:
        agg = word_counts(df, text_col).agg(
            F.count(F.lit(1)).alias("vocab_size"), F.sum("freq").cast("bigint").alias("total_tokens"))
    return agg.select(
        F.col("vocab_size").cast("bigint").alias("vocab_size"), "total_tokens",
        F.round(F.try_divide(F.col("vocab_size"), F.col("total_tokens")), 3).alias("type_token_ratio"),
    )


def sample_preview(df: DataFrame, n: int = 5, seed: int = 7, chars: int = 400, key: str = "doc_id",
                   extra: tuple[str, ...] = ("token_count",)) -> DataFrame:
    """Seeded sample with the first ``chars`` characters of each text."""
    s = sample_documents(df, n, seed, key)
    return s.select(key, *extra, F.substring("text", 1, chars).alias("preview"))


def corpus_takeaways(df: DataFrame, text_col: str = "text", summary_col: str = "reference_summary",
                     long_tokens: int = LONG_DOC_TOKENS) -> DataFrame:
    """One row: documents, three medians, vocabulary size, long documents."""
    lengths = doc_lengths(df, text_col, summary_col)
    vocab = word_counts(df, text_col).agg(F.count(F.lit(1))).scalar()
    return lengths.agg(
        F.count(F.lit(1)).alias("total_docs"),
        F.percentile("token_count", 0.5).alias("median_tokens"),
        F.percentile("sent_count", 0.5).alias("median_sentences"),
        F.percentile("summary_token_count", 0.5).alias("median_summary_tokens"),
        F.count_if(F.col("token_count") > long_tokens).alias("docs_over_long_tokens"),
    ).withColumn("vocab_size", vocab.cast("bigint"))
