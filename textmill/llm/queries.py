"""Driver queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.llm import grades, jaccard, langid, licenses, lines, mix, neighbours, pack, runs, shards, tokens, toxicity, whiten
from textmill.llm.base import WORD, documents, held_out
from textmill.session import ensure_checkpoint_dir


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    return mix.plan(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = tokens.count(documents(spark, sf_dir), tokenizer("byte_bpe_50k.json"))
    return out.withColumn("over_limit", F.col("n_tokens") > 1024)


def op3_embedding_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    return neighbours.near_duplicates(documents(spark, sf_dir, "embeddings"))


def op4_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    return pack.pack(documents(spark, sf_dir), tokenizer("word_bpe_49k.json"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    docs = documents(spark, sf_dir)
    model = toxicity.fit(docs, documents(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select("doc_id", held_out("doc_id").alias("held_out"), "score", "predicted")


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(documents(spark, sf_dir))


def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    return jaccard.join(documents(spark, sf_dir))


def op8_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    return lines.judge(documents(spark, sf_dir))


def op9_quality_grades(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    docs = documents(spark, sf_dir)
    model = grades.fit(docs, grades.ratings(documents(spark, sf_dir, "labels")))
    return grades.grade(docs, model).select("doc_id", held_out("doc_id").alias("held_out"), "expected_grade", "tail", "kept")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return langid.identify(docs, langid.fit(docs)).select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score", "rejected")


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    rows = documents(spark, sf_dir, "embeddings")
    return whiten.transform(rows, whiten.fit(rows)).withColumn("deviation", F.col("deviation").cast("long"))


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    out = shards.assign(documents(spark, sf_dir), 8)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, text): in one document of ten, told by a hash of its id, the words from some
    place on repeat the first of them over and over."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")
    words = F.regexp_extract_all("text", F.lit(f"({WORD})"), 1)
    n = F.size("w").cast("long")
    a = g % n
    p = 1 + F.floor((n - a) / (3 + g % 8)).cast("long")
    moved = F.transform("w", lambda x, i: F.when(i < F.col("a"), x).otherwise(F.get("w", (F.col("a") + (i - F.col("a")) % F.col("p")).cast("int"))))
    out = docs.select("doc_id", "text", F.when(h % 10 == 0, words).alias("w"), g.alias("g"))
    out = out.withColumn("w", F.when(F.size("w") > 0, F.col("w"))).select("doc_id", "text", "w", a.alias("a"), p.alias("p"))
    return out.select("doc_id", F.coalesce(F.array_join(moved, " "), F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = runs.detect(with_planted_runs(documents(spark, sf_dir)))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    listed = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return out.withColumn("longest", longest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("longest.start")).alias("start"), F.col("longest.length").alias("length"), (-F.col("longest.period")).alias("period"),
        F.floor(1000 * F.col("longest.length") / -F.col("longest.period")).cast("long").alias("exponent_milli"),
        digest(listed).alias("runs_sha256"), digest(F.col("collapsed")).alias("collapsed_sha256"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        op1_mix_sources, op2_token_counts, op3_embedding_neighbours, op4_pack_sequences, op5_toxicity,
        op6_license_scan, op7_ngram_jaccard, op8_line_frequency, op9_quality_grades, op10_language_id,
        op11_embedding_whitening, op12_sharding, op13_periodic_runs,
    )
}
