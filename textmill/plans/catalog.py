"""Named driver queries: each takes (spark, sf_dir) and returns a lazy DataFrame.

Every query reads the whole driver tables. Parameters that the reference
fixes for a news corpus (chunk sizes, thresholds) are lowered here only where
the synthetic test corpus would otherwise leave an operator with no input;
the library defaults stay those of the reference.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.operators import clean as C
from textmill.operators import search as Q
from textmill.session import spread, stage_table, table

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}


def query(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        return fn
    return deco


# One DataFrame object per (session, data dir): every branch of a query then
# shares the same plan nodes, so Spark reuses the cleaning exchange instead
# of scanning and cleaning the corpus once per branch (separately built
# lambda expressions never canonicalise as equal).
# An entry holds for one state of the input files.
_SHARED: dict[tuple, DataFrame] = {}


def _version(spark: SparkSession, sf_dir: str, names: tuple[str, ...]) -> tuple:
    """Size and time of change of the files of tables, by Hadoop's file system."""
    if not hasattr(spark, "_jvm"):  # a client without a JVM of its own
        return ()
    jvm, conf = spark._jvm, spark._jsparkSession.sessionState().newHadoopConf()
    out = []
    for name in names:
        path = jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{name}.parquet")
        out += [(s.getPath().toString(), s.getLen(), s.getModificationTime()) for s in path.getFileSystem(conf).listStatus(path)]
    return tuple(out)


def _shared(kind: str, spark: SparkSession, sf_dir: str, build) -> DataFrame:
    try:
        app = spark.sparkContext.applicationId
    except Exception:  # noqa: BLE001 - no SparkContext on this client
        app = spark.conf.get("spark.app.id", "")
    k = (kind, app, sf_dir, _version(spark, sf_dir, ("documents", "labels", "nation", "region")))
    if k not in _SHARED:
        _SHARED[k] = build()
    return _SHARED[k]


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shared("docs", spark, sf_dir, lambda: spread(
        table(spark, sf_dir, "documents").select("doc_id", "text", "source", "n_chars")))


def staged(name: str, spark: SparkSession, sf_dir: str, build) -> DataFrame:
    """A table of the pipeline, written once for a state of the input under the
    shared folder and read by all later stages."""
    return _shared(name, spark, sf_dir, lambda: stage_table(build(spark, sf_dir), name))


def clean_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned corpus (``documents_clean``), written once per session and
    data directory under the shared checkpoint folder and read by every later
    stage, as the reference's pipeline does with its clean table."""
    return _shared("clean", spark, sf_dir, lambda: C.store_clean_documents(docs(spark, sf_dir)))


# --- 2.2 cleaning -----------------------------------------------------------

@query("clean_documents")
def q_clean_documents(spark, sf_dir):
    return clean_docs(spark, sf_dir).select(
        "doc_id", "source", "lang", "token_count", "text_hash", F.length("text").cast("bigint").alias("n_chars")
    )


# --- 2.3 search -------------------------------------------------------------

SEARCH_PATTERN = "th[a-z]*tion"


@query("search_documents")
def q_search_documents(spark, sf_dir):
    return Q.search_documents(clean_docs(spark, sf_dir), SEARCH_PATTERN, top_k=10)


# --- 2.1 sources and sinks --------------------------------------------------

from textmill.sources import tables as S  # noqa: E402
from textmill.functions import text as T  # noqa: E402
from textmill.functions import lang as LANG  # noqa: E402


@query("scan_limit")
def q_scan_limit(spark, sf_dir):
    return S.scan_limit(table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars"), 500)


JSONL_SCHEMA = "doc_id BIGINT, text STRING, source STRING"


@query("jsonl_roundtrip")
def q_jsonl_roundtrip(spark, sf_dir):
    from pyspark.sql.types import _parse_datatype_string

    path = S.scratch_path(spark, "jsonl")
    S.write_jsonl(docs(spark, sf_dir).select("doc_id", "text", "source"), path)
    back = S.read_jsonl(spark, path, _parse_datatype_string(JSONL_SCHEMA))
    return back.groupBy("source").agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.sum(F.length("text")).cast("bigint").alias("total_chars"),
        F.min("doc_id").alias("min_doc_id"),
        F.max("doc_id").alias("max_doc_id"),
    )


@query("table_create_append")
def q_table_create_append(spark, sf_dir):
    """S4 + S6: the table is made once, and a second creation leaves its rows alone."""
    from pyspark.sql.types import _parse_datatype_string

    schema = _parse_datatype_string("doc_id BIGINT, source STRING, n_chars BIGINT")
    path = S.scratch_path(spark, "created")
    for _ in range(2):
        S.create_table_if_absent(spark, path, schema)
        S.write_table(table(spark, sf_dir, "documents"), path, schema, mode="append")
    return spark.read.parquet(path).groupBy("source").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("n_chars").cast("bigint").alias("n_chars"))


@query("table_truncate_write")
def q_table_truncate_write(spark, sf_dir):
    """A second write of the typed ``entities`` table replaces the first."""
    from textmill import schemas

    path = S.scratch_path(spark, "entities")
    for extractor in ("gazetteer", "pattern"):
        S.write_table(all_entities(spark, sf_dir).filter(F.col("extractor") == extractor), path, schemas.ENTITIES)
    return spark.read.parquet(path).groupBy("extractor", "entity_type").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("doc_id").alias("n_docs"))


@query("stream_ingest")
def q_stream_ingest(spark, sf_dir):
    """The documents as a file stream, cleaned, deduplicated and appended."""
    from pyspark.sql.types import StructType

    from textmill.streaming.append import read_appended
    from textmill.streaming.ingest import ingest

    raw = table(spark, sf_dir, "documents")
    base = S.scratch_path(spark, "stream")
    raw.write.parquet(f"{base}/landing")  # a stream of files needs a folder
    stream = spark.readStream.schema(raw.schema).parquet(f"{base}/landing")
    schema = StructType([f for f in C.with_clean_columns(raw.select("text")).schema.fields if f.name in ("text_hash", "token_count")])
    ingest(stream, f"{base}/table", schema, f"{base}/checkpoint", _ts(), available_now=True).awaitTermination()
    return read_appended(spark, f"{base}/table", schema).select("text_hash", "token_count")


def _json_landing(spark, sf_dir, wave: int) -> DataFrame:
    """Lines of JSON as they arrive in one of three waves: every document once, in the wave of
    its id; one in four again in the next, later than any watermark; some without their text,
    some cut off in the middle."""
    raw = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    again = (F.col("doc_id") % 3 == (wave + 2) % 3) & (F.col("doc_id") % 4 == 0)
    rows = raw.where((F.col("doc_id") % 3 == wave) | again)
    line = F.to_json(F.struct("doc_id", F.when(F.col("doc_id") % 10 != 7, F.col("text")).alias("text"), "source"))
    return rows.select(F.when(F.col("doc_id") % 10 == 3, F.substring(line, 1, 12)).otherwise(line).alias("value"))


@query("stream_ingest_committed")
def q_stream_ingest_committed(spark, sf_dir):
    """Three waves of JSON lines, the stream stopped and started again between them; bad
    lines are counted by reason, documents that came again, however late, are there once."""
    from pyspark.sql.types import _parse_datatype_string

    from textmill.streaming import ingest as IN

    base = S.scratch_path(spark, "stream-committed")
    record = _parse_datatype_string("doc_id BIGINT, text STRING, source STRING")
    schema = _parse_datatype_string("doc_id BIGINT, text STRING, text_hash STRING, token_count BIGINT, ingested_at TIMESTAMP")
    for wave in range(3):
        _json_landing(spark, sf_dir, wave).write.mode("append").text(f"{base}/landing")
        stream = IN.json_records(spark.readStream.text(f"{base}/landing"), record)
        IN.ingest_committed(stream, f"{base}/tables", schema, f"{base}/checkpoint", IN.required("doc_id", "text"), _ts(), available_now=True).awaitTermination()
    tables = IN.open_ingested(spark, f"{base}/tables", schema)
    kept = tables.read("documents").select(F.lit("documents").alias("sink"), F.col("text_hash").alias("ref"), F.col("token_count").alias("n"))
    dead = tables.read("dead").groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
    return kept.unionByName(dead.select(F.lit("dead").alias("sink"), F.col("reason").alias("ref"), "n"))


SQL_PATTERN = "schaft|ung"


@query("sql_search")
def q_sql_search(spark, sf_dir):
    return S.param_sql(
        spark,
        "SELECT doc_id, CAST(regexp_count(lower(text), :q) AS BIGINT) AS score "
        "FROM {d} WHERE lower(text) RLIKE :q",
        args={"q": SQL_PATTERN},
        d=docs(spark, sf_dir),
    )


@query("eval_sample")
def q_eval_sample(spark, sf_dir):
    d = clean_docs(spark, sf_dir).withColumn("reference_summary", F.array_join(F.slice(T.sentences("text"), 1, 3), " "))
    return S.eval_sample(d, "reference_summary", ["doc_id", "token_count", "reference_summary"], limit=100)


@query("fetch_by_id")
def q_fetch_by_id(spark, sf_dir):
    ids = table(spark, sf_dir, "labels").select("doc_id")
    d = docs(spark, sf_dir).withColumn("text_hash", T.content_hash("text")).withColumn(
        "text_chars", F.length("text").cast("bigint"))
    return S.fetch_by_id(ids, d, columns=("text_chars", "text_hash"))


# --- 2.2 normalisation ------------------------------------------------------

INGESTED_AT = "2024-01-01 00:00:00"


@query("normalize_record")
def q_normalize_record(spark, sf_dir):
    out = C.normalize_record(docs(spark, sf_dir), ingested_at=F.to_timestamp(F.lit(INGESTED_AT)))
    return out.select("doc_id", "doc_uid", "source", F.length("text").cast("bigint").alias("text_chars"),
                      F.date_format("ingested_at", "yyyy-MM-dd HH:mm:ss").alias("ingested_at"))


def _noisy_text():
    # inject CRLF runs and tab/space runs so every rewrite rule fires
    return F.replace(F.replace(F.col("text"), F.lit(" "), F.lit(" \t ")), F.lit("\n"), F.lit("\r\n\r\n\r\n"))


@query("normalize_whitespace")
def q_normalize_whitespace(spark, sf_dir):
    d = docs(spark, sf_dir).withColumn("noisy", F.concat(F.lit(" \t"), _noisy_text(), F.lit("\r\n ")))
    norm = T.normalize_whitespace("noisy")
    return d.select(
        "doc_id",
        F.sha2(norm, 256).alias("norm_hash"),
        F.length(norm).cast("bigint").alias("norm_chars"),
        (norm == T.normalize_whitespace("text")).alias("same_as_clean"),
    )


@query("detect_language")
def q_detect_language(spark, sf_dir):
    d = spread(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    return d.select("doc_id", F.col("lang").alias("lang_given"),
                    LANG.detect_language(T.normalize_whitespace("text")).alias("lang_detected"))


@query("token_count")
def q_token_count(spark, sf_dir):
    d = docs(spark, sf_dir)
    return d.select(
        "doc_id",
        T.token_count("text").alias("token_count"),
        T.token_count(F.replace(F.col("text"), F.lit(" "), F.lit("\u00a0\u2003\x1c"))).alias("token_count_unicode_ws"),
    )


@query("content_hash")
def q_content_hash(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", T.content_hash("text").alias("text_hash"))


@query("dedupe_exact")
def q_dedupe_exact(spark, sf_dir):
    d = docs(spark, sf_dir).select("doc_id", "source", T.content_hash("text").alias("text_hash"))
    return C.dedupe_exact(d)


@query("clean_report")
def q_clean_report(spark, sf_dir):
    return C.clean_report(docs(spark, sf_dir))


# --- 2.3 multi-query search -------------------------------------------------

BATCH_PATTERNS = {"q_de": "schaft|ung", "q_en": "th[a-z]*tion", "q_es": "ción", "q_fr": "ment", "q_num": "[0-9]+"}


@query("search_batch")
def q_search_batch(spark, sf_dir):
    return Q.search_batch(docs(spark, sf_dir), BATCH_PATTERNS, top_k=5)


from textmill.operators import trigrams as TRI  # noqa: E402


def trigram_index(spark, sf_dir):
    """The stored trigram index of the documents, built once for a state of the input."""
    return _shared("trigrams", spark, sf_dir, lambda: TRI.build_index(docs(spark, sf_dir)))


INDEXED_PATTERNS = BATCH_PATTERNS | {"q_rare": "general public licen[cs]e|apache license"}


@query("search_indexed")
def q_search_indexed(spark, sf_dir):
    """Q1-Q3 by the index, all matches of each pattern; q_num has no trigram and scans."""
    index = trigram_index(spark, sf_dir)
    found = [TRI.match_score(index, p).select(F.lit(qid).alias("qid"), "doc_id", "score") for qid, p in sorted(INDEXED_PATTERNS.items())]
    return functools.reduce(DataFrame.unionAll, found)


@query("search_index_report")
def q_search_index_report(spark, sf_dir):
    """How many texts each pattern is run on."""
    plain = {q: p for q, p in INDEXED_PATTERNS.items() if q != "q_es"}
    return TRI.search_report(trigram_index(spark, sf_dir), plain)


# --- 2.9 corpus statistics --------------------------------------------------

from textmill.operators import stats as D  # noqa: E402

LEAD_SENTENCES = 3


def with_reference(df: DataFrame) -> DataFrame:
    """Stand-in reference summary: the lead-3 sentences (the driver corpus has none)."""
    return df.withColumn("reference_summary", F.array_join(T.lead_sentences("text", LEAD_SENTENCES), " "))


def clean_ref(spark, sf_dir):
    return with_reference(clean_docs(spark, sf_dir))


LENGTH_METRICS = ["token_count", "char_count", "sent_count", "summary_token_count"]


@query("doc_lengths")
def q_doc_lengths(spark, sf_dir):
    return D.doc_lengths(clean_ref(spark, sf_dir)).select("doc_id", *LENGTH_METRICS)


@query("describe_lengths")
def q_describe_lengths(spark, sf_dir):
    return D.describe(D.doc_lengths(clean_ref(spark, sf_dir)), LENGTH_METRICS)


@query("histogram_tokens")
def q_histogram_tokens(spark, sf_dir):
    return D.histogram(clean_docs(spark, sf_dir), "token_count", 50)


@query("histogram_sentences")
def q_histogram_sentences(spark, sf_dir):
    return D.histogram(D.doc_lengths(clean_docs(spark, sf_dir), summary_col=None), "sent_count", 40)


@query("histogram_summaries")
def q_histogram_summaries(spark, sf_dir):
    return D.histogram(D.doc_lengths(clean_ref(spark, sf_dir)), "summary_token_count", 40)


@query("sample_documents")
def q_sample_documents(spark, sf_dir):
    return D.sample_documents(clean_docs(spark, sf_dir), 300, 42).select("doc_id", "token_count")


@query("top_unigrams")
def q_top_unigrams(spark, sf_dir):
    return D.top_unigrams(clean_docs(spark, sf_dir), 20)


@query("top_bigrams")
def q_top_bigrams(spark, sf_dir):
    return D.top_bigrams(clean_docs(spark, sf_dir), 20)


@query("vocabulary_stats")
def q_vocabulary_stats(spark, sf_dir):
    return D.vocabulary_stats(clean_docs(spark, sf_dir))


@query("sample_preview")
def q_sample_preview(spark, sf_dir):
    return D.sample_preview(clean_docs(spark, sf_dir), 5, 7)


@query("corpus_takeaways")
def q_corpus_takeaways(spark, sf_dir):
    return D.corpus_takeaways(clean_ref(spark, sf_dir))


# --- 2.4 entities -------------------------------------------------------------

from textmill.operators import entities as EN  # noqa: E402

def _ts():
    return F.to_timestamp(F.lit(INGESTED_AT))

# Fixed gazetteer entries; the driver query adds the nation and region names
# of the driver tables (GPE / LOC).
GAZETTEER_FIXED = [("Apache License", "LAW"), ("General Public License", "LAW"), ("Apache", "ORG"),
                   ("GNU", "ORG"), ("Free Software Foundation", "ORG")]


def gazetteer(spark, sf_dir):
    fixed = spark.createDataFrame(GAZETTEER_FIXED, "name string, raw_label string")
    nations = table(spark, sf_dir, "nation").select(F.initcap("n_name").alias("name"), F.lit("GPE").alias("raw_label"))
    regions = table(spark, sf_dir, "region").select(F.initcap("r_name").alias("name"), F.lit("LOC").alias("raw_label"))
    return fixed.unionByName(nations).unionByName(regions)


ENTITY_COLS = ["doc_id", "entity_name", "entity_type", "raw_label", "pos", "n_mentions", "salience",
               "sentiment_score", "sentiment_magnitude", "extractor"]


def pattern_entities(spark, sf_dir):
    return EN.extract_entities(clean_docs(spark, sf_dir), extracted_at=_ts())


def gazetteer_entities(spark, sf_dir):
    m = EN.extract_gazetteer(clean_docs(spark, sf_dir), gazetteer(spark, sf_dir))
    e = EN.entity_salience(EN.dedupe_mentions(m))
    return e.select(
        "doc_id", F.col("name").alias("entity_name"), EN.label_type("raw_label").alias("entity_type"), "raw_label",
        "pos", "n_mentions", "salience", F.lit(0.0).alias("sentiment_score"), F.lit(0.0).alias("sentiment_magnitude"),
        F.lit("gazetteer").alias("extractor"), _ts().alias("extracted_at"))


@query("extract_entities_pattern")
def q_extract_entities_pattern(spark, sf_dir):
    return EN.extract_mentions(clean_docs(spark, sf_dir))


@query("extract_entities_gazetteer")
def q_extract_entities_gazetteer(spark, sf_dir):
    return EN.extract_gazetteer(clean_docs(spark, sf_dir), gazetteer(spark, sf_dir))


@query("extract_gazetteer_trie")
def q_extract_gazetteer_trie(spark, sf_dir):
    """E3 with a dictionary of every 2 to 4 neighbouring words of the benchmark, by a trie."""
    from textmill.operators import gazetteer as GZ

    words = F.regexp_extract_all(F.lower("text"), F.lit("[a-z0-9]+"), 0)
    items = table(spark, sf_dir, "benchmark").select(words.alias("w"))
    from_each = lambda n: lambda i: F.array_join(F.slice("w", i, n), " ")
    grams = [F.transform(F.sequence(F.lit(1), F.greatest(F.size("w") - n + 1, F.lit(1))), from_each(n)) for n in (2, 3, 4)]
    names = items.select(F.explode(F.concat(*grams)).alias("name")).where(F.col("name").contains(" ")).distinct()
    label = F.concat(F.lit("WORDS_"), F.size(F.split("name", " ")).cast("string"))
    return GZ.extract_gazetteer(clean_docs(spark, sf_dir), names.select("name", label.alias("raw_label")))


@query("label_map")
def q_label_map(spark, sf_dir):
    m = EN.extract_mentions(clean_docs(spark, sf_dir)).unionByName(
        EN.extract_gazetteer(clean_docs(spark, sf_dir), gazetteer(spark, sf_dir)))
    return m.groupBy("raw_label", EN.label_type("raw_label").alias("entity_type")).agg(
        F.count(F.lit(1)).alias("n_mentions"))


@query("dedupe_mentions")
def q_dedupe_mentions(spark, sf_dir):
    return EN.dedupe_mentions(EN.extract_mentions(clean_docs(spark, sf_dir)))


@query("entity_salience")
def q_entity_salience(spark, sf_dir):
    return EN.entity_salience(EN.dedupe_mentions(EN.extract_mentions(clean_docs(spark, sf_dir))))


@query("entity_sentiment")
def q_entity_sentiment(spark, sf_dir):
    return pattern_entities(spark, sf_dir).select(*ENTITY_COLS)


@query("document_categories")
def q_document_categories(spark, sf_dir):
    cats = EN.document_categories(clean_docs(spark, sf_dir))
    return cats.select("doc_id", F.size("categories").alias("n_categories"),
                       F.array_join("categories", "|").alias("categories"))


def _all_entities(spark, sf_dir):
    return EN.entities_union(pattern_entities(spark, sf_dir), gazetteer_entities(spark, sf_dir))


def all_entities(spark, sf_dir):
    """The stored ``entities`` table of all extractors."""
    return staged("entities", spark, sf_dir, _all_entities)


def _stored_entities(spark, sf_dir):
    good = table(spark, sf_dir, "labels").filter(F.col("quality") == 1).select("doc_id")
    return all_entities(spark, sf_dir).filter(F.col("extractor") == "pattern").join(good, "doc_id", "left_semi")


@query("entities_union")
def q_entities_union(spark, sf_dir):
    return _all_entities(spark, sf_dir).select(*ENTITY_COLS)


@query("extract_entities_baseline")
def q_extract_entities_baseline(spark, sf_dir):
    """The local baseline's cut is this extractor's feature."""
    return EN.extract_mentions(clean_docs(spark, sf_dir), max_chars=EN.NER_CHARS)


@query("extract_entities_service")
def q_extract_entities_service(spark, sf_dir):
    """The service extractor reads the first 99,000 bytes."""
    return EN.extract_entities(clean_docs(spark, sf_dir), extractor="service", extracted_at=_ts(),
                               max_bytes=EN.API_BYTES).select(*ENTITY_COLS)


@query("redact_pii")
def q_redact_pii(spark, sf_dir):
    from textmill.operators.redact import redact

    return redact(docs(spark, sf_dir).select("doc_id", "text")).select(
        "doc_id", "n_email", "n_phone", F.sha2("text", 256).alias("redacted_hash"))


@query("find_secrets")
def q_find_secrets(spark, sf_dir):
    """Every find of every document with its place, overlapping ones as one."""
    from textmill.operators import secrets as SEC

    out = SEC.with_finds(docs(spark, sf_dir).select("doc_id", "text"))
    return out.select("doc_id", F.explode("finds").alias("x")).select("doc_id", F.col("x.start").alias("start"), F.col("x.stop").alias("stop"), "x.kind")


@query("redact_secrets")
def q_redact_secrets(spark, sf_dir):
    from textmill.operators import secrets as SEC

    return SEC.redact_secrets(docs(spark, sf_dir).select("doc_id", "text")).select("doc_id", F.size("finds").alias("n_finds"), F.sha2("text", 256).alias("redacted_hash"))


@query("secrets_report")
def q_secrets_report(spark, sf_dir):
    from textmill.operators import secrets as SEC

    return SEC.secrets_report(docs(spark, sf_dir).select("doc_id", "text"))


@query("top_entities_per_doc")
def q_top_entities_per_doc(spark, sf_dir):
    return EN.top_entities_per_doc(all_entities(spark, sf_dir)).select(
        "doc_id", "rank", "entity_name", "entity_type", "salience", "extractor")


@query("entities_lookup_or_compute")
def q_entities_lookup_or_compute(spark, sf_dir):
    d = clean_docs(spark, sf_dir)
    # the stored table holds the entities of the quality-labelled documents
    cache = staged("entities_stored", spark, sf_dir, _stored_entities)
    ids = table(spark, sf_dir, "labels").select("doc_id")
    out = EN.entities_lookup_or_compute(ids, cache, d, lambda x: EN.extract_entities(x, extracted_at=_ts()))
    return out.select("doc_id", "entity_name", "entity_type", "n_mentions", "salience", "source")


@query("entities_write_back")
def q_entities_write_back(spark, sf_dir):
    """E12 with a store: asked twice, the second time everything comes from the store."""
    d = clean_docs(spark, sf_dir)
    ids = table(spark, sf_dir, "labels").select("doc_id")
    extract = lambda x: EN.extract_entities(x, extracted_at=_ts())
    store = EN.entity_store(spark, S.scratch_path(spark, "entity-store"), extract(d.limit(0)).schema)
    runs = [EN.entities_write_back(ids, store, d, extract, "pattern-1").withColumn("run", F.lit(k)) for k in (1, 2)]
    return runs[0].unionByName(runs[1]).select("run", "doc_id", "entity_name", "entity_type", "n_mentions", "salience", "source")


@query("extraction_report")
def q_extraction_report(spark, sf_dir):
    return EN.extraction_report(all_entities(spark, sf_dir), clean_docs(spark, sf_dir))


@query("truncate_bytes")
def q_truncate_bytes(spark, sf_dir):
    t = T.truncate_bytes("text", 1_000)
    return docs(spark, sf_dir).select("doc_id", F.octet_length(t).alias("bytes"), F.length(t).alias("chars"))


# --- 2.7 entity aggregation -------------------------------------------------

from textmill.operators import aggregate as A  # noqa: E402


def requested_ids(spark, sf_dir):
    """Request list: every labelled document, toxic ones listed twice (duplicates
    in a request are legal and count toward doc_count)."""
    lab = table(spark, sf_dir, "labels")
    return lab.select("doc_id").unionAll(lab.filter(F.col("toxic") == 1).select("doc_id"))


@query("aggregate_entities")
def q_aggregate_entities(spark, sf_dir):
    return A.aggregate_entities(all_entities(spark, sf_dir), requested_ids(spark, sf_dir), top_n=10)


@query("sentiment_distribution")
def q_sentiment_distribution(spark, sf_dir):
    return A.sentiment_distribution(all_entities(spark, sf_dir), requested_ids(spark, sf_dir))


@query("aggregate_entities_summary")
def q_aggregate_entities_summary(spark, sf_dir):
    return A.aggregate_entities_summary(all_entities(spark, sf_dir), requested_ids(spark, sf_dir))


# --- 2.6 summarisation --------------------------------------------------------

from textmill.operators import summarize as Z  # noqa: E402


@query("textrank_summary")
def q_textrank_summary(spark, sf_dir):
    return Z.textrank_summary(clean_docs(spark, sf_dir))


def styles(spark, sf_dir):
    """The stored ``summaries`` table."""
    return staged("summaries", spark, sf_dir, lambda s, d: Z.summary_styles(clean_docs(s, d)))


@query("summary_styles")
def q_summary_styles(spark, sf_dir):
    return Z.summary_styles(clean_docs(spark, sf_dir)).select("doc_id", "tldr", F.array_join("bullets", " | ").alias("bullets"), "abstract")


@query("summary_route")
def q_summary_route(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", F.length("text").cast("bigint").alias("text_chars"),
                                      Z.summary_route("text").alias("route"))


@query("chunk_documents")
def q_chunk_documents(spark, sf_dir):
    ch = Z.chunk_documents(docs(spark, sf_dir))
    return ch.select("doc_id", "chunk_no", F.length("chunk").alias("chunk_chars"), F.sha2("chunk", 256).alias("chunk_hash"))


# The driver corpus has few texts above 16,000 characters; the map/reduce
# query routes at 4,000 and chunks at 2,000 so that path carries real load.
MR_THRESHOLD, MR_CHUNK = 4_000, 2_000


@query("map_reduce_summary")
def q_map_reduce_summary(spark, sf_dir):
    out = Z.map_reduce_summary(clean_docs(spark, sf_dir), threshold=MR_THRESHOLD, chunk=MR_CHUNK)
    return out.select("doc_id", "route", "tldr", F.array_join("bullets", " | ").alias("bullets"), "abstract")


def _stored_summaries(spark, sf_dir):
    good = table(spark, sf_dir, "labels").filter(F.col("quality") == 1).select("doc_id")
    return styles(spark, sf_dir).join(good, "doc_id", "left_semi")


def stored_summaries(spark, sf_dir):
    """Summaries written earlier, for the quality-labelled documents."""
    return staged("summaries_stored", spark, sf_dir, _stored_summaries)


@query("summary_lookup_or_compute")
def q_summary_lookup_or_compute(spark, sf_dir):
    ids = table(spark, sf_dir, "labels").select("doc_id")
    return Z.summary_lookup_or_compute(ids, stored_summaries(spark, sf_dir), clean_docs(spark, sf_dir), style="abstract")


COMPARE_FOCUS = "What do these documents have in common?"


@query("compare_summaries")
def q_compare_summaries(spark, sf_dir):
    from pyspark.sql import Window

    lab = table(spark, sf_dir, "labels").select("doc_id")
    src = table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("group_id"))
    w = Window.partitionBy("group_id").orderBy("doc_id")
    # the operator's own cut keeps 8 of each group; the rank filter plans as a WindowGroupLimit
    req = lab.join(src, "doc_id").withColumn("pos", F.row_number().over(w) - 1)
    return Z.compare_summaries(req, styles(spark, sf_dir), F.lit(COMPARE_FOCUS)).select(
        "group_id", "doc_ids_requested", "doc_ids_used", "n_used", F.sha2("prompt", 256).alias("prompt_hash"),
        F.length("prompt").alias("prompt_chars"))


@query("summary_report")
def q_summary_report(spark, sf_dir):
    return Z.summary_report(styles(spark, sf_dir))


# --- 2.8 ROUGE ---------------------------------------------------------------

from textmill.operators import rouge as V  # noqa: E402


def references(spark, sf_dir):
    """Reference summaries: lead-3 sentences of every clean document."""
    return clean_ref(spark, sf_dir).select("doc_id", F.col("reference_summary").alias("text"))


def hypotheses(spark, sf_dir):
    """Two models over the stored summaries: TextRank (its 3 best sentences, every
    clean document) and the abstract, which the documents labelled poor lack, as
    if their summary had failed."""
    made = styles(spark, sf_dir)
    tr = made.select("doc_id", F.lit("textrank").alias("model"), F.array_join("bullets", " ").alias("text"))
    poor = table(spark, sf_dir, "labels").filter(F.col("quality") == 0).select("doc_id")
    ab = made.join(poor, "doc_id", "left_anti").select("doc_id", F.lit("abstract").alias("model"), F.col("abstract").alias("text"))
    return tr.unionByName(ab)


def rouge_pairs(spark, sf_dir):
    return V.pair_frame(references(spark, sf_dir), hypotheses(spark, sf_dir), ["abstract", "textrank"])


@query("rouge_tokens")
def q_rouge_tokens(spark, sf_dir):
    t = V.rouge_tokens("text")
    return references(spark, sf_dir).select("doc_id", F.size(t).alias("n_tokens"), F.array_join(t, " ").alias("tokens"))


@query("rouge_n")
def q_rouge_n(spark, sf_dir):
    return V.rouge_scores(rouge_pairs(spark, sf_dir)).select("doc_id", "model", "rouge1", "rouge2")


@query("rouge_l")
def q_rouge_l(spark, sf_dir):
    return V.rouge_scores(rouge_pairs(spark, sf_dir)).select("doc_id", "model", "rougeL")


@query("rouge_corpus")
def q_rouge_corpus(spark, sf_dir):
    """Corpus ROUGE of the plain words."""
    return V.rouge_corpus(V.rouge_scores(rouge_pairs(spark, sf_dir), stem=False))


@query("eval_unpaired")
def q_eval_unpaired(spark, sf_dir):
    hyp = clean_docs(spark, sf_dir).select("doc_id")
    # references exist for labelled documents; labelled ids outside the clean corpus have no hypothesis
    ref = table(spark, sf_dir, "labels").select("doc_id")
    return V.eval_unpaired(ref, hyp)


# --- 2.10 sessions and cache -------------------------------------------------

from textmill.operators import sessions as SS  # noqa: E402


def conversations(spark, sf_dir):
    return table(spark, sf_dir, "conversations")


@query("session_history")
def q_session_history(spark, sf_dir):
    c = conversations(spark, sf_dir)
    h = SS.session_history(c, session="conv_id", order="turn")
    return h.select("conv_id", "turn", "role", F.sha2("text", 256).alias("text_hash"))


@query("session_append")
def q_session_append(spark, sf_dir):
    c = conversations(spark, sf_dir)
    path = S.scratch_path(spark, "turns")
    ts = F.timestamp_seconds(F.col("turn"))
    SS.append_turns(SS.turn_rows(c, F.col("conv_id"), ts, F.col("role"), F.col("text")), path)
    SS.append_turns(SS.tool_rows(c.filter(F.col("role") == "user"), F.col("conv_id"), ts, F.lit("search_documents"),
                                 F.to_json(F.struct(F.substring("text", 1, 20).alias("query"))),
                                 F.to_json(F.struct(F.length("text").alias("n_chars")))), path)
    log = spark.read.parquet(path)
    return log.groupBy("role").agg(F.count(F.lit(1)).alias("n_turns"),
                                   F.count("tool_name").alias("n_tool_calls"))


@query("history_expand")
def q_history_expand(spark, sf_dir):
    none = F.lit(None).cast("string")
    c = conversations(spark, sf_dir)
    plain = c.select("conv_id", "turn", "role", F.col("text").alias("content"), none.alias("tool_name"),
                     none.alias("args"), none.alias("observation"))
    # every user turn also calls a tool, whose arguments are missing on even turns
    tool = c.filter(F.col("role") == "user").select(
        "conv_id", "turn", F.lit("tool").alias("role"), none.alias("content"), F.lit("search_documents").alias("tool_name"),
        F.when(F.col("turn") % 2 == 1, F.concat(F.lit('{"n": '), F.length("text").cast("string"), F.lit("}"))).alias("args"),
        F.concat(F.lit('{"hash": "'), F.md5("text"), F.lit('"}')).alias("observation"))
    c = plain.unionByName(tool)
    return SS.history_expand(c).select("conv_id", "turn", "part_no", "part_role", "kind",
                                       F.sha2("payload", 256).alias("payload_hash"))


def cache_log(spark, sf_dir):
    """The events table read as a cache log: user_id = doc, event_type = key, props = value."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("doc_id"), F.col("event_type").alias("key"), F.col("props").alias("value"),
        "ts", "event_id")


@query("cache_latest")
def q_cache_latest(spark, sf_dir):
    return SS.cache_latest(cache_log(spark, sf_dir), order=("ts", "event_id"))


@query("cache_incremental")
def q_cache_incremental(spark, sf_dir):
    """C5 in three parts, the oldest entries last, and one part handed over twice."""
    log = cache_log(spark, sf_dir)
    cache = SS.open_cache(spark, S.scratch_path(spark, "cache"), log, order=("ts", "event_id"))
    for k in (2, 1, 1, 0):
        SS.add_to_cache(cache, log.where(F.col("event_id") % 3 == k), f"part-{k}", compact_every=2)
    return SS.cache_now(cache)


@query("cache_lookup")
def q_cache_lookup(spark, sf_dir):
    lab = table(spark, sf_dir, "labels").select("doc_id")
    req = lab.select("doc_id", F.lit("click").alias("key")).unionByName(
        lab.select("doc_id", F.lit("purchase").alias("key")))
    return SS.cache_lookup(req, SS.cache_latest(cache_log(spark, sf_dir), order=("ts", "event_id")))


# --- 2.5 inference stage -------------------------------------------------------

from textmill.operators import inference as L  # noqa: E402


@query("build_requests")
def q_build_requests(spark, sf_dir):
    r = L.build_requests(clean_docs(spark, sf_dir))
    return r.select("doc_id", F.length("request").alias("request_chars"), F.sha2("request", 256).alias("request_hash"))


@query("model_call")
def q_model_call(spark, sf_dir):
    r = L.build_requests(clean_docs(spark, sf_dir))
    out = L.model_call(r, L.echo_model, partitions=int(spark.conf.get("spark.sql.shuffle.partitions", "8")))
    return out.select("doc_id", F.get_json_object("response", "$.core_issue").alias("answer"), "error")


@query("inference_resumed")
def q_inference_resumed(spark, sf_dir):
    """L2 with a log: half of the requests, then all of them; none is sent twice."""
    from textmill.operators import resumable as RES

    r = L.build_requests(clean_docs(spark, sf_dir))
    log = RES.open_answers(spark, S.scratch_path(spark, "answers"))
    RES.answer(r.where("doc_id % 2 = 0"), log, L.echo_model, "echo-1")
    out = RES.answer(r, log, L.echo_model, "echo-1")
    return out.select("doc_id", F.get_json_object("response", "$.core_issue").alias("answer"), "error", "n_sent")


def responses(spark, sf_dir):
    """Model responses for the clean corpus from the native stand-in model.
    Documents labelled toxic get an out-of-enum tone ('toxic'); those also
    labelled low quality get a truncated (malformed) response."""
    lab = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    d = clean_docs(spark, sf_dir).join(lab, "doc_id", "left")
    base = L.local_responses(d.select("doc_id", "text", "quality", "toxic"), keep=("quality", "toxic"))
    tox = F.coalesce(F.col("toxic") == 1, F.lit(False))
    bad = F.coalesce((F.col("toxic") == 1) & (F.col("quality") == 0), F.lit(False))
    resp = F.when(tox, F.regexp_replace("response", '"sentiment_label":"[a-z]+"', '"sentiment_label":"toxic"')) \
        .otherwise(F.col("response"))
    resp = F.when(bad, F.substring(resp, 1, F.length(resp) - 1)).otherwise(resp)
    return base.select("doc_id", resp.alias("response"), "error")


def _parsed(spark, sf_dir):
    return L.parse_extractions(responses(spark, sf_dir))


def parsed(spark, sf_dir):
    """The stored ``extractions`` table."""
    return staged("extractions", spark, sf_dir, _parsed)


@query("parse_extractions")
def q_parse_extractions(spark, sf_dir):
    return _parsed(spark, sf_dir).select(
        "doc_id", "parse_ok", F.length("core_issue").alias("core_issue_chars"), F.size("actors").alias("n_actors"),
        F.size("key_metrics").alias("n_metrics"), F.size("dates").alias("n_dates"), "sentiment_label")


@query("validate_extractions")
def q_validate_extractions(spark, sf_dir):
    return L.validate_extractions(parsed(spark, sf_dir)).select("doc_id", "reject_reason")


@query("inference_quarantine")
def q_inference_quarantine(spark, sf_dir):
    good, dead = L.inference_quarantine(L.validate_extractions(parsed(spark, sf_dir)))
    g = good.agg(F.count(F.lit(1)).alias("n")).select(F.lit("ok").alias("status"), "n")
    b = dead.groupBy(F.col("reject_reason").alias("status")).agg(F.count(F.lit(1)).alias("n"))
    return g.unionByName(b)


@query("json_roundtrip")
def q_json_roundtrip(spark, sf_dir):
    p = parsed(spark, sf_dir).select("doc_id", "actors", "key_metrics", "dates")
    back = L.from_json_columns(L.to_json_columns(p))
    names = F.array_sort(F.transform("actors", lambda a: a["name"]))
    return back.select("doc_id", F.array_join(names, "|").alias("actor_names"),
                       F.array_join(F.array_sort("key_metrics"), "|").alias("metrics"), F.size("dates").alias("n_dates"))


@query("explode_actors")
def q_explode_actors(spark, sf_dir):
    good, _ = L.inference_quarantine(L.validate_extractions(parsed(spark, sf_dir)))
    return L.explode_actors(good)


@query("rouge_stemmed")
def q_rouge_stemmed(spark, sf_dir):
    """Corpus ROUGE with the Porter stemmer on (the reference's scoring setting)."""
    return V.rouge_corpus(V.rouge_scores(rouge_pairs(spark, sf_dir), stem=True))


# --- X2 semantic search ---------------------------------------------------------

from textmill.operators import vectors as VEC  # noqa: E402


@query("semantic_search")
def q_semantic_search(spark, sf_dir):
    """Every vector whose id is divisible by 50 against all vectors."""
    rows = table(spark, sf_dir, "embeddings")
    out = VEC.search(VEC.build_index(rows), rows.where("vec_id % 50 = 0"), top_k=10)
    return out.select(F.col("query").alias("query_id"), "rank", F.col("id").alias("vec_id"), "score")
