"""Continuous ingestion. Raw documents arrive on a stream, are cleaned (P3-P8), lose exact
duplicates and are appended to a table.

``ingest`` forgets the texts it has seen after a watermark and fails on a bad row.
``ingest_committed`` keeps the hash of every text it ever took in a bucketed index, so that a
duplicate is dropped however late it comes, and puts bad rows with the reason into a
dead-letter table. Documents, dead letters and index of a micro-batch are committed together.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from textmill.operators import clean as C
from textmill.session import stage_table
from textmill.sources.committed import CommittedTables
from textmill.streaming.append import append_stream

BUCKETS = 256
COMPACT_EVERY = 64
DEAD = StructType([StructField("reason", StringType(), False), StructField("payload", StringType())])
SEEN = StructType([StructField("text_hash", StringType(), False), StructField("bucket", StringType(), False)])
CORRUPT = "_corrupt"


def clean_stream(stream: DataFrame, event_time: Column, delay: str = "1 hour", target_lang: str = C.TARGET_LANG,
                 token_min: int = C.TOKEN_MIN, token_max: int = C.TOKEN_MAX) -> DataFrame:
    """The cleaning of ``clean_documents`` on a stream with a text column. Of equal
    texts that arrive within ``delay`` of each other the first is kept; the state
    holds hashes of that time span only."""
    staged = C.with_clean_columns(stream.withColumn("ingested_at", event_time))
    kept = staged.filter(C.keep_filter(target_lang, token_min, token_max))
    return kept.withWatermark("ingested_at", delay).dropDuplicatesWithinWatermark(["text_hash"])


def ingest(stream: DataFrame, path: str, schema: StructType, checkpoint: str, event_time: Column | None = None,
           delay: str = "1 hour", available_now: bool = False) -> StreamingQuery:
    """Start stream -> clean -> deduplicate -> table. Restarted with its checkpoint,
    the query goes on where it stopped and no row is written twice."""
    cleaned = clean_stream(stream, event_time if event_time is not None else F.current_timestamp(), delay)
    return append_stream(cleaned, path, schema, checkpoint, available_now=available_now)


def json_records(lines: DataFrame, schema: StructType) -> DataFrame:
    """Lines of JSON (column ``value``) as the fields of ``schema``, with the whole line as
    ``_corrupt`` where it is no JSON object of these types."""
    wide = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    parsed = F.from_json("value", wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    out = lines.select(parsed.alias("r"), "value")
    # a line without any object parses to null
    bad = F.when(F.col("r").isNull() | F.col("r").getField(CORRUPT).isNotNull(), F.coalesce("value", F.lit("")))
    return out.select(*[F.col("r").getField(f.name).alias(f.name) for f in schema.fields], bad.alias(CORRUPT))


def required(*names: str) -> dict[str, Column]:
    """Rules (reason -> condition of a bad row) for lines that are no records, and for fields
    that must not be null."""
    return {"malformed": F.col(CORRUPT).isNotNull()} | {f"null {n}": F.col(n).isNull() for n in names}


def open_ingested(spark: SparkSession, root: str, schema: StructType) -> CommittedTables:
    """The tables ``documents`` (of ``schema``), ``dead`` and ``seen`` under ``root``."""
    return CommittedTables.open(spark, root, {"documents": schema, "dead": DEAD, "seen": SEEN}, {"seen": "bucket"})


def take_batch(tables: CommittedTables, batch: DataFrame, name: str, rules: dict[str, Column], clean: Callable[[DataFrame], DataFrame]) -> bool:
    """One batch into all three tables; False if it was committed before.

    Rows that a rule finds bad become dead letters with the first such rule's name. The others
    are cleaned (``clean`` gives them a ``text_hash`` and filters); of equal texts one is taken, if none
    was ever before. Only the buckets of the index that the batch needs are read, and hashes,
    not texts, are shuffled to find what was taken before."""
    if tables.has(name):
        return False
    reason = F.coalesce(*[F.when(bad, F.lit(why)) for why, bad in rules.items()], F.lit(None).cast("string"))
    marked = stage_table(batch.withColumn("_reason", reason), "ingest-batch")  # read twice, and the same both times
    payload = F.to_json(F.struct(*[F.col(c) for c in batch.columns]))
    tables.put(name, "dead", marked.where("_reason IS NOT NULL").select(F.col("_reason").alias("reason"), payload.alias("payload")))
    good = C.number_rows(clean(marked.where("_reason IS NULL").drop("_reason", CORRUPT)))
    bucket = F.lpad(F.conv(F.substring("text_hash", 1, 2), 16, 10), 3, "0")  # BUCKETS of them
    touched = [r["bucket"] for r in good.select(bucket.alias("bucket")).distinct().collect()]  # at most BUCKETS
    seen = tables.read("seen").where(F.col("bucket").isin(touched)).select("text_hash")
    order = ("ingested_at", "doc_id")  # and all else that the table holds, as equal hashes have equal texts
    order += tuple(c for c in good.columns if c in tables.tables["documents"].names and c not in (*order, "text", "text_hash"))
    taken = tables.put(name, "documents", C.dedupe_numbered(good, order=order, known=seen))
    tables.put(name, "seen", taken.select("text_hash", bucket.alias("bucket")))
    tables.commit(name)
    return True


def ingest_committed(stream: DataFrame, root: str, schema: StructType, checkpoint: str, rules: dict[str, Column], event_time: Column | None = None,
                     available_now: bool = False, compact_every: int = COMPACT_EVERY) -> StreamingQuery:
    """Start stream -> rules -> clean -> lasting deduplication -> ``documents``, ``dead``, ``seen``
    under ``root`` (``open_ingested`` reads them). ``schema`` has at least doc_id, text_hash and
    ingested_at. A batch that Spark hands over again after a failure is committed once."""
    tables = open_ingested(stream.sparkSession, root, schema)

    def clean(rows: DataFrame) -> DataFrame:
        staged = C.with_clean_columns(rows.withColumn("ingested_at", event_time if event_time is not None else F.current_timestamp()))
        return staged.where(C.keep_filter())

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        own = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        here = CommittedTables(batch.sparkSession, tables.root, tables.tables, tables.split)
        if take_batch(here, batch, f"{own}-{batch_id}", rules, clean) and (batch_id + 1) % compact_every == 0:
            here.compact("seen")

    w = stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w).start()
