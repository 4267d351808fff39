"""Normalisation, cleaning and exact deduplication.

One scan, narrow projections and filters, and a single shuffle (the dedupe
aggregate on the 64-character hash). The aggregate is partial: each map task
keeps one row per hash before the shuffle, so a hash shared by a third of the
corpus collapses map-side instead of landing in one reducer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.functions import lang as L
from textmill.functions import text as T
from textmill.functions.joins import BROADCAST_MAX_ROWS
from textmill.session import barrier, stage_table

TOKEN_MIN = 100
TOKEN_MAX = 5_000
TARGET_LANG = "en"


def normalize_record(df: DataFrame, natural_key: str = "doc_id", source: str | Column | None = None,
                     ingested_at: Column | None = None) -> DataFrame:
    """P1+P2: strip text, content-derived id, source tag, ingest time; drop empty text.

    The id is ``sha256(source \\0 natural_key)``: stable under task retries,
    unlike a random UUID.
    """
    src = F.col("source") if source is None else (F.lit(source) if isinstance(source, str) else source)
    out = df.withColumn("text", T.ustrip("text")).withColumn("source", src)
    out = out.withColumn(
        "doc_uid", F.sha2(F.concat_ws("\u0000", F.col("source"), F.col(natural_key).cast("string")), 256)
    )
    out = out.withColumn("ingested_at", ingested_at if ingested_at is not None else F.current_timestamp())
    return out.filter(F.length("text") > 0)


def with_clean_columns(df: DataFrame, lang_col: Column | None = None) -> DataFrame:
    """P3, P4, P6, P8 as projections (no filter)."""
    out = barrier(df.withColumn("text", T.normalize_whitespace("text")))
    out = out.withColumn("lang", L.detect_language(F.col("text")) if lang_col is None else lang_col)
    out = out.withColumn("token_count", T.token_count("text"))
    return barrier(out.withColumn("text_hash", T.content_hash("text")))


def keep_filter(target_lang: str = TARGET_LANG, token_min: int = TOKEN_MIN, token_max: int = TOKEN_MAX) -> Column:
    """P5 + P7: language equal to the target (null drops) and tokens within range."""
    return (F.col("lang") == F.lit(target_lang)) & F.col("token_count").between(token_min, token_max)


def dedupe_exact(df: DataFrame, key: str = "text_hash", order: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per ``key``, the smallest ``order`` tuple wins (deterministic).

    ``min`` over a struct whose leading fields are the order columns is a
    partial aggregate: map-side combine first, then one shuffle by the hash.
    """
    cols = [c for c in df.columns if c != key]
    rest = [c for c in cols if c not in order]
    packed = F.struct(*[F.col(c) for c in order], *[F.col(c) for c in rest]).alias("w")
    winners = df.groupBy(key).agg(F.min(packed).alias("w"))
    return winners.select(*[F.col(f"w.{c}").alias(c) for c in df.columns if c != key], F.col(key))


#: Bits of a filter of hashes for each hash in it, and of the largest filter that is broadcast (32 MB).
FILTER_BITS, FILTER_MOST = 16, 1 << 28


def hash_filter(keys: DataFrame, key: str, n: int) -> tuple[DataFrame, int]:
    """(slot, bits) bitmaps that say of every key of ``keys`` that it may be there, and the bits
    in all: sized by the ``n`` keys up to a bound, beyond which only more others may be there too."""
    size = 1 << min(max((FILTER_BITS * n - 1).bit_length(), 15), FILTER_MOST.bit_length() - 1)
    at = F.pmod(F.xxhash64(key), F.lit(size))
    return keys.groupBy(F.bitmap_bucket_number(at).alias("slot")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits")), size


def may_hold(df: DataFrame, key: str, bitmaps: DataFrame, size: int) -> DataFrame:
    """``df`` with ``_may``: whether its key may be in the filter. The bitmaps are broadcast
    (``FILTER_MOST`` bits at most)."""
    at = F.pmod(F.xxhash64(key), F.lit(size))
    joined = df.withColumn("slot", F.bitmap_bucket_number(at)).join(F.broadcast(bitmaps), "slot", "left")
    place = F.bitmap_bit_position(at)
    byte = F.conv(F.hex(F.substring("bits", (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    bit = F.call_function("getbit", byte, (place % 8).cast("int"))
    return joined.withColumn("_may", F.coalesce(bit == 1, F.lit(False))).drop("slot", "bits")


def dedupe_texts(df: DataFrame, key: str = "text_hash", order: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """P9 for wide rows: as ``dedupe_exact``, and no text of an unrepeated hash is shuffled.

    ``df`` is written once; ``dedupe_numbered`` does the rest."""
    return dedupe_numbered(number_rows(df), key, order)


def number_rows(df: DataFrame) -> DataFrame:
    """``df`` as a stored table, each row with a number of its own as ``_row``."""
    return stage_table(df.withColumn("_row", F.monotonically_increasing_id()), "dedupe-rows")


def dedupe_numbered(rows: DataFrame, key: str = "text_hash", order: tuple[str, ...] = ("doc_id",), known: DataFrame | None = None) -> DataFrame:
    """``dedupe_texts`` of rows stored by ``number_rows``, without those whose key is in ``known``.

    A narrow aggregate on (hash, order) finds the repeated and the known hashes and the winners
    of the former, combined in the map tasks first. Rows whose hash is not among them pass
    straight through; where these hashes are too many to be broadcast, a filter of them, whose size is
    bounded, tells which rows pass, and only the others are joined."""
    columns = [c for c in rows.columns if c != "_row"]
    winner = F.min(F.struct(*order, "_row")).alias("_first")
    repeated = rows.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_n"), winner)
    kept = F.col("_first._row")
    if known is None:
        repeated = repeated.where("_n > 1")
    else:  # no row has the number -1
        repeated = repeated.join(known.select(F.col(key).alias("_known")).distinct(), F.col("_key") == F.col("_known"), "left")
        repeated = repeated.where("_n > 1 OR _known IS NOT NULL")
        kept = F.when(F.col("_known").isNull(), kept).otherwise(F.lit(-1))
    repeated = stage_table(repeated.select("_key", kept.alias("_kept")), "dedupe-repeated")
    n = repeated.count()
    if n <= BROADCAST_MAX_ROWS // 4:  # a hash and a number each
        out = rows.join(F.broadcast(repeated), F.col(key).eqNullSafe(F.col("_key")), "left").where("_kept IS NULL OR _kept = _row")
        return out.select(*columns)
    marked = may_hold(rows, key, *hash_filter(repeated, "_key", n))
    others = marked.where("_may").join(repeated, F.col(key).eqNullSafe(F.col("_key")), "left").where("_kept IS NULL OR _kept = _row")
    return marked.where("NOT _may").select(*columns).unionByName(others.select(*columns))


def store_clean_documents(df: DataFrame, target_lang: str = TARGET_LANG, token_min: int = TOKEN_MIN,
                          token_max: int = TOKEN_MAX, lang_col: Column | None = None,
                          order: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """P10 as a stored table: the rows of ``clean_documents``, deduplicated by ``dedupe_texts``."""
    kept = with_clean_columns(df, lang_col).filter(keep_filter(target_lang, token_min, token_max))
    return stage_table(dedupe_texts(kept, order=order), "documents_clean")


def clean_documents(df: DataFrame, target_lang: str = TARGET_LANG, token_min: int = TOKEN_MIN,
                    token_max: int = TOKEN_MAX, lang_col: Column | None = None,
                    order: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """P10: normalise -> language -> filter -> token range -> hash -> dedupe.

    Input columns are preserved (``text`` replaced by its normalised form).
    """
    staged = with_clean_columns(df, lang_col)
    kept = staged.filter(keep_filter(target_lang, token_min, token_max))
    out = dedupe_exact(kept, order=order)
    return out.select(*staged.columns)


def clean_report(df: DataFrame, target_lang: str = TARGET_LANG, token_min: int = TOKEN_MIN,
                 token_max: int = TOKEN_MAX, lang_col: Column | None = None) -> DataFrame:
    """rows_in, rows_out, dropped, and drops by reason in pipeline order.

    Reasons: language, too short, too long, duplicate. One partial aggregate on
    the hash feeds a second, one-row aggregate.
    """
    staged = with_clean_columns(df, lang_col).select("text_hash", "lang", "token_count")
    reason = (
        F.when(F.col("lang").isNull() | (F.col("lang") != target_lang), F.lit("lang"))
        .when(F.col("token_count") < token_min, F.lit("short"))
        .when(F.col("token_count") > token_max, F.lit("long"))
    )
    per_hash = (
        staged.withColumn("reason", reason)
        .groupBy("text_hash", "reason")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return per_hash.agg(
        F.sum("n").cast("bigint").alias("rows_in"),
        F.count_if(F.col("reason").isNull()).cast("bigint").alias("rows_out"),
        (F.sum("n") - F.count_if(F.col("reason").isNull())).cast("bigint").alias("dropped"),
        F.coalesce(F.sum(F.when(F.col("reason") == "lang", F.col("n"))), F.lit(0)).cast("bigint").alias("dropped_lang"),
        F.coalesce(F.sum(F.when(F.col("reason") == "short", F.col("n"))), F.lit(0)).cast("bigint").alias("dropped_short"),
        F.coalesce(F.sum(F.when(F.col("reason") == "long", F.col("n"))), F.lit(0)).cast("bigint").alias("dropped_long"),
        F.coalesce(F.sum(F.when(F.col("reason").isNull(), F.col("n") - 1)), F.lit(0)).cast("bigint").alias("dropped_duplicate"),
    )
