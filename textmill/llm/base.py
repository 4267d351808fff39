"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.session import stage_table

#: A word of every contract in this subpackage: a run of bytes that are not ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

#: Bytes of text that one numpy pass works on; a longer single text is a pass of its own.
PASS_BYTES = 1 << 20


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once under the shared checkpoint folder and scan it from there: the
    lineage is cut, and a lost executor loses nothing that is not in that folder."""
    return stage_table(df, f"llm-{name}")


def packed(docs: DataFrame, *names: str) -> DataFrame:
    """Every row of ``docs`` as one struct ``row``, and beside it only the columns ``names`` that an
    operator reads: whatever other columns are called, they meet none of the operator's own."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *names)


def unpacked(rows: DataFrame, columns: list[str]) -> DataFrame:
    return rows.select(*[F.col("row").getField(c).alias(c) for c in columns])


def held_out(doc_id: Column | str) -> Column:
    """True for the documents that no model here learns from."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary") if isinstance(doc_id, str) else doc_id.cast("string").cast("binary")) % 4 == 2


def sampled_texts(rows: DataFrame, max_rows: int, max_bytes: int, max_text_bytes: int = 1 << 20) -> list:
    """At most ``max_rows`` rows (doc_id, text, ...) in the order of a hash of the id, whole
    texts only, until ``max_bytes`` are reached: the bounded training sample of a model.
    Texts over ``max_text_bytes`` are not trained on (they are scored like all others)."""
    rows = rows.where(F.col("text").isNotNull() & (F.octet_length("text") <= max_text_bytes))
    key = [F.xxhash64(F.col("doc_id").cast("string"), F.lit(7)), F.col("doc_id")]
    # the sizes are read first, so that the texts that follow have a known bound
    sizes = rows.select(F.col("doc_id"), F.octet_length("text").alias("n")).orderBy(*key).limit(max_rows).collect()
    ids, total = [], 0
    for r in sizes:
        total += r["n"]
        if total > max_bytes:
            break
        ids.append(r["doc_id"])
    if not ids:
        return []
    spark = rows.sparkSession
    wanted = spark.createDataFrame([(i,) for i in ids], rows.select("doc_id").schema).distinct()
    return rows.join(F.broadcast(wanted), "doc_id", "left_semi").orderBy(*key).limit(max_rows).collect()


def chosen(docs: DataFrame, known: DataFrame, max_rows: int) -> DataFrame:
    """(doc_id, text) of at most ``max_rows`` ids of ``known`` that ``docs`` holds, in the order of
    a hash of the id. The ids meet in narrow tables, then the chosen ones are sent to the
    documents, whose texts stay where they are."""
    here = docs.select("doc_id").join(known.select("doc_id").distinct(), "doc_id", "left_semi")
    ids = here.distinct().orderBy(F.xxhash64(F.col("doc_id").cast("string"), F.lit(7)), "doc_id").limit(max_rows).collect()
    rows = docs.select("doc_id", "text")
    wanted = docs.sparkSession.createDataFrame([(r["doc_id"],) for r in ids], rows.select("doc_id").schema)
    return rows.join(F.broadcast(wanted), "doc_id", "left_semi")


def passes(col: pa.Array, max_bytes: int = PASS_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """Consecutive slices of a string column of about ``max_bytes`` each, and where they begin."""
    if pa.types.is_large_string(col.type):
        col = col.cast(pa.string())
    sizes = pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends, lo = np.cumsum(sizes), 0
    while lo < len(col):
        done = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, done + max_bytes, "right")))
        yield lo, col.slice(lo, hi - lo)
        lo = hi


#: What an operator keeps in a Python worker for its next task there: name -> how to drop it.
KEPT: dict = {}


def tidy(run, keeps: str = ""):
    """``run`` for mapInArrow. Python workers are used again by later operators: what others
    kept is dropped first, and freed memory goes back to the system when the task ends."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from textmill.llm.base import KEPT  # the worker's own

        for name, drop in KEPT.items():
            if name != keeps:
                drop()
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
            if trim is not None:
                trim(0)

    return task


def frame_of(batch: pa.RecordBatch, **columns) -> pa.RecordBatch:
    """The batch's columns (texts left out by the caller) with more columns behind them."""
    arrays = [*batch.columns, *(x if isinstance(x, pa.Array) else pa.array(x) for x in columns.values())]
    return pa.RecordBatch.from_arrays(arrays, [*batch.schema.names, *columns])
