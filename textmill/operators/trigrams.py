"""Indexed pattern search (Q1-Q6): the rows of a scan, found without matching every text.

``build_index`` stores the texts in blocks of ``BLOCK`` documents and, for every trigram of
bytes of the lower-cased texts, the documents of a block that hold it; the rows of the index
are sorted by trigram, so that a look-up reads few row groups. ``required`` derives from a
pattern the trigrams that any match must contain: for each alternative a set, of which all must
be there. Of the looked-up trigrams bitmaps are made for each block, intersected within a set
(``bitmap_and_agg``) and united over the alternatives, and the pattern itself runs on what is
left. A pattern from which nothing can be derived, or that leaves candidates in more blocks than
pay, is searched by a scan.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.operators import search as Q
from textmill.session import ensure_checkpoint_dir

#: Documents in a block: the bits of one of Spark's bitmaps.
BLOCK = 32_768
#: Bytes of text that one pass turns into trigrams.
PASS_BYTES = 1 << 20
#: Alternatives, and trigrams of one, that a look-up asks for at most (rarer parts of a long literal add little).
ALTERNATIVES, LOOKED_UP = 64, 16
#: Blocks whose bitmaps (4 KB each) are broadcast; with more candidates a scan costs less.
BLOCKS = 8_192

#: Escapes that mean the same in the JVM's dialect and in Python's.
ESCAPES = re.compile(r"\\(?:[dDwWsSbBntrf]|[^A-Za-z0-9])")


def literal_runs(parsed) -> list[list[str]] | None:
    """For each alternative of a parsed pattern the literal runs that every match of it holds,
    None where that cannot be told."""
    import re._constants as K

    out: list[list[str]] = [[""]]  # the last run of each alternative is still open
    for op, arg in parsed:
        if op is K.LITERAL:
            out = [[*runs[:-1], runs[-1] + chr(arg)] for runs in out]
        elif op is K.SUBPATTERN and not arg[1] and not arg[2]:
            inner = literal_runs(arg[3])
            if inner is None:
                return None
            out = [[*a[:-1], a[-1] + b[0], *b[1:]] for a in out for b in inner]
        elif op is K.BRANCH:
            inner = [literal_runs(x) for x in arg[1]]
            if any(x is None for x in inner):
                return None
            out = [[*a[:-1], a[-1] + b[0], *b[1:]] for a in out for part in inner for b in part]
        elif op in (K.MAX_REPEAT, K.MIN_REPEAT) and arg[0] >= 1:
            inner = literal_runs(arg[2])
            if inner is None:
                return None
            # once for sure: what follows it may be another repetition
            out = [[*a[:-1], a[-1] + b[0], *b[1:], ""] for a in out for b in inner]
        elif op in (K.MAX_REPEAT, K.MIN_REPEAT, K.IN, K.ANY, K.NOT_LITERAL):
            out = [[*runs, ""] for runs in out]
        elif op is K.AT:
            pass
        else:
            return None
        if len(out) > ALTERNATIVES:
            return None
    return out


def required(pattern: str) -> list[list[int]] | None:
    """Trigrams (of UTF-8 bytes, as numbers) that the lower-cased text of every match holds, for
    each alternative; None if some alternative has none or the pattern is not understood."""
    import re._parser as P

    low = pattern.lower()
    plain = ESCAPES.sub("", low)
    if "\\" in plain or "(?" in low.replace("(?:", "") or "&&" in plain or "[]" in plain or "[^]" in plain or re.search(r"\[[^\]]*\[", plain) or re.search(r"[*+?}]\+", plain):
        return None
    try:
        runs = literal_runs(P.parse(low))
    except re.error:
        return None
    if runs is None:
        return None
    sets = []
    for own in runs:
        found = {int.from_bytes(b[k : k + 3]) for b in (x.encode() for x in own) for k in range(len(b) - 2)}
        if not found:
            return None
        sets.append(sorted(found)[:LOOKED_UP])
    return sorted(set(map(tuple, sets)))  # any part of a set is a necessary condition as well


@dataclass(frozen=True)
class TrigramIndex:
    """``texts``: key, text, block, at (place in the block). ``postings``: trigram, block and
    places of texts that hold it (in one row or several), by trigram."""

    texts: DataFrame
    postings: DataFrame
    key: str


def grams_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(trigram, text) of the distinct trigrams of each text, by trigram and text."""
    data = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(texts)], pa.int32()), texts.cast(pa.binary())), b"\0\0\0")
    x = np.frombuffer(data[0].as_buffer(), np.uint8).astype(np.int64)
    lengths = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    if len(x) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    gram = (x[:-2] << 16) | (x[1:-1] << 8) | x[2:]
    begin = np.cumsum(lengths + 3) - lengths - 3
    own = np.repeat(np.arange(len(texts)), lengths + 3)[: len(gram)]
    inside = np.arange(len(gram)) <= begin[own] + lengths[own] - 3
    pair = np.unique((gram[inside] << 32) | own[inside])
    return pair >> 32, pair & 0xFFFFFFFF


def postings_of(rows: DataFrame) -> DataFrame:
    """(block, at, text) -> trigram, block, places: a row for each trigram of a pass of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            block, at = b.column(0).to_numpy(), b.column(1).to_numpy()
            sizes = np.cumsum(pc.binary_length(b.column(2)).to_numpy(zero_copy_only=False).astype(np.int64))
            lo = 0
            while lo < b.num_rows:  # a pass is of one block
                hi = max(lo + 1, int(np.searchsorted(sizes, (sizes[lo - 1] if lo else 0) + PASS_BYTES, "right")))
                hi = lo + int(np.searchsorted(block[lo:hi] != block[lo], True)) if (block[lo:hi] != block[lo]).any() else hi
                gram, own = grams_of(b.column(2).slice(lo, hi - lo))
                begin = np.flatnonzero(np.diff(gram, prepend=-1))
                places = pa.ListArray.from_arrays(pa.array(np.append(begin, len(gram)), pa.int32()), pa.array(at[lo + own].astype(np.int16)))
                yield pa.RecordBatch.from_arrays([pa.array(gram[begin].astype(np.int32)), pa.array(np.full(len(begin), block[lo])), places], ["trigram", "block", "places"])
                lo = hi

    return rows.select("block", "at", F.lower("text").alias("text")).mapInArrow(run, "trigram int, block long, places array<smallint>")


def build_index(docs: DataFrame, root: str | None = None, key: str = "doc_id", text_col: str = "text") -> TrigramIndex:
    """Store texts and postings under ``root`` (a new folder in the shared one by default).
    Null texts match nothing and are left out."""
    import uuid

    spark = docs.sparkSession
    root = root or f"{ensure_checkpoint_dir(spark).rstrip('/')}/trigrams-{uuid.uuid4().hex}"
    rows = docs.where(F.col(text_col).isNotNull()).select(F.col(key).alias(key), F.col(text_col).alias("text"))
    # (task, place in it) becomes (block, place in the block); no row moves
    number = F.monotonically_increasing_id()
    task, place = F.shiftright(number, 33), number.bitwiseAND((1 << 33) - 1)
    block = task * (1 << 18) + F.floor(place / BLOCK)
    rows.withColumn("block", block.cast("long")).withColumn("at", (place % BLOCK).cast("int")).write.mode("overwrite").parquet(f"{root}/texts")
    texts = spark.read.parquet(f"{root}/texts")
    # by trigram, so that the least and greatest of a row group rule most of them out
    postings = postings_of(texts).repartitionByRange("trigram", "block").sortWithinPartitions("trigram", "block")
    postings.write.mode("overwrite").parquet(f"{root}/postings")
    return TrigramIndex(texts, spark.read.parquet(f"{root}/postings"), key)


def candidates(index: TrigramIndex, sets: list[tuple[int, ...]]) -> DataFrame:
    """(block, bits): the documents that hold all trigrams of one of ``sets``."""
    found = None
    for own in sets:  # at most ALTERNATIVES
        hits = index.postings.where(F.col("trigram").isin([int(t) for t in own]))
        hits = hits.select("trigram", "block", F.explode("places").alias("at")).withColumn("at", F.col("at").cast("long"))
        each = hits.groupBy("trigram", "block").agg(F.bitmap_construct_agg("at").alias("bits"))
        both = each.groupBy("block").agg(F.count(F.lit(1)).alias("n"), F.bitmap_and_agg("bits").alias("bits")).where(F.col("n") == len(own)).select("block", "bits")
        found = both if found is None else found.unionAll(both)
    return found.groupBy("block").agg(F.bitmap_or_agg("bits").alias("bits")).where(F.bitmap_count("bits") > 0)


def survivors(index: TrigramIndex, pattern: str) -> DataFrame:
    """The stored texts that may match: all of them where the index cannot tell."""
    Q.validate_pattern(pattern)
    sets = required(pattern)
    if sets is None:
        return index.texts
    found = candidates(index, sets)
    blocks = [r["block"] for r in found.select("block").limit(BLOCKS + 1).collect()]
    if len(blocks) > BLOCKS:
        return index.texts
    byte = F.conv(F.hex(F.substring("bits", (F.floor(F.col("at") / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    held = F.call_function("getbit", byte, (F.col("at") % 8).cast("int")) == 1
    return index.texts.join(F.broadcast(found), "block").where(held).select(*index.texts.columns)


def match_score(index: TrigramIndex, pattern: str) -> DataFrame:
    """Q1-Q3 by the index: key, text, score and snippet of every match."""
    return Q.match_score(survivors(index, pattern).select(index.key, "text"), pattern)


def search_documents(index: TrigramIndex, pattern: str, top_k: int = Q.TOP_K_DEFAULT, max_k: int = Q.TOP_K_MAX) -> DataFrame:
    """Q4/Q5 by the index: the result of ``search.search_documents``."""
    return Q.search_documents(survivors(index, pattern), pattern, top_k, index.key, max_k=max_k)


def search_report(index: TrigramIndex, patterns: dict[str, str]) -> DataFrame:
    """For each pattern: texts in all, texts on which it ran, texts that match."""
    out = None
    total = index.texts.agg(F.count(F.lit(1)).alias("n_texts"))
    for name, pattern in sorted(patterns.items()):
        left = survivors(index, pattern)
        hit = F.lower("text").rlike(pattern.lower())
        row = left.agg(F.count(F.lit(1)).alias("n_read"), F.coalesce(F.count_if(hit), F.lit(0)).alias("n_matched"))
        row = row.select(F.lit(name).alias("qid"), total.scalar().alias("n_texts"), "n_read", "n_matched")
        out = row if out is None else out.unionAll(row)
    return out
