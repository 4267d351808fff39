"""Quality rules with cross-document line frequency.

Per-text rules count words, symbols, repeated lines and repeated word windows. Across
documents, lines are normalised (lower-cased in A-Z, white space runs as one blank) and
hashed; the distinct documents with a line are counted per host; lines in more documents than
the host's limit are removed; documents that lose too many words are rejected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from textmill.llm import base, scan

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True


def lines_of(col: pa.Array) -> dict[str, np.ndarray]:
    """Per text: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, fingerprint
    (of the whole text), n_lines; and of all lines with a word, in order: line (hash of the
    normalised line), line_words."""
    data, off = scan.flat(col)
    w = scan.words(data, off)
    n = w.n
    total = lambda mask: np.diff(np.concatenate([[0], np.cumsum(mask)])[off])
    out = {"n_words": w.counts, "word_chars": total(w.inside & ((data & 0xC0) != 0x80)), "n_symbols": total(SYMBOLS[data])}
    # 3-word windows that a text holds twice or more
    exact = w.hashes()
    win, at = scan.windows(exact, w.doc, 3)
    key = scan.mix(win + w.doc[at].astype(scan.U) * scan.STEP)
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    again = np.zeros(len(key), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    covered = np.zeros(len(exact), bool)
    for k in range(3):
        covered[at[again] + k] = True
    out["n_repeat_words"] = np.bincount(w.doc[covered], minlength=n)
    # lines with a word: exactly as they are, and normalised
    raw = scan.Runs(data, off, data != 10)
    line = np.searchsorted(raw.start, w.start, "right") - 1
    held, begin, size = np.unique(line, return_index=True, return_counts=True)
    doc = raw.doc[held]
    own = scan.mix(raw.hashes()[held] + doc.astype(scan.U) * scan.STEP)
    out["n_dup_lines"] = np.bincount(doc, minlength=n) - np.bincount(doc[np.unique(own, return_index=True)[1]], minlength=n)
    lower = scan.words(scan.LOWER[data], off).hashes()
    place = np.arange(len(lower)) - np.repeat(begin, size)
    normal = np.add.reduceat(lower * scan.powers(int(size.max()))[place], begin) if len(begin) else np.zeros(0, scan.U)
    out["line"] = scan.mix(normal + size.astype(scan.U))
    out["line_words"] = size
    out["n_lines"] = np.bincount(doc, minlength=n)
    whole = scan.Runs(data, off, np.ones(len(data), bool))
    out["fingerprint"] = np.zeros(n, scan.U)
    out["fingerprint"][whole.doc] = whole.hashes()
    return out


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "fingerprint")


def profile(docs: DataFrame, host: str) -> DataFrame:
    """One row a document: row (a number of its own, fixed once written), doc_id, host, the
    counts of ``lines_of`` and lines (hash and words of each)."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.coalesce(F.col(host).cast("string"), F.lit("")).alias("host"), F.col("text").alias("__text"))
    schema = rows.drop("__text").schema
    for c in COUNTS:
        schema = schema.add(c, "long")
    schema = schema.add("lines", ArrayType(StructType([StructField("line", LongType()), StructField("words", LongType())])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, col in base.passes(b.column(3)):
                x = lines_of(col)
                line = pa.StructArray.from_arrays([pa.array(x["line"].view(np.int64)), pa.array(x["line_words"].astype(np.int64))], ["line", "words"])
                lines = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(x["n_lines"])]).astype(np.int32)), line)
                yield base.frame_of(b.slice(lo, len(col)).select([0, 1, 2]), **{c: x[c].astype(np.int64) if c != "fingerprint" else x[c].view(np.int64) for c in COUNTS}, lines=lines)

    return rows.mapInArrow(base.tidy(run), schema)


#: Distinct documents of a host beyond which a line is frequent: LEAST, if they are more than the
#: part SHARE of the host as well, and MOST in a host of any size.
LEAST, SHARE, MOST = 20, 0.05, 1000


def frequent_lines(profiles: DataFrame, least: int = LEAST, share: float = SHARE, most: int = MOST) -> DataFrame:
    """(host, line, n_docs) of the lines in more than ``least`` and more than ``share`` of the
    distinct documents of their host, or in more than ``most`` of them however large the host
    is. Exact copies of a text count as one document, so that copying a page does not turn its
    lines into boilerplate."""
    texts = profiles.groupBy("host").agg(F.countDistinct("fingerprint").alias("host_docs"))
    # a line key of its own carries few bytes, and equal (host, line, text) meet map-side first
    lines = profiles.select("host", "fingerprint", F.explode("lines.line").alias("line")).distinct()
    counts = lines.groupBy("host", "line").agg(F.count(F.lit(1)).alias("n_docs")).where(F.col("n_docs") > least)
    beyond = (F.col("n_docs") > F.col("host_docs") * share) | (F.col("n_docs") > most)
    return counts.join(texts, "host").where(beyond).select("host", "line", "n_docs")


def judge(docs: DataFrame, host: str = "source", least: int = LEAST, share: float = SHARE, most: int = MOST, depleted: float = 0.5, min_words: int = 50, max_repeat: int = 50) -> DataFrame:
    """doc_id, the counts, base_failed, kept_words (outside removed lines) and kept of every
    document.

    base_failed: under ``min_words`` words, or over ``max_repeat`` per cent of them in
    repeated windows. kept: not base_failed, and at least the part ``depleted`` of the words
    stays. Null and empty texts have no words and fail; a null host is a host of its own
    together with the empty one; repeated rows are judged each; an empty table gives none."""
    rows = base.stage(profile(docs, host), "lines")
    frequent = base.stage(frequent_lines(rows, least, share, most), "lines-frequent")
    lines = rows.select("row", "host", F.explode("lines").alias("l")).select("row", "host", F.col("l.line").alias("line"), F.col("l.words").alias("words"))
    lost = lines.join(frequent.select("host", "line"), ["host", "line"]).groupBy("row").agg(F.sum("words").alias("lost"))
    out = rows.drop("lines", "fingerprint").join(lost, "row", "left")
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat * F.col("n_words"))
    out = out.withColumn("kept_words", F.col("n_words") - F.coalesce("lost", F.lit(0))).withColumn("base_failed", failed)
    kept = ~F.col("base_failed") & (F.col("kept_words") >= F.col("n_words") * depleted)
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept_words", kept.alias("kept"))


def strip(docs: DataFrame, host: str = "source", least: int = LEAST, share: float = SHARE, most: int = MOST) -> DataFrame:
    """``docs`` with the frequent lines of their host taken out of the texts; null texts stay
    null, other columns stay as they are.

    A document carries only the numbers of its own frequent lines: its lines meet the frequent
    ones of its host as (host, line) rows, and what is found is gathered by document."""
    rows = base.stage(docs.select(F.monotonically_increasing_id().alias("row"), F.struct(*docs.columns).alias("doc")), "strip-rows")
    texts = rows.select("row", F.col("doc").getField(host).alias("host"), F.col("doc.text").alias("text")).withColumn("doc_id", F.col("row"))
    found = base.stage(profile(texts, "host"), "strip-lines")  # doc_id is the row's number
    frequent = frequent_lines(found, least, share, most).select("host", "line")
    lines = found.select("doc_id", "host", F.posexplode("lines.line").alias("at", "line"))
    # at most as many as the document has lines
    gone = lines.join(frequent, ["host", "line"]).groupBy(F.col("doc_id").alias("row")).agg(F.collect_set("at").alias("gone"))
    joined = rows.join(gone, "row", "left").select("gone", "doc")
    place, names = docs.columns.index("text"), docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            columns, lost = b.column(1).flatten(), b.column(0).to_pylist()
            texts = columns[place].to_pylist()
            for i, own in enumerate(lost):
                if own:
                    drop, k, kept = set(own), 0, []
                    for x in texts[i].split("\n"):
                        worded = bool(x.strip(" \t\n\v\f\r"))
                        if not (worded and k in drop):
                            kept.append(x)
                        k += worded
                    texts[i] = "\n".join(kept)
            columns[place] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names)

    return joined.mapInArrow(base.tidy(run), docs.schema)
