"""Summarisation (Z1-Z9): length routing, chunk map/reduce, TextRank and the
three summary styles, lookup-or-compute, comparison inputs.

TextRank runs inside each document row, on its array of sentences: no shuffle
and no sentence-pair rows. Splitting and styling are native; the power
iteration is an Arrow-batched UDF whose work follows the words of the document
(``functions/textrank.py``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.functions import text as T
from textmill.functions.textrank import ranks_udf
from textmill.session import barrier

MAP_REDUCE_CHARS = 16_000   # Z1: longer texts go through map/reduce
CHUNK_CHARS = 12_000        # Z2
SUMMARY_SENTENCES = 3       # Z5
DAMPING = 0.85
ITERATIONS = 20
RANK_DIGITS = 9
TLDR_WORDS = 25             # Z6
ABSTRACT_WORDS = 80
COMPARE_MAX_DOCS = 8        # Z8
STYLES = ("tldr", "bullets", "abstract")


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def summary_route(text, threshold: int = MAP_REDUCE_CHARS) -> Column:
    """Z1."""
    return F.when(F.length(_c(text)) <= threshold, F.lit("direct")).otherwise(F.lit("map_reduce"))


def chunk_documents(df: DataFrame, text_col: str = "text", key: str = "doc_id", size: int = CHUNK_CHARS) -> DataFrame:
    """Fixed-size character chunks, no overlap, last one may be short.

    One row per chunk (``chunk_no`` from 0); empty text gives no chunk
    (``sequence(0, -1)`` would count down, so it is guarded)."""
    n = F.ceil(F.length(_c(text_col)) / F.lit(size)).cast("int")
    starts = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    chunks = F.transform(starts, lambda i: F.substring(_c(text_col), i * size + 1, size))
    return df.select(key, F.posexplode(chunks).alias("chunk_no", "chunk"))


def textrank(df: DataFrame, text_col: str = "text", key: str = "doc_id", iterations: int = ITERATIONS,
             damping: float = DAMPING) -> DataFrame:
    """Z5 core: per document ``sents`` (array<string>) and ``ranks`` (array<double>,
    rounded to ``RANK_DIGITS``), same order.

    r' = (1-d)/N + d * W (r / rowsum), with symmetric weights that include the
    self pair, so no sentence is dangling and the rank mass stays 1.
    """
    split = barrier(df.select(key, T.sentences(_c(text_col)).alias("sents")))
    return split.select(key, "sents", ranks_udf(iterations, damping, RANK_DIGITS)("sents").alias("ranks"))


def _ranked(sents: Column, ranks: Column) -> Column:
    """Sentences with (rank, index) in rank order: rank desc, then position."""
    tagged = F.zip_with(sents, ranks, lambda s, r: F.struct(r.alias("r"), s.alias("s")))
    idx = F.transform(tagged, lambda t, i: F.struct((-t["r"]).alias("neg"), i.alias("i"), t["s"].alias("s")))
    return F.array_sort(idx)


def textrank_summary(df: DataFrame, text_col: str = "text", key: str = "doc_id", n: int = SUMMARY_SENTENCES,
                     iterations: int = ITERATIONS) -> DataFrame:
    """The n best sentences, in document order, joined by a space."""
    tr = textrank(df, text_col, key, iterations)
    top = F.slice(_ranked(F.col("sents"), F.col("ranks")), 1, n)
    in_doc_order = F.array_sort(F.transform(top, lambda x: F.struct(x["i"].alias("i"), x["s"].alias("s"))))
    return tr.select(key, F.array_join(F.transform(in_doc_order, lambda x: x["s"]), " ").alias("summary"),
                     F.size("sents").alias("n_sentences"))


def summary_styles(df: DataFrame, text_col: str = "text", key: str = "doc_id", iterations: int = ITERATIONS) -> DataFrame:
    """Z6 (extractive): tldr = best sentence cut to 25 words; bullets = the 3
    best sentences in document order; abstract = sentences in rank order,
    first 80 words."""
    tr = barrier(textrank(df, text_col, key, iterations).select(
        key, _ranked(F.col("sents"), F.col("ranks")).alias("rk")))
    top = F.slice("rk", 1, SUMMARY_SENTENCES)
    bullets = F.transform(F.array_sort(F.transform(top, lambda x: F.struct(x["i"].alias("i"), x["s"].alias("s")))),
                          lambda x: x["s"])
    return tr.select(
        key,
        T.first_n_words(F.try_element_at("rk", F.lit(1))["s"], TLDR_WORDS).alias("tldr"),
        bullets.alias("bullets"),
        T.first_n_words(F.array_join(F.transform("rk", lambda x: x["s"]), " "), ABSTRACT_WORDS).alias("abstract"),
    )


def _assemble(parts: DataFrame, keys: list[str], order: str) -> DataFrame:
    """``[Part i]: abstract`` (1-based) joined by a blank line, per group of keys."""
    grouped = parts.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(order, "abstract"))).alias("p"))
    return grouped.select(*keys, F.array_join(F.transform("p", lambda x: F.concat(
        F.lit("[Part "), (x[order] + 1).cast("string"), F.lit("]: "), x["abstract"])), "\n\n").alias("text"))


def map_reduce_summary(df: DataFrame, text_col: str = "text", key: str = "doc_id", threshold: int = MAP_REDUCE_CHARS,
                       chunk: int = CHUNK_CHARS, iterations: int = ITERATIONS) -> DataFrame:
    """Z1-Z4 + Z6: route by length; long texts are chunked, each chunk is
    summarised in parallel (its abstract kept), parts are assembled as
    ``[Part i]: abstract`` joined by a blank line and summarised again.

    Route and number of chunks travel with the rows: one pass over the chunks
    and one grouping by document. A document's parts are as many as its chunks,
    each at most an abstract long, so the reduce row stays a small fraction of
    the document that was one row already.
    """
    routed = df.select(key, _c(text_col).alias("text"), summary_route(_c(text_col), threshold).alias("route"))
    direct = routed.filter(F.col("route") == "direct").select(F.struct(key, "route").alias("dk"), "text")
    chunks = chunk_documents(routed.filter(F.col("route") == "map_reduce"), "text", key, chunk)
    part = summary_styles(chunks.select(F.struct(key, "chunk_no").alias("ck"), F.col("chunk").alias("text")),
                          "text", "ck", iterations)
    part = part.select(F.col("ck")[key].alias(key), F.col("ck")["chunk_no"].alias("chunk_no"), "abstract")
    assembled = _assemble(part, [key], "chunk_no").select(F.struct(F.col(key), F.lit("map_reduce").alias("route")).alias("dk"), "text")
    out = summary_styles(direct.unionByName(assembled), "text", "dk", iterations)
    return out.select(F.col("dk")[key].alias(key), "tldr", "bullets", "abstract", F.col("dk")["route"].alias("route"))


def validate_style(style: str) -> str:
    if style not in STYLES:
        raise ValueError(f"no summary of style {style!r} is made, only {sorted(STYLES)}")
    return style


def style_column(style: str) -> Column:
    validate_style(style)
    return F.array_join("bullets", "\n") if style == "bullets" else F.col(style)


def summary_lookup_or_compute(ids: DataFrame, stored: DataFrame, docs: DataFrame, style: str = "tldr",
                              key: str = "doc_id", compute=None) -> DataFrame:
    """Stored summary when present, else computed; style chosen (and
    validated) when the plan is built. Unknown ids -> ``not_found``."""
    validate_style(style)
    compute = compute or (lambda d: summary_styles(d, "text", key))
    req = ids.select(key).distinct()
    hits = stored.join(req, key, "left_semi").select(key, style_column(style).alias("summary"),
                                                     F.lit("cache").alias("source"))
    miss = req.join(stored.select(key), key, "left_anti")
    live = compute(docs.join(miss, key, "left_semi")).select(key, style_column(style).alias("summary"),
                                                              F.lit("live").alias("source"))
    absent = miss.join(docs.select(key), key, "left_anti").select(
        key, F.lit(None).cast("string").alias("summary"), F.lit("not_found").alias("source"))
    return hits.unionByName(live).unionByName(absent).withColumn("style", F.lit(style))


def compare_summaries(requests: DataFrame, summaries: DataFrame, focus: Column, group: str = "group_id",
                      pos: str = "pos", key: str = "doc_id", max_docs: int = COMPARE_MAX_DOCS) -> DataFrame:
    """Per request group, the first ``max_docs`` ids in request order;
    ids without a summary are dropped from the prompt but listed in
    ``doc_ids_requested``. The prompt is built for an optional model stage."""
    capped = requests.filter(F.col(pos) < max_docs)
    joined = capped.join(summaries.select(key, "abstract"), key, "left")
    g = joined.groupBy(group).agg(F.sort_array(F.collect_list(F.struct(pos, key, "abstract"))).alias("items"))
    used = F.filter("items", lambda x: x["abstract"].isNotNull())
    combined = F.array_join(F.transform(used, lambda x: F.concat(
        F.lit("["), x[key].cast("string"), F.lit("]: "), x["abstract"])), "\n\n")
    prompt = F.concat(
        F.lit("Question about several texts: "), focus, F.lit("\n\nWhat each text says, by id:\n"), combined,
        F.lit("\n\nAnswer briefly from these only, naming the ids you rely on."))
    return g.select(
        group,
        F.array_join(F.transform("items", lambda x: x[key].cast("string")), "|").alias("doc_ids_requested"),
        F.array_join(F.transform(used, lambda x: x[key].cast("string")), "|").alias("doc_ids_used"),
        F.size(used).alias("n_used"),
        F.when(F.size(used) > 0, prompt).alias("prompt"),
    )


def summary_report(summaries: DataFrame) -> DataFrame:
    """Processed / written / failed (no sentence to extract)."""
    ok = F.coalesce(F.length("abstract"), F.lit(0)) > 0
    return summaries.agg(F.count(F.lit(1)).alias("processed"), F.count_if(ok).alias("written"),
                         F.count_if(~ok).alias("failed"))
