"""Entity extraction (E1-E13), re-aimed from per-row remote/NER calls to
native pattern and dictionary extractors.

The main path (``extract_entities``) is fused and map-only: per document row
it extracts all mentions, de-duplicates them inside the row, scores
salience and sentence-scoped sentiment, and explodes once at the end. No
shuffle, no join back to the text. Whole texts are read; the reference's cuts
(E1: bytes of the service extractor, E2: characters of the local baseline) are
parameters that no operator applies on its own. Separate frame-level forms of
E5/E6 exist for mention tables that come from elsewhere (gazetteer, external
models).
"""

from __future__ import annotations

import functools
import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textmill.functions import text as T
from textmill.functions.joins import bounded_broadcast
from textmill.session import barrier, stage_table
from textmill.sources.committed import CommittedTables

NER_CHARS = 10_000          # E2: baseline extractor truncation (characters)
API_BYTES = 99_000          # E1: service extractor truncation (UTF-8 bytes)
TOP_ENTITIES = 20           # E11
CATEGORY_MIN_SENTENCES = 20  # E9: no categories for short documents
CATEGORY_MIN_HITS = 2
FIRST_WORDS = 2_000         # first words of a gazetteer that are compared inside a row

# Raw-label -> entity type map (13 entries), default OTHER.
LABEL_MAP = {
    "PERSON": "PERSON",
    "ORG": "ORGANIZATION",
    "GPE": "LOCATION",
    "LOC": "LOCATION",
    "DATE": "OTHER",
    "TIME": "OTHER",
    "MONEY": "OTHER",
    "PERCENT": "OTHER",
    "PRODUCT": "CONSUMER_GOOD",
    "EVENT": "EVENT",
    "WORK_OF_ART": "WORK_OF_ART",
    "LAW": "OTHER",
    "NORP": "ORGANIZATION",
}

# Pattern extractors: raw label -> regex (inside the Java/RE2 common subset).
PATTERNS: dict[str, str] = {
    "EMAIL": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}",
    "URL": r"https?://[A-Za-z0-9./?=&#%_:~-]+",
    "PHONE": r"\+?[0-9]{1,3} ?\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}|[0-9]{3}-[0-9]{3}-[0-9]{4}",
    "MONEY": r"[$€£][0-9][0-9,]*(\.[0-9]+)?",
    "PERCENT": r"[0-9]+(\.[0-9]+)?%",
    "DATE": r"[0-9]{4}-[0-9]{2}-[0-9]{2}|(January|February|March|April|May|June|July|August|September|October"
            r"|November|December) [0-9]{1,2}(, [0-9]{4})?",
    "CARDINAL": r"[0-9]{6,}",
    "LAW": r"(Apache|MIT|BSD|Mozilla Public|GNU General Public|GNU Lesser General Public) License",
    "PROPN": r"[A-Z][a-z]+( [A-Z][a-z]+)+",
}

# Sentence sentiment lexicon (polarity +1 / -1).
POSITIVE_WORDS = ("good", "great", "excellent", "positive", "success", "successful", "benefit", "improve",
                  "improved", "gain", "win", "strong", "happy", "growth", "support", "best", "better", "well")
NEGATIVE_WORDS = ("bad", "poor", "negative", "fail", "failed", "failure", "loss", "lose", "weak", "crisis",
                  "death", "killed", "attack", "worse", "worst", "decline", "problem", "risk")

# Keyword profile for document categories.
CATEGORY_PROFILE: dict[str, tuple[str, ...]] = {
    "/Computers & Electronics/Software": ("software", "code", "source", "version", "apache", "gnu", "license",
                                          "licensed", "distributed"),
    "/Finance": ("bank", "money", "market", "price", "percent", "fund", "investment", "tax"),
    "/Law & Government": ("law", "legal", "court", "government", "license", "licensed", "rights", "warranty"),
    "/People & Society": ("people", "family", "community", "children", "public", "social"),
}


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def label_type(raw_label) -> Column:
    """Map a raw label to an entity type, default OTHER."""
    m = F.create_map(*[x for kv in LABEL_MAP.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
    return F.coalesce(F.try_element_at(m, _c(raw_label)), F.lit("OTHER"))


def truncate_chars(text, n: int | None = NER_CHARS) -> Column:
    """The first ``n`` characters; the whole text without ``n``."""
    return _c(text) if n is None else F.substring(_c(text), 1, n)


def extractor_text(text, max_chars: int | None = None, max_bytes: int | None = None) -> Column:
    """The part of a text that an extractor reads: all of it unless a cut is asked for."""
    t = truncate_chars(text, max_chars)
    return t if max_bytes is None else F.when(F.octet_length(t) > max_bytes, T.truncate_bytes(t, max_bytes)).otherwise(t)


def mention_array(text, patterns: dict[str, str] | None = None) -> Column:
    """All pattern mentions of one text as array<struct<name, raw_label, pos>>
    ordered by first position (``pos`` = 1-based position of the first
    occurrence of the surface form)."""
    t = _c(text)
    with_pos = F.transform(mentions_of(t, patterns), lambda m: F.struct(
        F.instr(t, m["name"]).alias("pos"), m["name"].alias("name"), m["raw_label"].alias("raw_label")))
    return F.array_sort(with_pos)


def _mention_struct(lab: str):
    return lambda x: F.struct(x.alias("name"), F.lit(lab).alias("raw_label"))


def extract_mentions(df: DataFrame, text_col: str = "text", key: str = "doc_id",
                     max_chars: int | None = None, patterns: dict[str, str] | None = None) -> DataFrame:
    """E3 (pattern): one row per raw mention: key, name, raw_label, pos."""
    staged = df.select(key, truncate_chars(text_col, max_chars).alias("_t"))
    return staged.select(key, F.explode(mention_array("_t", patterns)).alias("m")).select(
        key, "m.name", "m.raw_label", "m.pos")


def ngram_array(tokens: Column, max_n: int, starts: Column | None = None) -> Column:
    """All 1..max_n word n-grams of a token array, with the start index; with
    ``starts`` only those that begin at one of these places."""
    places = F.sequence(F.lit(1), F.size(tokens)) if starts is None else starts
    places = F.when(F.size(tokens) > 0, places).otherwise(F.array().cast("array<int>"))
    grams = [F.transform(F.filter(places, _fits(tokens, n)), _ngram_at(tokens, n)) for n in range(1, max_n + 1)]
    return F.flatten(F.array(*grams))


def _fits(tokens: Column, n: int):
    return lambda i: i <= F.size(tokens) - (n - 1)


def _ngram_at(tokens: Column, n: int):
    return lambda i: F.struct(
        i.alias("idx"),
        F.array_join(F.slice(tokens, i, n), " ").alias("gram"),
    )


def extract_gazetteer(df: DataFrame, gazetteer: DataFrame, text_col: str = "text", key: str = "doc_id",
                      max_chars: int | None = None) -> DataFrame:
    """E3 (dictionary): n-grams of each text joined to a gazetteer (name, raw_label).

    ``pos`` is the 1-based word index of the match (pattern mentions use the
    character position).

    Matching is case-insensitive on single-space joined words; the surface
    form kept is the document's own. As long as the dictionary has at most
    ``FIRST_WORDS`` distinct first words, n-grams that begin with another word
    are dropped inside the row, before anything is exploded or joined; a hot
    word outside the dictionary then never becomes a row. The gazetteer side is
    broadcast only behind a check of its size; larger dictionaries fall back to
    a shuffle join.
    """
    max_n = max(1, gazetteer.select(F.max(F.size(F.split(F.trim("name"), " +")))).first()[0] or 1)
    gz = gazetteer.select(F.lower(F.regexp_replace(F.trim("name"), " +", " ")).alias("_k"), "raw_label").distinct()
    first = [r[0] for r in gz.select(F.split("_k", " ")[0]).distinct().limit(FIRST_WORDS + 1).collect()]
    t = truncate_chars(text_col, max_chars)
    # tokens become a column first: referenced inside the n-gram lambda, an
    # expression would be re-evaluated for every index. The exploded rows
    # carry only (key, idx, gram), never the text.
    staged = df.select(key, F.regexp_extract_all(t, F.lit(r"[A-Za-z0-9]+"), 0).alias("_toks"))
    starts = None
    if len(first) <= FIRST_WORDS:
        known = sorted(x for x in first if x is not None)
        flags = F.transform("_toks", lambda w, i: F.when(F.lower(w).isin(*known) if known else F.lit(False), i + 1))
        staged = barrier(staged.withColumn("_at", F.array_compact(flags)))
        starts = F.col("_at")
    grams = staged.select(key, F.explode(ngram_array(F.col("_toks"), max_n, starts)).alias("g")).select(
        key, F.col("g.idx").alias("pos"), F.col("g.gram").alias("name"), F.lower(F.col("g.gram")).alias("_k"))
    hits = grams.join(bounded_broadcast(gz), "_k")
    return hits.select(key, "name", "raw_label", "pos")


def dedupe_mentions(mentions: DataFrame, key: str = "doc_id") -> DataFrame:
    """E5: one row per (doc, lower(trim(name)), raw label); first surface form
    (smallest pos, then name) kept; mention count. Partial aggregate."""
    k = F.lower(F.trim(F.col("name")))
    return mentions.groupBy(key, k.alias("_k"), "raw_label").agg(
        F.min(F.struct(F.coalesce(F.col("pos"), F.lit(2 ** 31 - 1)).alias("p"), F.col("name").alias("n"))).alias("first"),
        F.count(F.lit(1)).alias("n_mentions"),
    ).select(key, F.col("first.n").alias("name"), "raw_label",
             F.col("first.p").alias("pos"), F.col("n_mentions").cast("bigint").alias("n_mentions"))


def entity_salience(ents: DataFrame, key: str = "doc_id") -> DataFrame:
    """Mention share within the document, 4 dp (window per document: a
    document's entity rows are bounded by the truncation)."""
    w = Window.partitionBy(key)
    return ents.withColumn("salience", F.round(F.col("n_mentions") / F.sum("n_mentions").over(w), 4))


#: What a match of the library's own patterns cannot lack; with none of it a text need not be searched.
HINTS: dict[str, tuple[str, ...]] = {"EMAIL": ("@",), "URL": ("://",), "MONEY": ("$", "€", "£"), "PERCENT": ("%",), "LAW": (" License",)}
DIGITS = ("PHONE", "MONEY", "PERCENT", "DATE", "CARDINAL")


def mentions_of(text, patterns: dict[str, str] | None = None) -> Column:
    """All pattern mentions of one text as array<struct<name, raw_label>>, pattern by pattern.

    A search costs a pass over the text for each pattern, so those of the library's own that need
    a sign or a digit are only run where there is one."""
    t, none = _c(text), F.array().cast("array<struct<name:string,raw_label:string>>")
    patterns = patterns or PATTERNS
    own = lambda lab: PATTERNS.get(lab) == patterns[lab]

    def found(lab):
        hits = F.transform(F.regexp_extract_all(t, F.lit(patterns[lab]), 0), _mention_struct(lab))
        if not own(lab) or lab not in HINTS:
            return hits
        return F.when(functools.reduce(Column.__or__, [F.contains(t, F.lit(h)) for h in HINTS[lab]]), hits).otherwise(none)

    parts, numeric = [], []
    for lab in patterns:
        if own(lab) and lab in DIGITS:
            numeric.append(found(lab))
            continue
        if numeric:  # neighbours in the order of the patterns share the test
            parts.append(F.when(t.rlike("[0-9]"), F.concat(*numeric)).otherwise(none))
            numeric = []
        parts.append(found(lab))
    if numeric:
        parts.append(F.when(t.rlike("[0-9]"), F.concat(*numeric)).otherwise(none))
    return F.concat(*parts)


def polarity(sentence) -> Column:
    """(pos - neg) / max(pos + neg, 1) of the lexicon's words in a sentence."""
    known = F.filter(T.words(sentence), _in((*POSITIVE_WORDS, *NEGATIVE_WORDS)))
    good = lambda w: F.size(F.filter(w, _in(POSITIVE_WORDS)))
    # bound as the only element of an array, so that the words are taken once
    return F.get(F.transform(F.array(known), lambda w: ((2 * good(w) - F.size(w)) / F.greatest(F.size(w), F.lit(1))).cast("double")), 0)


def sentence_scores(text, patterns: dict[str, str] | None = None) -> Column:
    """Of each sentence with a mention its place ``i``, its mentions ``m`` (name, raw_label) and its
    polarity ``v``. Sentences without a mention have no part in any entity and are not scored."""
    marked = F.transform(T.sentences(text), lambda s, i: F.struct(i.alias("i"), s.alias("s"), mentions_of(s, patterns).alias("m")))
    return F.transform(F.filter(marked, lambda x: F.size(x["m"]) > 0), lambda x: F.struct(x["i"].alias("i"), x["m"].alias("m"), polarity(x["s"]).alias("v")))


def extract_entities(df: DataFrame, text_col: str = "text", key: str = "doc_id", max_chars: int | None = None,
                     patterns: dict[str, str] | None = None, extractor: str = "pattern",
                     extracted_at: Column | None = None, max_bytes: int | None = None) -> DataFrame:
    """E3-E8 fused: the ``entities`` table from pattern extractors, map-only.

    Mentions are taken sentence by sentence (no pattern matches across the end of one), so
    each knows its sentence. Sorted by (name in lower case, label, sentence), the mentions of
    an entity lie together, and one pass over them gives the entity's first surface form, count, salience =
    count / all mentions, sentiment = mean polarity of the sentences that mention it and
    magnitude = sum of their |polarity|: work in proportion to the mentions, but for the sort.
    A name inside another word is no mention. One explode at the end.
    """
    t = extractor_text(text_col, max_chars, max_bytes)
    base = barrier(df.select(key, t.alias("_t")).select(key, "_t", sentence_scores("_t", patterns).alias("_s")))
    own = F.transform("_s", lambda s: F.transform(s["m"], lambda m: F.struct(
        F.lower(F.trim(m["name"])).alias("k"), m["raw_label"].alias("l"), s["i"].alias("i"), m["name"].alias("name"), s["v"].alias("v"))))
    base = barrier(base.select(key, "_t", F.array_sort(F.flatten(own)).alias("_a")).where(F.size("_a") > 0))
    at = lambda i: F.get("_a", i)
    head = lambda i: (i == 0) | (at(i - 1)["k"] != at(i)["k"]) | (at(i - 1)["l"] != at(i)["l"])
    base = barrier(base.withColumn("_h", F.filter(F.sequence(F.lit(0), F.size("_a") - 1), head)))
    total = F.size("_a")

    def entity(begin, place):
        same = F.slice("_a", begin + 1, F.coalesce(F.get("_h", place + 1), total) - begin)
        forms = F.array_distinct(F.transform(same, lambda x: x["name"]))
        first = F.array_min(F.transform(forms, lambda n: F.struct(F.instr(F.col("_t"), n).alias("pos"), n.alias("name"))))
        hit = F.array_distinct(F.transform(same, lambda x: F.struct(x["i"].alias("i"), x["v"].alias("v"))))
        ssum = F.aggregate(hit, F.lit(0.0), lambda acc, x: acc + x["v"])
        sabs = F.aggregate(hit, F.lit(0.0), lambda acc, x: acc + F.abs(x["v"]))
        return F.struct(
            first["name"].alias("name"), at(begin)["l"].alias("raw_label"), first["pos"].alias("pos"),
            F.size(same).cast("bigint").alias("n_mentions"),
            F.round(F.size(same) / total, 4).alias("salience"),
            F.round(ssum / F.size(hit), 4).alias("sentiment_score"),
            F.round(sabs, 4).alias("sentiment_magnitude"),
        )

    ents = base.select(key, F.explode(F.transform("_h", entity)).alias("e")).select(key, "e.*")
    return ents.select(
        key,
        F.col("name").alias("entity_name"),
        label_type("raw_label").alias("entity_type"),
        "raw_label", "pos", "n_mentions", "salience", "sentiment_score", "sentiment_magnitude",
        F.lit(extractor).alias("extractor"),
        (extracted_at if extracted_at is not None else F.current_timestamp()).alias("extracted_at"),
    )


def document_categories(df: DataFrame, text_col: str = "text", key: str = "doc_id", max_chars: int | None = None,
                        profile: dict[str, tuple[str, ...]] | None = None, min_hits: int = CATEGORY_MIN_HITS,
                        min_sentences: int = CATEGORY_MIN_SENTENCES) -> DataFrame:
    """Categories whose keywords occur at least ``min_hits`` times; empty
    for documents with fewer than ``min_sentences`` sentences."""
    profile = profile or CATEGORY_PROFILE
    t = truncate_chars(text_col, max_chars)
    every = sorted({x for kw in profile.values() for x in kw})

    def chosen(hits):
        return F.array_compact(F.array(*[
            F.when(F.size(F.filter(hits, _in(kw))) >= min_hits, F.lit(name)) for name, kw in sorted(profile.items())
        ]))

    # keywords are bound as the only element of an array, so that the words are taken once
    found = F.get(F.transform(F.array(F.filter(T.words(t), _in(every))), chosen), 0)
    return df.select(key, F.when(F.size(T.sentences(t)) >= min_sentences, found)
                     .otherwise(F.array().cast("array<string>")).alias("categories"))


def _in(values):
    return lambda x: x.isin(*values)


def entities_union(*frames: DataFrame) -> DataFrame:
    """Rows of all extractors in one table (tagged by ``extractor``)."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def top_entities_per_doc(ents: DataFrame, n: int = TOP_ENTITIES, key: str = "doc_id") -> DataFrame:
    """Top-n per document by salience (ties: name, type); the rank filter
    plans as a WindowGroupLimit."""
    ties = [c for c in ("extractor", "raw_label") if c in ents.columns]
    w = Window.partitionBy(key).orderBy(F.desc("salience"), "entity_name", "entity_type", *ties)
    return ents.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def entities_lookup_or_compute(ids: DataFrame, cache: DataFrame, docs: DataFrame, compute, key: str = "doc_id") -> DataFrame:
    """Cached entities for requested ids, computed ones for the rest.

    ``left_semi`` against the cache keys gives hits, ``left_anti`` the misses,
    only misses go through ``compute``; ids absent from ``docs`` come back
    with ``source = 'not_found'``.
    """
    req = ids.select(key).distinct()
    cached_keys = cache.select(key).distinct()
    hits = cache.join(req, key, "left_semi").withColumn("source", F.lit("cache"))
    miss_ids = req.join(cached_keys, key, "left_anti")
    miss_docs = docs.join(miss_ids, key, "left_semi")
    computed = compute(miss_docs).withColumn("source", F.lit("computed"))
    absent = miss_ids.join(docs.select(key), key, "left_anti").withColumn("source", F.lit("not_found"))
    return entities_union(hits, computed, absent)


def entity_store(spark, root: str, entities, key: str = "doc_id", kind: str = "bigint"):
    """The tables ``entities`` (of schema ``entities``) and ``done`` (which documents an
    extractor version has worked on, also those in which it found nothing) under ``root``."""
    from pyspark.sql.types import StructField, StructType, _parse_datatype_string

    version = StructField("version", _parse_datatype_string("string"))
    done = StructType([StructField(key, _parse_datatype_string(kind), False), version])
    return CommittedTables.open(spark, root, {"entities": StructType([*entities.fields, version]), "done": done})


def stored_entities(store: CommittedTables, version: str, key: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """(entities, document keys) that were stored by an extractor version. Where two runs have
    stored the same document at the same time, the rows of one of them count."""
    mine = store.read("done").where(F.col("version") == version)
    done = mine.groupBy(key).agg(F.min("batch").alias("batch"))
    ents = store.read("entities").where(F.col("version") == version).join(done, [key, "batch"], "left_semi")
    return ents.drop("version", "batch"), done.select(key)


def entities_write_back(ids: DataFrame, store: CommittedTables, docs: DataFrame, compute, version: str, key: str = "doc_id") -> DataFrame:
    """E12 with a store: entities of the requested documents, with ``source`` cache, computed or
    not_found (a row of its own without an entity).

    What is missing in the store is computed, written back and committed under the extractor
    version, documents without entities included, and then read from there: a second call
    computes nothing, and a call that failed before its commit has left nothing behind."""
    req = ids.select(key).where(F.col(key).isNotNull()).distinct()
    cached, done = stored_entities(store, version, key)
    wanted = bounded_broadcast(stage_table(req.join(done, key, "left_anti"), "entity-wanted"))  # texts stay where they are
    misses = stage_table(docs.join(wanted, key, "left_semi"), "entity-misses")
    batch = None
    if not misses.isEmpty():
        batch = uuid.uuid4().hex
        tag = F.lit(version).alias("version")
        store.write(batch, entities=compute(misses).withColumn("version", tag), done=misses.select(key, tag))
    stored, known = stored_entities(store, version, key)
    new = store.read("done").where(F.col("batch") == (batch or "")).select(key).distinct().withColumn("_new", F.lit(True))
    found = stored.join(req, key, "left_semi").join(new, key, "left")
    found = found.withColumn("source", F.when(F.col("_new"), F.lit("computed")).otherwise(F.lit("cache"))).drop("_new")
    absent = req.join(known, key, "left_anti").withColumn("source", F.lit("not_found"))
    return entities_union(found, absent)


def extraction_report(ents: DataFrame, docs: DataFrame | None = None, key: str = "doc_id") -> DataFrame:
    """Per extractor: documents processed (all of ``docs``), documents with
    entities, entity rows."""
    per_doc = ents.groupBy("extractor", key).agg(F.count(F.lit(1)).alias("n"))
    out = per_doc.groupBy("extractor").agg(
        F.count(F.lit(1)).alias("docs_with_entities"), F.sum("n").cast("bigint").alias("entity_rows"))
    if docs is None:
        return out
    processed = docs.select(F.count_distinct(key).alias("docs_processed"))
    return out.withColumn("docs_processed", processed.scalar())
