"""Independent DuckDB SQL for every checkable query in ``catalog``.

Written against the raw driver tables (views ``documents``, ``conversations``,
``events``, ``embeddings``, ...). Shared fragments are SQL text only; none of
it is generated from the DataFrame code.
"""

from __future__ import annotations

# Fixed values shared with the library (same literal strings).
WS_BODY = (
    r"\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)
STRIP_RE = f"^[{WS_BODY}]+|[{WS_BODY}]+$"
NONWS_RE = f"[^{WS_BODY}]+"

PROFILE_SQL = {
    "de": "['der','die','und','den','von','zu','das','mit','ein','sich','für','auf','nicht','ist','dem','im','eine','auch']",
    "en": "['the','of','and','to','a','is','that','it','for','was','on','with','as','by','this','are','from','at']",
    "es": "['el','los','las','y','se','del','por','con','no','su','para','una','es','al','lo','como','más','pero']",
    "fr": "['le','et','les','des','du','une','pour','est','dans','qui','sur','par','pas','au','avec','aux','elle','ce']",
}


def strip_sql(x: str) -> str:
    return f"regexp_replace({x}, '{STRIP_RE}', '', 'g')"


def norm_sql(x: str) -> str:
    t = f"regexp_replace({x}, '\\r\\n|\\r', chr(10), 'g')"
    t = f"regexp_replace({t}, '[ \\t]+', ' ', 'g')"
    t = f"regexp_replace({t}, '\\n{{3,}}', chr(10) || chr(10), 'g')"
    return strip_sql(t)


def ntok_sql(x: str) -> str:
    return f"CAST(len(regexp_extract_all({x}, '{NONWS_RE}')) AS BIGINT)"


def lang_sql(x: str) -> str:
    toks = f"regexp_extract_all(lower(substr({x}, 1, 500)), '[a-zà-ÿ]+')"
    hits = {k: f"len(list_filter({toks}, lambda w: list_contains({v}, w)))" for k, v in PROFILE_SQL.items()}
    best = f"greatest({', '.join(hits.values())})"
    cases = " ".join(f"WHEN {h} = {best} THEN '{k}'" for k, h in sorted(hits.items()))
    return f"CASE WHEN {best} <= 0 THEN NULL {cases} END"


# Staged documents: normalised text + language vote + token count + hash.
STAGED = f"""
staged AS (
  SELECT doc_id, source, n_chars, t AS text, {lang_sql('t')} AS lang, {ntok_sql('t')} AS token_count,
         sha256(t) AS text_hash
  FROM (SELECT doc_id, source, n_chars, {norm_sql('text')} AS t FROM documents)
)"""

CLEAN = STAGED + """,
clean AS (
  SELECT * FROM staged
  WHERE lang = 'en' AND token_count BETWEEN 100 AND 5000
  QUALIFY row_number() OVER (PARTITION BY text_hash ORDER BY doc_id) = 1
)"""


ORACLE: dict[str, str] = {}

ORACLE["clean_documents"] = f"""
WITH {CLEAN}
SELECT doc_id, source, lang, token_count, text_hash, CAST(length(text) AS BIGINT) AS n_chars FROM clean
"""

ORACLE["search_documents"] = f"""
WITH {CLEAN}
SELECT doc_id, substr(text, 1, 300) AS snippet,
       CAST(len(regexp_extract_all(lower(text), 'th[a-z]*tion')) AS BIGINT) AS score
FROM clean
WHERE regexp_matches(lower(text), 'th[a-z]*tion')
ORDER BY score DESC, doc_id
LIMIT 10
"""

ORACLE["scan_limit"] = "SELECT doc_id, source, n_chars FROM documents ORDER BY doc_id LIMIT 500"

ORACLE["jsonl_roundtrip"] = """
SELECT source, count(*) AS n_docs, CAST(sum(length(text)) AS BIGINT) AS total_chars,
       min(doc_id) AS min_doc_id, max(doc_id) AS max_doc_id
FROM documents GROUP BY source
"""

ORACLE["sql_search"] = """
SELECT doc_id, CAST(len(regexp_extract_all(lower(text), 'schaft|ung')) AS BIGINT) AS score
FROM documents WHERE regexp_matches(lower(text), 'schaft|ung')
"""



def sentences_sql(x: str) -> str:
    ends = f"regexp_replace({x}, '([.!?]+)[ \\t\\n]+', '\\1' || chr(10), 'g')"
    return (f"list_filter(list_transform(string_split({ends}, chr(10)), lambda s: {strip_sql('s')}), "
            f"lambda s: regexp_matches(s, '[A-Za-z0-9]'))")


ORACLE["eval_sample"] = f"""
WITH {CLEAN}
SELECT doc_id, token_count, array_to_string({sentences_sql('text')}[1:3], ' ') AS reference_summary
FROM clean ORDER BY doc_id LIMIT 100
"""

ORACLE["fetch_by_id"] = """
SELECT l.doc_id, d.doc_id IS NOT NULL AS found, CAST(length(d.text) AS BIGINT) AS text_chars,
       sha256(d.text) AS text_hash
FROM labels l LEFT JOIN documents d ON l.doc_id = d.doc_id
"""

ORACLE["normalize_record"] = f"""
SELECT doc_id, sha256(source || chr(0) || CAST(doc_id AS VARCHAR)) AS doc_uid, source,
       CAST(length({strip_sql('text')}) AS BIGINT) AS text_chars, '2024-01-01 00:00:00' AS ingested_at
FROM documents WHERE length({strip_sql('text')}) > 0
"""

NOISY = "' ' || chr(9) || replace(replace(text, ' ', ' ' || chr(9) || ' '), chr(10), repeat(chr(13) || chr(10), 3)) || chr(13) || chr(10) || ' '"

ORACLE["normalize_whitespace"] = f"""
SELECT doc_id, sha256({norm_sql(NOISY)}) AS norm_hash, CAST(length({norm_sql(NOISY)}) AS BIGINT) AS norm_chars,
       {norm_sql(NOISY)} = {norm_sql('text')} AS same_as_clean
FROM documents
"""

ORACLE["detect_language"] = f"""
SELECT doc_id, lang AS lang_given, {lang_sql(norm_sql('text'))} AS lang_detected FROM documents
"""

ORACLE["token_count"] = f"""
SELECT doc_id, {ntok_sql('text')} AS token_count,
       {ntok_sql("replace(text, ' ', chr(160) || chr(8195) || chr(28))")} AS token_count_unicode_ws
FROM documents
"""

ORACLE["content_hash"] = "SELECT doc_id, sha256(text) AS text_hash FROM documents"

ORACLE["dedupe_exact"] = """
SELECT doc_id, source, sha256(text) AS text_hash FROM documents
QUALIFY row_number() OVER (PARTITION BY sha256(text) ORDER BY doc_id) = 1
"""

ORACLE["clean_report"] = f"""
WITH {STAGED},
r AS (SELECT *, CASE WHEN lang IS NULL OR lang <> 'en' THEN 'lang' WHEN token_count < 100 THEN 'short'
                     WHEN token_count > 5000 THEN 'long' END AS reason FROM staged)
SELECT CAST(count(*) AS BIGINT) AS rows_in,
       CAST(count(DISTINCT text_hash) FILTER (WHERE reason IS NULL) AS BIGINT) AS rows_out,
       CAST(count(*) - count(DISTINCT text_hash) FILTER (WHERE reason IS NULL) AS BIGINT) AS dropped,
       CAST(count(*) FILTER (WHERE reason = 'lang') AS BIGINT) AS dropped_lang,
       CAST(count(*) FILTER (WHERE reason = 'short') AS BIGINT) AS dropped_short,
       CAST(count(*) FILTER (WHERE reason = 'long') AS BIGINT) AS dropped_long,
       CAST(count(*) FILTER (WHERE reason IS NULL) - count(DISTINCT text_hash) FILTER (WHERE reason IS NULL) AS BIGINT)
         AS dropped_duplicate
FROM r
"""

_BATCH = [("q_de", "schaft|ung"), ("q_en", "th[a-z]*tion"), ("q_es", "ción"), ("q_fr", "ment"), ("q_num", "[0-9]+")]

ORACLE["search_batch"] = "WITH s AS (" + " UNION ALL ".join(
    f"SELECT '{q}' AS qid, doc_id, substr(text, 1, 300) AS snippet, "
    f"CAST(len(regexp_extract_all(lower(text), '{p}')) AS BIGINT) AS score FROM documents"
    for q, p in _BATCH
) + """)
SELECT qid, CAST(row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id) AS INTEGER) AS rank,
       doc_id, snippet, score
FROM s WHERE score > 0
QUALIFY rank <= 5
"""

# --- corpus statistics --------------------------------------------------------

CLEAN_REF = CLEAN + f""",
cref AS (SELECT *, array_to_string({sentences_sql('text')}[1:3], ' ') AS reference_summary FROM clean),
lens AS (SELECT doc_id, token_count, CAST(length(text) AS BIGINT) AS char_count,
                CAST(len(regexp_extract_all(text, '[.!?]+')) AS BIGINT) AS sent_count,
                CASE WHEN reference_summary IS NOT NULL THEN {ntok_sql('reference_summary')} END AS summary_token_count
         FROM cref)"""

ORACLE["doc_lengths"] = f"WITH {CLEAN_REF} SELECT * FROM lens"

ORACLE["describe_lengths"] = f"""
WITH {CLEAN_REF},
st AS (
  SELECT 'token_count' AS metric, CAST(token_count AS DOUBLE) AS v FROM lens UNION ALL
  SELECT 'char_count', CAST(char_count AS DOUBLE) FROM lens UNION ALL
  SELECT 'sent_count', CAST(sent_count AS DOUBLE) FROM lens UNION ALL
  SELECT 'summary_token_count', CAST(summary_token_count AS DOUBLE) FROM lens)
SELECT metric, count(v) AS count, round(avg(v), 1) AS mean, round(stddev_samp(v), 1) AS std,
       round(min(v), 1) AS min, round(quantile_cont(v, 0.25), 1) AS p25, round(quantile_cont(v, 0.5), 1) AS p50,
       round(quantile_cont(v, 0.75), 1) AS p75, round(max(v), 1) AS max
FROM st GROUP BY metric
"""


def hist_sql(src: str, col: str, bins: int) -> str:
    return f"""
WITH {CLEAN_REF},
x AS (SELECT CAST({col} AS DOUBLE) AS x FROM {src} WHERE {col} IS NOT NULL),
mm AS (SELECT CASE WHEN min(x) = max(x) THEN min(x) - 0.5 ELSE min(x) END AS lo,
              CASE WHEN min(x) = max(x) THEN max(x) + 0.5 ELSE max(x) END AS hi FROM x),
w AS (SELECT lo, hi, (hi - lo) / {bins} AS width FROM mm),
b AS (SELECT CAST(least(floor((x - lo) / width), {bins - 1}) AS INTEGER) AS bin FROM x, w),
c AS (SELECT bin, count(*) AS n FROM b GROUP BY bin)
SELECT CAST(r.range AS INTEGER) AS bin, round(lo + CAST(r.range AS INTEGER) * width, 4) AS lo,
       round(lo + (CAST(r.range AS INTEGER) + 1) * width, 4) AS hi, CAST(coalesce(c.n, 0) AS BIGINT) AS n
FROM range(0, {bins}) r CROSS JOIN w LEFT JOIN c ON c.bin = r.range
"""


ORACLE["histogram_tokens"] = hist_sql("lens", "token_count", 50)
ORACLE["histogram_sentences"] = hist_sql("lens", "sent_count", 40)
ORACLE["histogram_summaries"] = hist_sql("lens", "summary_token_count", 40)

ORACLE["sample_documents"] = f"""
WITH {CLEAN}
SELECT doc_id, token_count FROM clean ORDER BY md5('42:' || CAST(doc_id AS VARCHAR)), doc_id LIMIT 300
"""

EDA_STOP_SQL = ("['the','a','an','and','or','but','in','on','at','to','for','of','with','is','was','are','were',"
                "'he','she','they','it','his','her','their','this','that','have','has','had','be','been','by','from',"
                "'as','said','will','i','we','you','not','--','also','who','its','about','up','after','more','which']")


def words3_sql(x: str) -> str:
    runs = f"regexp_extract_all({x}, '[\\p{{L}}\\p{{N}}_]+')"
    return (f"list_filter(list_transform(list_filter({runs}, lambda w: regexp_full_match(w, '[a-zA-Z]{{3,}}')), "
            f"lambda w: lower(w)), lambda w: NOT list_contains({EDA_STOP_SQL}, w))")


TOKS = CLEAN + f""",
toks AS (SELECT doc_id, {words3_sql('text')} AS t FROM clean),
wc AS (SELECT w AS word, count(*) AS freq FROM (SELECT unnest(t) AS w FROM toks) GROUP BY w)"""

ORACLE["top_unigrams"] = f"WITH {TOKS} SELECT word, freq FROM wc ORDER BY freq DESC, word LIMIT 20"

ORACLE["top_bigrams"] = f"""
WITH {TOKS},
p AS (SELECT t[i] || ' ' || t[i + 1] AS bigram FROM (SELECT t, unnest(range(1, len(t))) AS i FROM toks))
SELECT bigram, count(*) AS freq FROM p GROUP BY bigram ORDER BY freq DESC, bigram LIMIT 20
"""

ORACLE["vocabulary_stats"] = f"""
WITH {TOKS}
SELECT count(*) AS vocab_size, CAST(sum(freq) AS BIGINT) AS total_tokens,
       round(count(*) / sum(freq), 3) AS type_token_ratio FROM wc
"""

ORACLE["sample_preview"] = f"""
WITH {CLEAN}
SELECT doc_id, token_count, substr(text, 1, 400) AS preview
FROM clean ORDER BY md5('7:' || CAST(doc_id AS VARCHAR)), doc_id LIMIT 5
"""

ORACLE["corpus_takeaways"] = f"""
WITH {CLEAN_REF},
toks AS (SELECT doc_id, {words3_sql('text')} AS t FROM clean),
wc AS (SELECT w AS word, count(*) AS freq FROM (SELECT unnest(t) AS w FROM toks) GROUP BY w)
SELECT count(*) AS total_docs, quantile_cont(token_count, 0.5) AS median_tokens,
       quantile_cont(sent_count, 0.5) AS median_sentences,
       quantile_cont(summary_token_count, 0.5) AS median_summary_tokens,
       count(*) FILTER (WHERE token_count > 3000) AS docs_over_long_tokens,
       (SELECT count(*) FROM wc) AS vocab_size
FROM lens
"""

# --- entities -----------------------------------------------------------------

PATTERNS_SQL = [
    ("EMAIL", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"),
    ("URL", r"https?://[A-Za-z0-9./?=&#%_:~-]+"),
    ("PHONE", r"\+?[0-9]{1,3} ?\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}|[0-9]{3}-[0-9]{3}-[0-9]{4}"),
    ("MONEY", r"[$€£][0-9][0-9,]*(\.[0-9]+)?"),
    ("PERCENT", r"[0-9]+(\.[0-9]+)?%"),
    ("DATE", r"[0-9]{4}-[0-9]{2}-[0-9]{2}|(January|February|March|April|May|June|July|August|September|October"
             r"|November|December) [0-9]{1,2}(, [0-9]{4})?"),
    ("CARDINAL", r"[0-9]{6,}"),
    ("LAW", r"(Apache|MIT|BSD|Mozilla Public|GNU General Public|GNU Lesser General Public) License"),
    ("PROPN", r"[A-Z][a-z]+( [A-Z][a-z]+)+"),
]

LABEL_TYPE_SQL = ("coalesce(map_extract_value(MAP {'PERSON': 'PERSON', 'ORG': 'ORGANIZATION', 'GPE': 'LOCATION', "
                  "'LOC': 'LOCATION', 'DATE': 'OTHER', 'TIME': 'OTHER', 'MONEY': 'OTHER', 'PERCENT': 'OTHER', "
                  "'PRODUCT': 'CONSUMER_GOOD', 'EVENT': 'EVENT', 'WORK_OF_ART': 'WORK_OF_ART', 'LAW': 'OTHER', "
                  "'NORP': 'ORGANIZATION'}, {x}), 'OTHER')")

POS_SQL = "['good','great','excellent','positive','success','successful','benefit','improve','improved','gain','win','strong','happy','growth','support','best','better','well']"
NEG_SQL = "['bad','poor','negative','fail','failed','failure','loss','lose','weak','crisis','death','killed','attack','worse','worst','decline','problem','risk']"


def label_type_sql(x: str) -> str:
    return LABEL_TYPE_SQL.replace("{x}", x)


MENTIONS = CLEAN + """,
ct AS (SELECT doc_id, text AS t FROM clean),
raw_m AS (""" + " UNION ALL ".join(
    f"SELECT doc_id, t, unnest(regexp_extract_all(t, '{p}')) AS name, '{lab}' AS raw_label FROM ct"
    for lab, p in PATTERNS_SQL) + """),
mentions AS (SELECT doc_id, name, raw_label, CAST(strpos(t, name) AS INTEGER) AS pos FROM raw_m),
dm AS (
  SELECT doc_id, name, raw_label, pos,
         count(*) OVER (PARTITION BY doc_id, lower(trim(name)), raw_label) AS n_mentions,
         count(*) OVER (PARTITION BY doc_id) AS total_mentions
  FROM mentions
  QUALIFY row_number() OVER (PARTITION BY doc_id, lower(trim(name)), raw_label ORDER BY pos, name) = 1),
sent AS (
  SELECT doc_id, i, s, (len(list_filter(w, lambda x: list_contains(""" + POS_SQL + """, x)))
                    - len(list_filter(w, lambda x: list_contains(""" + NEG_SQL + """, x))))
                   / greatest(len(list_filter(w, lambda x: list_contains(""" + POS_SQL + """, x)))
                    + len(list_filter(w, lambda x: list_contains(""" + NEG_SQL + """, x))), 1) AS v
  FROM (SELECT doc_id, i, s, regexp_extract_all(lower(s), '[a-z0-9]+') AS w
        FROM (SELECT doc_id, unnest(ss) AS s, unnest(range(len(ss))) AS i FROM (SELECT doc_id, """ + sentences_sql('t') + """ AS ss FROM ct)))),
sent_m AS (""" + " UNION ALL ".join(
    f"SELECT DISTINCT doc_id, i, lower(trim(name)) AS k, '{lab}' AS raw_label, v FROM (SELECT doc_id, i, v, unnest(regexp_extract_all(s, '{p}')) AS name FROM sent)"
    for lab, p in PATTERNS_SQL) + """),
pents AS (
  SELECT dm.doc_id, dm.name AS entity_name, """ + label_type_sql("dm.raw_label") + """ AS entity_type,
         dm.raw_label, dm.pos, dm.n_mentions, round(dm.n_mentions / dm.total_mentions, 4) AS salience,
         round(coalesce(avg(sent_m.v), 0.0), 4) AS sentiment_score, round(coalesce(sum(abs(sent_m.v)), 0.0), 4) AS sentiment_magnitude,
         'pattern' AS extractor
  FROM dm LEFT JOIN sent_m ON sent_m.doc_id = dm.doc_id AND sent_m.k = lower(trim(dm.name)) AND sent_m.raw_label = dm.raw_label
  GROUP BY ALL)"""

ORACLE["extract_entities_pattern"] = f"WITH {MENTIONS} SELECT doc_id, name, raw_label, pos FROM mentions"

ORACLE["extract_entities_baseline"] = ORACLE["extract_entities_pattern"].replace("text AS t FROM clean", "substr(text, 1, 10000) AS t FROM clean")

ORACLE["dedupe_mentions"] = f"WITH {MENTIONS} SELECT doc_id, name, raw_label, pos, n_mentions FROM dm"

ORACLE["entity_salience"] = f"""WITH {MENTIONS}
SELECT doc_id, name, raw_label, pos, n_mentions,
       round(n_mentions / sum(n_mentions) OVER (PARTITION BY doc_id), 4) AS salience FROM dm"""

ORACLE["entity_sentiment"] = f"WITH {MENTIONS} SELECT * FROM pents"


def first_bytes_sql(x: str, n: int) -> str:
    """The longest prefix of whole characters within n bytes."""
    return (f"CASE WHEN strlen({x}) <= {n} THEN {x} ELSE substr({x}, 1, list_max(list_filter(range({n // 4}, {n + 1}), "
            f"lambda i: strlen(substr({x}, 1, i)) <= {n}))) END")


ORACLE["extract_entities_service"] = ORACLE["entity_sentiment"].replace("'pattern' AS extractor", "'service' AS extractor").replace(
    "text AS t FROM clean", f"{first_bytes_sql('text', 99000)} AS t FROM clean")

ORACLE["truncate_bytes"] = f"""
SELECT doc_id, CAST(strlen(t) AS INTEGER) AS bytes, CAST(length(t) AS INTEGER) AS chars
FROM (SELECT doc_id, {first_bytes_sql('text', 1000)} AS t FROM documents)"""

ORACLE["redact_pii"] = f"""
SELECT doc_id, CAST(len(regexp_extract_all(text, '{PATTERNS_SQL[0][1]}')) AS BIGINT) AS n_email,
       CAST(len(regexp_extract_all(t1, '{PATTERNS_SQL[2][1]}')) AS BIGINT) AS n_phone,
       sha256(regexp_replace(t1, '{PATTERNS_SQL[2][1]}', '[PHONE]', 'g')) AS redacted_hash
FROM (SELECT doc_id, text, regexp_replace(text, '{PATTERNS_SQL[0][1]}', '[EMAIL]', 'g') AS t1 FROM documents)"""

ORACLE["table_create_append"] = """
SELECT source, 2 * count(*) AS n_rows, CAST(2 * sum(n_chars) AS BIGINT) AS n_chars FROM documents GROUP BY source"""

ORACLE["stream_ingest"] = f"WITH {CLEAN} SELECT text_hash, token_count FROM clean"

ORACLE["stream_ingest_committed"] = f"""WITH {STAGED},
arrived AS (SELECT CASE WHEN doc_id % 10 = 3 THEN 'malformed' WHEN doc_id % 10 = 7 OR text IS NULL THEN 'null text' END AS reason,
                   CASE WHEN doc_id % 4 = 0 THEN 2 ELSE 1 END AS times FROM documents)
SELECT DISTINCT 'documents' AS sink, text_hash AS ref, token_count AS n FROM staged
WHERE lang = 'en' AND token_count BETWEEN 100 AND 5000 AND doc_id % 10 NOT IN (3, 7)
UNION ALL
SELECT 'dead', reason, CAST(sum(times) AS BIGINT) FROM arrived WHERE reason IS NOT NULL GROUP BY reason
"""

ORACLE["table_truncate_write"] = f"""WITH {MENTIONS}
SELECT extractor, entity_type, count(*) AS n_rows, count(DISTINCT doc_id) AS n_docs FROM pents GROUP BY extractor, entity_type"""

GAZ = MENTIONS + """,
gz AS (SELECT DISTINCT lower(regexp_replace(trim(name), ' +', ' ', 'g')) AS k, raw_label FROM (
   SELECT 'Apache License' AS name, 'LAW' AS raw_label UNION ALL SELECT 'General Public License', 'LAW'
   UNION ALL SELECT 'Apache', 'ORG' UNION ALL SELECT 'GNU', 'ORG' UNION ALL SELECT 'Free Software Foundation', 'ORG'
   UNION ALL SELECT n_name, 'GPE' FROM nation UNION ALL SELECT r_name, 'LOC' FROM region)),
gtok AS (SELECT doc_id, t, regexp_extract_all(t, '[A-Za-z0-9]+') AS tk FROM ct),
grams AS (""" + " UNION ALL ".join(
    f"SELECT doc_id, t, i, array_to_string(tk[i:i + {n - 1}], ' ') AS gram "
    f"FROM (SELECT doc_id, t, tk, unnest(range(1, len(tk) - {n - 2})) AS i FROM gtok)"
    for n in (1, 2, 3)) + """),
gm AS (SELECT g.doc_id, g.gram AS name, gz.raw_label, CAST(g.i AS INTEGER) AS pos
       FROM grams g JOIN gz ON lower(g.gram) = gz.k),
gdm AS (
  SELECT doc_id, name, raw_label, pos, count(*) OVER (PARTITION BY doc_id, lower(trim(name)), raw_label) AS n_mentions
  FROM gm QUALIFY row_number() OVER (PARTITION BY doc_id, lower(trim(name)), raw_label ORDER BY pos, name) = 1),
gents AS (
  SELECT doc_id, name AS entity_name, """ + label_type_sql("raw_label") + """ AS entity_type, raw_label, pos, n_mentions,
         round(n_mentions / sum(n_mentions) OVER (PARTITION BY doc_id), 4) AS salience,
         0.0 AS sentiment_score, 0.0 AS sentiment_magnitude, 'gazetteer' AS extractor FROM gdm),
allents AS (SELECT * FROM pents UNION ALL SELECT * FROM gents)"""

ORACLE["extract_entities_gazetteer"] = f"WITH {GAZ} SELECT doc_id, name, raw_label, pos FROM gm"

ORACLE["label_map"] = f"""WITH {GAZ}
SELECT raw_label, {label_type_sql('raw_label')} AS entity_type, count(*) AS n_mentions
FROM (SELECT raw_label FROM mentions UNION ALL SELECT raw_label FROM gm) GROUP BY raw_label"""

ORACLE["entities_union"] = f"WITH {GAZ} SELECT * FROM allents"

ORACLE["top_entities_per_doc"] = f"""WITH {GAZ}
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY salience DESC, entity_name, entity_type,
                    extractor, raw_label) AS INTEGER) AS rank,
       entity_name, entity_type, salience, extractor
FROM allents QUALIFY rank <= 20"""

ORACLE["extraction_report"] = f"""WITH {GAZ}
SELECT extractor, count(DISTINCT doc_id) AS docs_with_entities, CAST(count(*) AS BIGINT) AS entity_rows,
       (SELECT count(DISTINCT doc_id) FROM clean) AS docs_processed
FROM allents GROUP BY extractor"""

ORACLE["entities_lookup_or_compute"] = f"""WITH {MENTIONS},
stored AS (SELECT * FROM pents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)),
req AS (SELECT DISTINCT doc_id FROM labels),
miss AS (SELECT doc_id FROM req WHERE doc_id NOT IN (SELECT doc_id FROM stored))
SELECT doc_id, entity_name, entity_type, n_mentions, salience, 'cache' AS source
FROM stored WHERE doc_id IN (SELECT doc_id FROM req)
UNION ALL
SELECT doc_id, entity_name, entity_type, n_mentions, salience, 'computed' FROM pents
WHERE doc_id IN (SELECT doc_id FROM miss)
UNION ALL
SELECT doc_id, NULL, NULL, NULL, NULL, 'not_found' FROM miss WHERE doc_id NOT IN (SELECT doc_id FROM clean)"""

ORACLE["entities_write_back"] = f"""WITH {MENTIONS},
req AS (SELECT DISTINCT doc_id FROM labels),
runs AS (SELECT * FROM (VALUES (1, 'computed'), (2, 'cache')) t(run, source))
SELECT run, doc_id, entity_name, entity_type, n_mentions, salience, source
FROM pents, runs WHERE doc_id IN (SELECT doc_id FROM req)
UNION ALL
SELECT run, doc_id, NULL, NULL, NULL, NULL, 'not_found' FROM req, runs WHERE doc_id NOT IN (SELECT doc_id FROM clean)"""

CATS_SQL = [
    ("/Computers & Electronics/Software", "['software','code','source','version','apache','gnu','license','licensed','distributed']"),
    ("/Finance", "['bank','money','market','price','percent','fund','investment','tax']"),
    ("/Law & Government", "['law','legal','court','government','license','licensed','rights','warranty']"),
    ("/People & Society", "['people','family','community','children','public','social']"),
]

ORACLE["document_categories"] = f"""WITH {CLEAN},
ct AS (SELECT doc_id, text AS t FROM clean),
cw AS (SELECT doc_id, t, regexp_extract_all(lower(t), '[a-z0-9]+') AS w FROM ct),
cc AS (SELECT doc_id, CASE WHEN len({sentences_sql('t')}) >= 20 THEN list_filter([""" + ", ".join(
    f"CASE WHEN len(list_filter(w, lambda x: list_contains({kw}, x))) >= 2 THEN '{name}' END"
    for name, kw in CATS_SQL) + """], lambda c: c IS NOT NULL) ELSE [] END AS cats FROM cw)
SELECT doc_id, CAST(len(cats) AS INTEGER) AS n_categories, array_to_string(cats, '|') AS categories FROM cc"""

# --- entity aggregation ---------------------------------------------------------

AGG = GAZ + """,
req AS (SELECT doc_id FROM labels UNION ALL SELECT doc_id FROM labels WHERE toxic = 1),
sel AS (SELECT * FROM allents WHERE extractor = 'pattern' AND doc_id IN (SELECT doc_id FROM req)),
per AS (SELECT entity_name, count(*) AS frequency,
               sum(CAST(coalesce(sentiment_score, 0.0) AS DECIMAL(18, 4))) AS ssum,
               first(coalesce(entity_type, 'OTHER') ORDER BY doc_id DESC, entity_type DESC) AS entity_type
        FROM sel GROUP BY entity_name)"""

ORACLE["aggregate_entities"] = f"""WITH {AGG}
SELECT entity_name, entity_type, frequency, round(CAST(ssum AS DOUBLE) / frequency, 3) AS avg_sentiment
FROM per ORDER BY frequency DESC, entity_name LIMIT 10"""

DIST = """count(*) FILTER (WHERE ssum > 0.1) AS positive, count(*) FILTER (WHERE ssum < -0.1) AS negative,
       count(*) FILTER (WHERE ssum BETWEEN -0.1 AND 0.1) AS neutral"""

ORACLE["sentiment_distribution"] = f"WITH {AGG} SELECT {DIST} FROM per"

ORACLE["aggregate_entities_summary"] = f"""WITH {AGG}
SELECT (SELECT count(*) FROM req) AS doc_count, {DIST} FROM per"""

# --- summarisation ----------------------------------------------------------------

BASE_D = "CAST('0.15000000000000002' AS DOUBLE)"
DAMP = "CAST('0.85' AS DOUBLE)"
ZERO = "CAST(0 AS DOUBLE)"


def textrank_sql(src: str, keys: str, text: str, prefix: str, iterations: int = 20) -> str:
    """CTEs {prefix}_rk(keys, i, s, r, rnk) for relation ``src``: word pairs by a
    join on words, then one relation of ranks for each iteration."""
    p, ks = prefix, keys.split(", ")
    k = lambda t: ", ".join(f"{t}.{x}" for x in ks)
    on = lambda a, b: " AND ".join(f"{a}.{x} = {b}.{x}" for x in ks)
    out = f"""
{p}_sent AS MATERIALIZED (SELECT {keys}, i, S[i] AS s, regexp_extract_all(lower(S[i]), '[a-z0-9]+') AS ws, len(S) AS N
  FROM (SELECT {keys}, S, unnest(range(1, len(S) + 1)) AS i FROM (SELECT {keys}, {sentences_sql(text)} AS S FROM {src}))),
{p}_word AS MATERIALIZED (SELECT {keys}, i, w, count(*) AS c, max(n) AS n FROM (SELECT {keys}, i, unnest(ws) AS w, len(ws) AS n FROM {p}_sent) GROUP BY {keys}, i, w),
{p}_edge AS MATERIALIZED (SELECT {k('a')}, a.i, b.i AS j, CAST(sum(a.c * b.c) AS DOUBLE)
    / CASE WHEN max(ln(a.n) + ln(b.n)) > 0 THEN max(ln(a.n) + ln(b.n)) ELSE 1 END AS w
  FROM {p}_word a JOIN {p}_word b ON {on('a', 'b')} AND a.w = b.w GROUP BY {k('a')}, a.i, b.i),
{p}_m AS MATERIALIZED (SELECT {keys}, i, j, w / sum(w) OVER (PARTITION BY {keys}, j) AS m FROM {p}_edge),
{p}_r0 AS MATERIALIZED (SELECT {keys}, i, N, 1.0::DOUBLE / N AS r FROM {p}_sent),"""
    for t in range(1, iterations + 1):
        out += f"""
{p}_r{t} AS MATERIALIZED (SELECT {k('m')}, m.i, max(r.N) AS N, {BASE_D} / max(r.N) + {DAMP} * sum(m.m * r.r) AS r
  FROM {p}_m m JOIN {p}_r{t - 1} r ON {on('m', 'r')} AND m.j = r.i GROUP BY {k('m')}, m.i),"""
    return out + f"""
{p}_rk AS (SELECT {k('e')}, e.i, e.s, round(r.r, 9) AS r, row_number() OVER (PARTITION BY {k('e')} ORDER BY round(r.r, 9) DESC, e.i) AS rnk
  FROM {p}_sent e JOIN {p}_r{iterations} r ON {on('e', 'r')} AND e.i = r.i)"""


def first_words_sql(x: str, n: int) -> str:
    return f"array_to_string(regexp_extract_all({x}, '{NONWS_RE}')[1:{n}], ' ')"


def styles_sql(prefix: str, keys: str) -> str:
    """CTE {prefix}_st(keys, tldr, bullets (array, doc order), abstract)."""
    return f"""
{prefix}_st AS (
  SELECT {keys},
         {first_words_sql("max(s) FILTER (WHERE rnk = 1)", 25)} AS tldr,
         list(s ORDER BY i) FILTER (WHERE rnk <= 3) AS bullets,
         {first_words_sql("string_agg(s, ' ' ORDER BY rnk)", 80)} AS abstract
  FROM {prefix}_rk GROUP BY {keys})"""


ORACLE["textrank_summary"] = f"""WITH {CLEAN},
{textrank_sql('clean', 'doc_id', 'text', 'd')}
SELECT c.doc_id, coalesce(string_agg(s, ' ' ORDER BY i) FILTER (WHERE rnk <= 3), '') AS summary,
       CAST(count(i) AS INTEGER) AS n_sentences
FROM clean c LEFT JOIN d_rk USING (doc_id) GROUP BY c.doc_id"""

ORACLE["summary_styles"] = f"""WITH {CLEAN},
{textrank_sql('clean', 'doc_id', 'text', 'd')},
{styles_sql('d', 'doc_id')}
SELECT doc_id, tldr, array_to_string(bullets, ' | ') AS bullets, abstract FROM d_st"""

ORACLE["summary_route"] = """
SELECT doc_id, CAST(length(text) AS BIGINT) AS text_chars,
       CASE WHEN length(text) <= 16000 THEN 'direct' ELSE 'map_reduce' END AS route FROM documents"""

ORACLE["chunk_documents"] = """
SELECT doc_id, CAST(chunk_no AS INTEGER) AS chunk_no, CAST(length(substr(text, chunk_no * 12000 + 1, 12000)) AS INTEGER) AS chunk_chars,
       sha256(substr(text, chunk_no * 12000 + 1, 12000)) AS chunk_hash
FROM (SELECT doc_id, text, unnest(range(0, CAST(ceil(length(text) / 12000) AS BIGINT))) AS chunk_no FROM documents)"""

ORACLE["map_reduce_summary"] = f"""WITH {CLEAN},
routed AS (SELECT doc_id, text, CASE WHEN length(text) <= 4000 THEN 'direct' ELSE 'map_reduce' END AS route FROM clean),
chunks AS (SELECT doc_id, chunk_no, substr(text, chunk_no * 2000 + 1, 2000) AS text
           FROM (SELECT doc_id, text, unnest(range(0, CAST(ceil(length(text) / 2000) AS BIGINT))) AS chunk_no
                 FROM routed WHERE route = 'map_reduce')),
{textrank_sql('chunks', 'doc_id, chunk_no', 'text', 'c')},
{styles_sql('c', 'doc_id, chunk_no')},
parts AS (SELECT ch.doc_id, ch.chunk_no, coalesce(c_st.abstract, '') AS abstract
          FROM chunks ch LEFT JOIN c_st ON ch.doc_id = c_st.doc_id AND ch.chunk_no = c_st.chunk_no),
assembled AS (SELECT doc_id, string_agg('[Part ' || CAST(chunk_no + 1 AS VARCHAR) || ']: ' || abstract, chr(10) || chr(10)
                                        ORDER BY chunk_no) AS text FROM parts GROUP BY doc_id),
mr_src AS (SELECT doc_id, text FROM routed WHERE route = 'direct' UNION ALL SELECT doc_id, text FROM assembled),
{textrank_sql('mr_src', 'doc_id', 'text', 'f')},
{styles_sql('f', 'doc_id')}
SELECT f_st.doc_id, routed.route, tldr, array_to_string(bullets, ' | ') AS bullets, abstract
FROM f_st JOIN routed USING (doc_id)"""

SUMM = CLEAN + f""",
{textrank_sql('clean', 'doc_id', 'text', 'd')},
{styles_sql('d', 'doc_id')}"""

ORACLE["summary_lookup_or_compute"] = f"""WITH {SUMM},
stored AS (SELECT * FROM d_st WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)),
req AS (SELECT DISTINCT doc_id FROM labels),
miss AS (SELECT doc_id FROM req WHERE doc_id NOT IN (SELECT doc_id FROM stored))
SELECT doc_id, abstract AS summary, 'cache' AS source, 'abstract' AS style FROM stored WHERE doc_id IN (SELECT doc_id FROM req)
UNION ALL
SELECT doc_id, abstract, 'live', 'abstract' FROM d_st WHERE doc_id IN (SELECT doc_id FROM miss)
UNION ALL
SELECT doc_id, NULL, 'not_found', 'abstract' FROM miss WHERE doc_id NOT IN (SELECT doc_id FROM clean)"""

ORACLE["compare_summaries"] = f"""WITH {SUMM},
req AS (SELECT l.doc_id, d.source AS group_id, row_number() OVER (PARTITION BY d.source ORDER BY l.doc_id) - 1 AS pos
        FROM labels l JOIN documents d ON l.doc_id = d.doc_id QUALIFY pos < 8),
j AS (SELECT req.*, d_st.abstract FROM req LEFT JOIN d_st ON req.doc_id = d_st.doc_id),
g AS (SELECT group_id,
             string_agg(CAST(doc_id AS VARCHAR), '|' ORDER BY pos) AS doc_ids_requested,
             coalesce(string_agg(CAST(doc_id AS VARCHAR), '|' ORDER BY pos) FILTER (WHERE abstract IS NOT NULL), '') AS doc_ids_used,
             CAST(count(abstract) AS INTEGER) AS n_used,
             string_agg('[' || CAST(doc_id AS VARCHAR) || ']: ' || abstract, chr(10) || chr(10) ORDER BY pos)
               FILTER (WHERE abstract IS NOT NULL) AS combined
      FROM j GROUP BY group_id),
p AS (SELECT *, CASE WHEN n_used > 0 THEN 'Question about several texts: What do these documents have in common?' || chr(10) || chr(10)
         || 'What each text says, by id:' || chr(10) || combined || chr(10) || chr(10)
         || 'Answer briefly from these only, naming the ids you rely on.' END AS prompt FROM g)
SELECT group_id, doc_ids_requested, doc_ids_used, n_used, sha256(prompt) AS prompt_hash,
       CAST(length(prompt) AS INTEGER) AS prompt_chars FROM p"""

ORACLE["summary_report"] = f"""WITH {SUMM}
SELECT count(*) AS processed, count(*) FILTER (WHERE length(coalesce(abstract, '')) > 0) AS written,
       count(*) FILTER (WHERE length(coalesce(abstract, '')) = 0) AS failed FROM d_st"""

# --- Porter stems -----------------------------------------------------------------------

# The suffix rules of steps 2, 3 and 4 of the published algorithm.
STEM_STEP2 = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize", "abli": "able", "alli": "al",
    "entli": "ent", "eli": "e", "ousli": "ous", "ization": "ize", "ation": "ate", "ator": "ate", "alism": "al",
    "iveness": "ive", "fulness": "ful", "ousness": "ous", "aliti": "al", "iviti": "ive", "biliti": "ble",
}
STEM_STEP3 = {"icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": ""}
STEM_STEP4 = ["al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou", "ism", "ate",
              "iti", "ous", "ive", "ize"]


def stems_sql(vocabulary: str) -> str:
    """CTE stems(w, stem) of the words longer than three letters of relation
    ``vocabulary`` (w). A y that is a vowel is written Y on the way; V, C are
    vowels and consonants, and m > 0 is the pattern C*V+C at the start."""
    def has(x, pattern):
        return f"regexp_matches({x}, '{pattern.replace('V', '[aeiouY]').replace('C', '[^aeiouY]')}')"

    def cut(n):
        return f"left(x, {-n})"

    def rules(table, then):
        ordered = sorted(table, key=len, reverse=True)
        return "CASE " + " ".join(f"WHEN x LIKE '%{k}' THEN {then(k)}" for k in ordered) + " ELSE x END"

    m0, m1 = "^C*V+C", "^C*V+C+V+C"
    one = lambda x: f"({has(x, m0)} AND NOT {has(x, m1)})"
    cvc = "CV[^aeiouYwxy]$"
    double = f"(length(x) > 1 AND lower(right(x, 1)) = lower(left(right(x, 2), 1)) AND {has('x', 'C$')})"
    by_m0 = lambda t: lambda k: f"CASE WHEN {has(cut(len(k)), m0)} THEN {cut(len(k))} || '{t[k]}' ELSE x END"
    last = lambda k: f" AND {has(cut(len(k)), '[st]$')}" if k == "ion" else ""
    by_m1 = lambda k: f"CASE WHEN {has(cut(len(k)), m1)}{last(k)} THEN {cut(len(k))} ELSE x END"
    steps = [
        "CASE WHEN x LIKE '%sses' OR x LIKE '%ies' THEN left(x, -2) WHEN x LIKE '%ss' THEN x WHEN x LIKE '%s' THEN left(x, -1) ELSE x END AS x, false AS c",
        f"CASE WHEN x LIKE '%eed' THEN CASE WHEN {has(cut(3), m0)} THEN left(x, -1) ELSE x END "
        f"WHEN x LIKE '%ed' AND {has(cut(2), 'V')} THEN left(x, -2) WHEN x LIKE '%ing' AND {has(cut(3), 'V')} THEN left(x, -3) ELSE x END AS x, "
        f"x NOT LIKE '%eed' AND (x LIKE '%ed' AND {has(cut(2), 'V')} OR x LIKE '%ing' AND {has(cut(3), 'V')}) AS c",
        f"CASE WHEN NOT c THEN x WHEN {has('x', '(at|bl|iz)$')} THEN x || 'e' WHEN {double} AND right(x, 1) NOT IN ('l', 's', 'z') THEN left(x, -1) "
        f"WHEN {one('x')} AND {has('x', cvc)} THEN x || 'e' ELSE x END AS x, false AS c",
        f"CASE WHEN lower(x) LIKE '%y' AND {has(cut(1), 'V')} THEN left(x, -1) || 'i' ELSE x END AS x, false AS c",
        rules(STEM_STEP2, by_m0(STEM_STEP2)) + " AS x, false AS c",
        rules(STEM_STEP3, by_m0(STEM_STEP3)) + " AS x, false AS c",
        rules(STEM_STEP4, by_m1) + " AS x, false AS c",
        f"CASE WHEN x LIKE '%e' AND ({has(cut(1), m1)} OR {one(cut(1))} AND NOT {has(cut(1), cvc)}) THEN left(x, -1) ELSE x END AS x, false AS c",
        f"CASE WHEN {has('x', m1)} AND x LIKE '%ll' THEN left(x, -1) ELSE x END AS x, false AS c",
    ]
    marked = "regexp_replace(regexp_replace(w, '([^aeiouy])y', '\\1Y', 'g'), '(^|[aeiouY])yy', '\\1yY', 'g')"
    out = f"stem_0 AS MATERIALIZED (SELECT DISTINCT w, {marked} AS x, false AS c FROM {vocabulary} WHERE length(w) > 3),"
    for k, step in enumerate(steps, 1):
        out += f"\nstem_{k} AS MATERIALIZED (SELECT w, {step} FROM stem_{k - 1}),"
    return out + f"\nstems AS MATERIALIZED (SELECT w, lower(x) AS stem FROM stem_{len(steps)})"


# --- ROUGE ---------------------------------------------------------------------------

ROUGE = SUMM + f""",
cref AS (SELECT *, array_to_string({sentences_sql('text')}[1:3], ' ') AS reference_summary FROM clean),
refs AS (SELECT doc_id, reference_summary AS text FROM cref),
trs AS (SELECT c.doc_id, coalesce(string_agg(s, ' ' ORDER BY i) FILTER (WHERE rnk <= 3), '') AS summary
        FROM clean c LEFT JOIN d_rk USING (doc_id) GROUP BY c.doc_id),
hyps AS (SELECT doc_id, 'textrank' AS model, summary AS text FROM trs
         UNION ALL SELECT c.doc_id, 'abstract', CASE WHEN c.doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 0) THEN s.abstract END
         FROM clean c LEFT JOIN d_st s USING (doc_id)),
plain AS MATERIALIZED (SELECT r.doc_id, h.model, regexp_extract_all(lower(coalesce(r.text, '')), '[a-z0-9]+') AS rt,
                 regexp_extract_all(lower(coalesce(h.text, '')), '[a-z0-9]+') AS ht
          FROM refs r JOIN hyps h USING (doc_id)),
pairs AS (SELECT * FROM plain),
grams AS (SELECT *, CASE WHEN len(rt) >= 2 THEN list_transform(range(1, len(rt)), lambda i: rt[i] || ' ' || rt[i + 1]) ELSE [] END AS rt2,
                    CASE WHEN len(ht) >= 2 THEN list_transform(range(1, len(ht)), lambda i: ht[i] || ' ' || ht[i + 1]) ELSE [] END AS ht2
          FROM pairs),
ov AS (SELECT *,
         list_reduce(list_distinct(ht), lambda acc, g: acc + least(len(list_filter(rt, lambda x: x = g)), len(list_filter(ht, lambda x: x = g))), 0) AS o1,
         list_reduce(list_distinct(ht2), lambda acc, g: acc + least(len(list_filter(rt2, lambda x: x = g)), len(list_filter(ht2, lambda x: x = g))), 0) AS o2,
         CASE WHEN len(rt) > 0 THEN list_reduce(ht, lambda prev, h:
              [0] || list_transform(range(1, len(rt) + 1), lambda j: list_max(list_transform(range(1, j + 1), lambda q:
                    greatest(prev[q + 1], CASE WHEN rt[q] = h THEN prev[q] + 1 ELSE 0 END)))),
              list_transform(range(0, len(rt) + 1), lambda x: 0))[len(rt) + 1] ELSE 0 END AS ol
       FROM grams),
scores AS (SELECT doc_id, model,
  round(CASE WHEN o1 > 0 THEN 2 * (o1 / len(ht)) * (o1 / len(rt)) / ((o1 / len(ht)) + (o1 / len(rt))) ELSE 0.0 END, 4) AS rouge1,
  round(CASE WHEN o2 > 0 THEN 2 * (o2 / len(ht2)) * (o2 / len(rt2)) / ((o2 / len(ht2)) + (o2 / len(rt2))) ELSE 0.0 END, 4) AS rouge2,
  round(CASE WHEN ol > 0 THEN 2 * (ol / len(ht)) * (ol / len(rt)) / ((ol / len(ht)) + (ol / len(rt))) ELSE 0.0 END, 4) AS rougeL
  FROM ov)"""

VOCABULARY = "vocabulary AS (SELECT DISTINCT unnest(list_concat(rt, ht)) AS w FROM plain)"


def stemmed_list_sql(side: str) -> str:
    """{side}_stemmed(doc_id, model, t): the words of one side with their stems."""
    return f"""
{side}_stemmed AS MATERIALIZED (SELECT doc_id, model, list(coalesce(stem, u.w) ORDER BY i) AS t
  FROM (SELECT doc_id, model, unnest({side}) AS w, unnest(range(1, len({side}) + 1)) AS i FROM plain) u LEFT JOIN stems ON stems.w = u.w GROUP BY doc_id, model)"""


ROUGE_STEMMED = ROUGE.replace("pairs AS (SELECT * FROM plain),", f"""{VOCABULARY},
{stems_sql('vocabulary')},{stemmed_list_sql('rt')},{stemmed_list_sql('ht')},
pairs AS (SELECT p.doc_id, p.model, coalesce(a.t, []) AS rt, coalesce(b.t, []) AS ht
          FROM plain p LEFT JOIN rt_stemmed a USING (doc_id, model) LEFT JOIN ht_stemmed b USING (doc_id, model)),""")

ORACLE["rouge_tokens"] = f"""WITH {CLEAN},
cref AS (SELECT doc_id, regexp_extract_all(lower(array_to_string({sentences_sql('text')}[1:3], ' ')), '[a-z0-9]+') AS t FROM clean),
vocabulary AS (SELECT DISTINCT unnest(t) AS w FROM cref),
{stems_sql('vocabulary')},
own AS (SELECT doc_id, list(coalesce(stem, u.w) ORDER BY i) AS t
        FROM (SELECT doc_id, unnest(t) AS w, unnest(range(1, len(t) + 1)) AS i FROM cref) u LEFT JOIN stems ON stems.w = u.w GROUP BY doc_id)
SELECT c.doc_id, CAST(coalesce(len(own.t), 0) AS INTEGER) AS n_tokens, coalesce(array_to_string(own.t, ' '), '') AS tokens
FROM clean c LEFT JOIN own USING (doc_id)"""

ORACLE["rouge_n"] = f"WITH {ROUGE_STEMMED} SELECT doc_id, model, rouge1, rouge2 FROM scores"
ORACLE["rouge_l"] = f"WITH {ROUGE_STEMMED} SELECT doc_id, model, rougeL FROM scores"
MEANS = """
SELECT model, count(*) AS n_docs, round(avg(rouge1), 4) AS rouge1, round(avg(rouge2), 4) AS rouge2,
       round(avg(rougeL), 4) AS rougeL FROM scores GROUP BY model"""
ORACLE["rouge_stemmed"] = f"WITH {ROUGE_STEMMED} {MEANS}"
ORACLE["rouge_corpus"] = f"WITH {ROUGE} {MEANS}"

ORACLE["eval_unpaired"] = f"""WITH {CLEAN}
SELECT coalesce(r.doc_id, h.doc_id) AS doc_id, CASE WHEN r.doc_id IS NULL THEN 'reference' ELSE 'hypothesis' END AS missing_side
FROM (SELECT DISTINCT doc_id FROM labels) r FULL OUTER JOIN (SELECT doc_id FROM clean) h ON r.doc_id = h.doc_id
WHERE r.doc_id IS NULL OR h.doc_id IS NULL"""

# --- sessions and cache ------------------------------------------------------------

ORACLE["session_history"] = "SELECT conv_id, turn, role, sha256(text) AS text_hash FROM conversations"

ORACLE["session_append"] = """
SELECT role, count(*) AS n_turns, count(tool_name) AS n_tool_calls FROM (
  SELECT role, NULL AS tool_name FROM conversations
  UNION ALL SELECT 'tool', 'search_documents' FROM conversations WHERE role = 'user') GROUP BY role"""

ORACLE["history_expand"] = """
SELECT conv_id, turn, 0 AS part_no, CASE WHEN role = 'user' THEN 'user' ELSE 'model' END AS part_role,
       'text' AS kind, sha256(text) AS payload_hash
FROM conversations WHERE role IN ('user', 'assistant', 'model')
UNION ALL
SELECT conv_id, turn, 0, 'model', 'function_call', sha256(CASE WHEN turn % 2 = 1 THEN '{"n": ' || length(text) || '}' ELSE '{}' END)
FROM conversations WHERE role = 'user'
UNION ALL
SELECT conv_id, turn, 1, 'user', 'function_response', sha256('{"result": {"hash": "' || md5(text) || '"}}') FROM conversations WHERE role = 'user'"""

CACHE = """
log AS (SELECT user_id AS doc_id, event_type AS key, props AS value, ts, event_id FROM events),
latest AS (SELECT doc_id, key, arg_max(value, (ts, event_id)) AS value, count(*) AS n_writes FROM log GROUP BY doc_id, key)"""

ORACLE["cache_latest"] = f"WITH {CACHE} SELECT * FROM latest"

ORACLE["cache_incremental"] = ORACLE["cache_latest"]

ORACLE["cache_lookup"] = f"""WITH {CACHE},
req AS (SELECT doc_id, 'click' AS key FROM labels UNION ALL SELECT doc_id, 'purchase' FROM labels)
SELECT req.doc_id, req.key, latest.value, latest.doc_id IS NOT NULL AS hit
FROM req LEFT JOIN latest ON req.doc_id = latest.doc_id AND req.key = latest.key"""

# --- inference stage ---------------------------------------------------------------

PAT = dict(PATTERNS_SQL)
INFER = CLEAN + f""",
ct AS (SELECT c.doc_id, c.text AS t, coalesce(l.toxic = 1, false) AS tox,
              coalesce(l.toxic = 1 AND l.quality = 0, false) AS bad
       FROM clean c LEFT JOIN labels l USING (doc_id)),
f AS (SELECT doc_id, tox, bad, coalesce(({sentences_sql('t')})[1], '') AS core_issue,
             regexp_extract_all(t, '{PAT["PROPN"]}') AS actor_names,
             len(list_distinct(regexp_extract_all(t, '{PAT["PROPN"]}'))) AS n_actors,
             list_distinct(list_concat(regexp_extract_all(t, '{PAT["PERCENT"]}'), regexp_extract_all(t, '{PAT["MONEY"]}'))) AS metrics,
             len(list_distinct(list_concat(regexp_extract_all(t, '{PAT["PERCENT"]}'), regexp_extract_all(t, '{PAT["MONEY"]}')))) AS n_metrics,
             len(list_distinct(regexp_extract_all(t, '{PAT["DATE"]}'))) AS n_dates,
             len(list_filter(regexp_extract_all(lower(t), '[a-z0-9]+'), lambda x: list_contains({POS_SQL}, x))) AS p,
             len(list_filter(regexp_extract_all(lower(t), '[a-z0-9]+'), lambda x: list_contains({NEG_SQL}, x))) AS n
      FROM ct),
pe AS (SELECT doc_id, NOT bad AS parse_ok,
              CASE WHEN bad THEN 0 ELSE length(core_issue) END AS core_issue_chars,
              CASE WHEN bad THEN 0 ELSE n_actors END AS n_actors,
              CASE WHEN bad THEN 0 ELSE n_metrics END AS n_metrics,
              CASE WHEN bad THEN 0 ELSE n_dates END AS n_dates,
              CASE WHEN bad THEN 'neutral' WHEN tox THEN 'toxic' WHEN p > n THEN 'positive' WHEN n > p THEN 'negative'
                   ELSE 'neutral' END AS sentiment_label,
              actor_names, CASE WHEN bad THEN [] ELSE metrics END AS metrics, CASE WHEN bad THEN [] ELSE list_distinct(actor_names) END AS names
       FROM f),
va AS (SELECT *, CASE WHEN NOT parse_ok THEN 'malformed_json'
                      WHEN sentiment_label NOT IN ('positive', 'negative', 'neutral') THEN 'invalid_sentiment_label'
                 END AS reject_reason FROM pe)"""

REQUESTS = CLEAN + """,
r AS (SELECT doc_id, 'Read the text between the two lines and describe it as one JSON object.' || chr(10) || '-----' || chr(10)
  || substr(text, 1, 12000) || chr(10) || '-----' || chr(10) || 'Fields of the object:' || chr(10)
  || 'core_issue (string): what the text is mainly about, in a sentence' || chr(10)
  || 'actors (list of {"name", "role"}): who takes part, and as what' || chr(10)
  || 'key_metrics (list of strings): figures the text states' || chr(10)
  || 'dates (list of {"date", "event"}): days or times it names, and what happened then' || chr(10)
  || 'sentiment_label (positive, negative or neutral): its tone as a whole' || chr(10)
  || 'sentiment_reason (string): why, in a sentence' || chr(10) || 'State only what the text says.' || chr(10) AS request FROM clean)"""

ORACLE["build_requests"] = f"""WITH {REQUESTS}
SELECT doc_id, CAST(length(request) AS INTEGER) AS request_chars, sha256(request) AS request_hash FROM r"""

ORACLE["model_call"] = f"""WITH {REQUESTS}
SELECT doc_id, length(request) || ' characters, ' || sha256(request) AS answer, CAST(NULL AS VARCHAR) AS error FROM r"""

ORACLE["inference_resumed"] = f"""WITH {REQUESTS}
SELECT doc_id, length(request) || ' characters, ' || sha256(request) AS answer, CAST(NULL AS VARCHAR) AS error, CAST(1 AS BIGINT) AS n_sent FROM r"""

ORACLE["parse_extractions"] = f"""WITH {INFER}
SELECT doc_id, parse_ok, CAST(core_issue_chars AS INTEGER) AS core_issue_chars, CAST(n_actors AS INTEGER) AS n_actors,
       CAST(n_metrics AS INTEGER) AS n_metrics, CAST(n_dates AS INTEGER) AS n_dates, sentiment_label FROM pe"""

ORACLE["validate_extractions"] = f"WITH {INFER} SELECT doc_id, reject_reason FROM va"

ORACLE["inference_quarantine"] = f"""WITH {INFER}
SELECT 'ok' AS status, count(*) FILTER (WHERE reject_reason IS NULL) AS n FROM va
UNION ALL SELECT reject_reason, count(*) FROM va WHERE reject_reason IS NOT NULL GROUP BY reject_reason"""

ORACLE["json_roundtrip"] = f"""WITH {INFER}
SELECT doc_id, array_to_string(list_sort(names), '|') AS actor_names, array_to_string(list_sort(metrics), '|') AS metrics,
       CAST(n_dates AS INTEGER) AS n_dates FROM pe"""

ORACLE["explode_actors"] = f"""WITH {INFER},
good AS (SELECT doc_id, actor_names FROM va WHERE reject_reason IS NULL),
u AS (SELECT doc_id, name, idx FROM (SELECT doc_id, unnest(actor_names) AS name,
                                            unnest(range(1, len(actor_names) + 1)) AS idx FROM good)
      QUALIFY row_number() OVER (PARTITION BY doc_id, name ORDER BY idx) = 1),
a AS (SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY idx) - 1 AS INTEGER) AS actor_no, name,
             'mentioned' AS role FROM u)
SELECT * FROM a
UNION ALL SELECT doc_id, NULL, NULL, NULL FROM good WHERE len(actor_names) = 0"""

ORACLE["semantic_search"] = """
WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
pairs AS (
  SELECT q.vec_id AS query_id, x.vec_id, round(list_dot_product(q.e, x.e) / (sqrt(list_dot_product(q.e, q.e)) * sqrt(list_dot_product(x.e, x.e))), 9) AS score
  FROM v q JOIN v x ON q.vec_id <> x.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM pairs QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 10
"""

INDEXED = {"q_de": "schaft|ung", "q_en": "th[a-z]*tion", "q_es": "ción", "q_fr": "ment", "q_num": "[0-9]+",
           "q_rare": "general public licen[cs]e|apache license"}

ORACLE["search_indexed"] = " UNION ALL ".join(
    f"SELECT '{q}' AS qid, doc_id, CAST(len(regexp_extract_all(lower(text), '{p}')) AS BIGINT) AS score "
    f"FROM documents WHERE regexp_matches(lower(text), '{p}')" for q, p in INDEXED.items())

# what a match must hold, three letters at a time
TRIGRAMS = {"q_de": [["sch", "cha", "haf", "aft"], ["ung"]], "q_en": [["tio", "ion"]], "q_fr": [["men", "ent"]], "q_num": [[""]],
            "q_rare": [["gen", "ene", "ner", "era", "ral", "al ", "l p", " pu", "pub", "ubl", "bli", "lic", "ic ", "c l", " li", "ice", "cen"],
                       ["apa", "pac", "ach", "che", "he ", "e l", " li", "lic", "ice", "cen", "ens", "nse"]]}


def _looked_up(grams: list[str]) -> str:
    """The condition on a text; of more than 16 the first by their bytes are looked up."""
    return " AND ".join(f"contains(lower(text), '{g}')" for g in sorted(set(grams))[:16])


ORACLE["search_index_report"] = " UNION ALL ".join(
    f"SELECT '{q}' AS qid, count(text) AS n_texts, count_if({' OR '.join(f'({_looked_up(g)})' for g in sets)}) AS n_read, "
    f"count_if(regexp_matches(lower(text), '{INDEXED[q]}')) AS n_matched FROM documents" for q, sets in TRIGRAMS.items())

SECRET_KINDS = {
    "EMAIL": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}",
    "PHONE": r"\+?[0-9]{1,3} ?\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}|[0-9]{3}-[0-9]{3}-[0-9]{4}",
    "CARD": r"[0-9]{4}[ -][0-9]{4}[ -][0-9]{4}[ -][0-9]{1,7}|[0-9]{12,}",
    "IBAN": r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11,}",
    "IP": r"[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}",
    "KEY": r"[A-Za-z0-9+_=-]{20,}",
}
# every candidate with its place: behind k + 1 pieces and k matches
SECRETS = "\n, ".join(["WITH named AS (" + " UNION ALL ".join(
    f"SELECT doc_id, '{k}' AS kind, text, regexp_extract_all(text, '{p}') AS ms, regexp_split_to_array(text, '{p}') AS ps FROM documents" for k, p in SECRET_KINDS.items()) + ")",
    """cand AS (
  SELECT doc_id, kind, i, ms[i] AS f,
    CAST(list_sum(list_transform(ps[1:i], lambda p: length(p))) + coalesce(list_sum(list_transform(ms[1:i - 1], lambda m: length(m))), 0) AS INTEGER) AS start
  FROM (SELECT *, unnest(range(1, len(ms) + 1)) AS i FROM named))""",
    """digits AS (SELECT *, list_reverse(list_transform(string_split(regexp_replace(f, '[ -]', '', 'g'), ''), lambda c: TRY_CAST(c AS INTEGER))) AS ds FROM cand)""",
    """conf AS (
  SELECT doc_id, kind, f, start, CAST(start + length(f) AS INTEGER) AS stop FROM digits WHERE CASE kind
    WHEN 'CARD' THEN len(ds) BETWEEN 13 AND 19 AND list_sum(list_transform(ds, lambda d, i: CASE WHEN i % 2 = 1 THEN d WHEN d > 4 THEN 2 * d - 9 ELSE 2 * d END)) % 10 = 0
    WHEN 'IBAN' THEN length(f) BETWEEN 15 AND 34 AND list_reduce(list_prepend(0, list_transform(string_split(substr(f, 5) || substr(f, 1, 4), ''),
      lambda c: CASE WHEN regexp_matches(c, '[0-9]') THEN ascii(c) - 48 ELSE ascii(c) - 55 END)), lambda a, v: (a * CASE WHEN v > 9 THEN 100 ELSE 10 END + v) % 97) = 1
    WHEN 'IP' THEN list_bool_and(list_transform(string_split(f, '.'), lambda n: CAST(n AS INTEGER) <= 255))
    WHEN 'KEY' THEN len(regexp_extract_all(f, '[0-9][A-Za-z]')) + len(regexp_extract_all(f, '[A-Za-z][0-9]')) >= 3
      AND list_sum(list_transform(list_distinct(string_split(f, '')), lambda c: -((length(f) - length(replace(f, c, ''))) / length(f)) * log2((length(f) - length(replace(f, c, ''))) / length(f)))) >= 3.0
    ELSE TRUE END)""",
    """islands AS (
  SELECT *, sum(fresh) OVER (PARTITION BY doc_id ORDER BY start, kind, stop ROWS UNBOUNDED PRECEDING) AS island FROM (
    SELECT *, CASE WHEN start < max(stop) OVER (PARTITION BY doc_id ORDER BY start, kind, stop ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS fresh FROM conf))""",
    """finds AS (
  SELECT doc_id, island, min(start) AS start, max(stop) AS stop, arg_max(kind, (stop - start, -start, -n)) AS kind FROM (
    SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY kind) AS n FROM islands) GROUP BY doc_id, island)"""])

ORACLE["find_secrets"] = f"{SECRETS} SELECT doc_id, start, stop, kind FROM finds"
ORACLE["secrets_report"] = f"""{SECRETS}
SELECT k.kind, CAST(count(c.doc_id) AS BIGINT) AS n_candidates, CAST(count(f.doc_id) AS BIGINT) AS n_confirmed, count(DISTINCT f.doc_id) AS n_docs
FROM (SELECT unnest({list(SECRET_KINDS)}) AS kind) k LEFT JOIN cand c USING (kind)
LEFT JOIN conf f ON f.doc_id = c.doc_id AND f.kind = c.kind AND f.start = c.start GROUP BY k.kind"""
ORACLE["redact_secrets"] = f"""{SECRETS}
, cuts AS (SELECT doc_id, list(struct_pack(start := start, stop := stop, kind := kind) ORDER BY start) AS x FROM finds GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(len(x), 0) AS INTEGER) AS n_finds, sha256(CASE WHEN x IS NULL THEN text ELSE
  array_to_string(list_transform(x, lambda s, i: substr(text, CASE WHEN i = 1 THEN 0 ELSE x[i - 1].stop END + 1, s.start - CASE WHEN i = 1 THEN 0 ELSE x[i - 1].stop END) || '[' || s.kind || ']'), '')
  || substr(text, x[len(x)].stop + 1) END) AS redacted_hash
FROM documents LEFT JOIN cuts USING (doc_id)"""

ORACLE["extract_gazetteer_trie"] = f"""WITH {CLEAN},
bw AS (SELECT regexp_extract_all(lower(text), '[a-z0-9]+') AS w FROM benchmark),
names AS (SELECT DISTINCT array_to_string(w[i:i + n - 1], ' ') AS k, 'WORDS_' || len(w[i:i + n - 1]) AS raw_label
          FROM (SELECT w, n, unnest(range(1, greatest(len(w) - n + 1, 1) + 1)) AS i FROM bw, (VALUES (2), (3), (4)) t(n)) WHERE len(w[i:i + n - 1]) > 1),
tok AS (SELECT doc_id, regexp_extract_all(text, '[A-Za-z0-9]+') AS tk FROM clean),
g AS (SELECT doc_id, array_to_string(tk[i:i + n - 1], ' ') AS name, CAST(i AS INTEGER) AS pos
      FROM (SELECT doc_id, tk, n, unnest(range(1, len(tk) - n + 2)) AS i FROM tok, (VALUES (2), (3), (4)) t(n)))
SELECT doc_id, name, raw_label, pos FROM g JOIN names ON lower(g.name) = names.k"""
