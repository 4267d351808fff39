"""Structured-record extraction as a batch inference stage.

The model call is the only Python in the hot path: ``model_call`` runs a
user-supplied callable over Arrow batches with ``mapInPandas`` (the model
is loaded once per Python worker, retries live inside the callable, Spark
retries the task). Everything around it - request building, JSON parsing
with defaults, validation, quarantine, flattening - is native.

Without a model, ``local_responses`` produces the same JSON response shape
from native pattern extractors, so the rest of the stage runs and can be
checked end to end.
"""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from textmill import schemas
from textmill.functions import text as T
from textmill.operators import entities as EN

REQUEST_CHARS = 12_000  # L1
SENTIMENT_LABELS = ("positive", "negative", "neutral")

# The request around a text, which takes the place of {text}.
USER_TEMPLATE = (
    "Read the text between the two lines and describe it as one JSON object.\n"
    "-----\n"
    "{text}\n"
    "-----\n"
    "Fields of the object:\n"
    "core_issue (string): what the text is mainly about, in a sentence\n"
    "actors (list of {\"name\", \"role\"}): who takes part, and as what\n"
    "key_metrics (list of strings): figures the text states\n"
    "dates (list of {\"date\", \"event\"}): days or times it names, and what happened then\n"
    "sentiment_label (positive, negative or neutral): its tone as a whole\n"
    "sentiment_reason (string): why, in a sentence\n"
    "State only what the text says.\n"
)


def build_requests(df: DataFrame, text_col: str = "text", key: str = "doc_id", max_chars: int = REQUEST_CHARS,
                   template: str = USER_TEMPLATE) -> DataFrame:
    """L1: truncate to ``max_chars`` characters and substitute into the template
    (``concat`` of the literal halves: safe for any text content)."""
    prefix, suffix = template.split("{text}", 1)
    req = F.concat(F.lit(prefix), F.substring(F.col(text_col), 1, max_chars), F.lit(suffix))
    return df.select(key, req.alias("request"))


RESPONSE_SCHEMA = StructType([StructField("response", StringType()), StructField("error", StringType())])


def model_call(requests: DataFrame, make_model: Callable[[], Callable[[str], str]], key: str = "doc_id",
               retries: int = 3, backoff_s: float = 2.0, partitions: int | None = None) -> DataFrame:
    """L2 + L5: run a model over request rows in Arrow batches.

    ``make_model`` is called once per task to build the callable (load-once);
    each request is retried with exponential backoff; a request that still
    fails yields ``error`` instead of failing the job (dead-letter, L5).
    ``partitions`` spreads the requests over that many tasks first.
    """
    import pandas as pd

    src = requests.repartition(partitions) if partitions else requests
    out_schema = StructType([src.schema[key]] + RESPONSE_SCHEMA.fields)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = make_model()
        for b in batches:
            resp, err = [], []
            for r in b["request"]:
                value, error = None, None
                for attempt in range(retries):
                    try:
                        value = model(r)
                        error = None
                        break
                    except Exception as e:  # noqa: BLE001 - isolated per document
                        error = f"{type(e).__name__}: {e}"
                        if attempt + 1 < retries:
                            time.sleep(backoff_s * (2 ** attempt))
                resp.append(value)
                err.append(error)
            yield pd.DataFrame({key: b[key], "response": resp, "error": err})

    return src.select(key, "request").mapInPandas(run, out_schema)


def local_responses(df: DataFrame, text_col: str = "text", key: str = "doc_id",
                    label_override: Column | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Deterministic native stand-in for the model: the response JSON built
    with ``to_json`` from pattern extractors (first sentence, capitalised
    spans as actors, figures as metrics, dates, lexicon tone)."""
    staged = df.select(key, *keep, F.col(text_col).alias("_t"))
    first = F.try_element_at(T.sentences("_t"), F.lit(1))
    actors = F.transform(F.array_distinct(F.regexp_extract_all("_t", F.lit(EN.PATTERNS["PROPN"]), 0)),
                         lambda n: F.struct(n.alias("name"), F.lit("mentioned").alias("role")))
    metrics = F.array_distinct(F.concat(
        F.regexp_extract_all("_t", F.lit(EN.PATTERNS["PERCENT"]), 0),
        F.regexp_extract_all("_t", F.lit(EN.PATTERNS["MONEY"]), 0)))
    dates = F.transform(F.array_distinct(F.regexp_extract_all("_t", F.lit(EN.PATTERNS["DATE"]), 0)),
                        lambda d: F.struct(d.alias("date"), F.lit("mentioned").alias("event")))
    w = T.words("_t")
    pos_arr = F.array(*[F.lit(x) for x in EN.POSITIVE_WORDS])
    neg_arr = F.array(*[F.lit(x) for x in EN.NEGATIVE_WORDS])
    p = F.size(F.filter(w, lambda x: F.array_contains(pos_arr, x)))
    n = F.size(F.filter(w, lambda x: F.array_contains(neg_arr, x)))
    label = F.when(p > n, "positive").when(n > p, "negative").otherwise("neutral")
    if label_override is not None:
        label = F.coalesce(label_override, label)
    rec = F.struct(
        F.coalesce(first, F.lit("")).alias("core_issue"), actors.alias("actors"), metrics.alias("key_metrics"),
        dates.alias("dates"), label.alias("sentiment_label"),
        F.concat(F.lit("lexicon hits: "), p.cast("string"), F.lit(" positive, "), n.cast("string"),
                 F.lit(" negative")).alias("sentiment_reason"))
    return staged.select(key, *keep, F.to_json(rec).alias("response"), F.lit(None).cast("string").alias("error"))


def parse_extractions(responses: DataFrame, key: str = "doc_id") -> DataFrame:
    """L3: parse the JSON response under the declared nested schema; missing
    fields take the record defaults ('' / [] / 'neutral'); malformed JSON
    gives ``parse_ok = false`` (no job failure)."""
    with_corrupt = StructType(schemas.EXTRACTION.fields + [StructField("_corrupt_record", StringType())])
    rec = F.from_json(F.col("response"), with_corrupt,
                      {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    staged = responses.select(key, "response", "error", rec.alias("r"))
    ok = F.col("response").isNotNull() & F.col("r._corrupt_record").isNull()
    return staged.select(
        key, "error", ok.alias("parse_ok"),
        F.coalesce(F.col("r.core_issue"), F.lit("")).alias("core_issue"),
        F.coalesce(F.col("r.actors"), F.array().cast(schemas.EXTRACTION["actors"].dataType)).alias("actors"),
        F.coalesce(F.col("r.key_metrics"), F.array().cast("array<string>")).alias("key_metrics"),
        F.coalesce(F.col("r.dates"), F.array().cast(schemas.EXTRACTION["dates"].dataType)).alias("dates"),
        F.coalesce(F.col("r.sentiment_label"), F.lit("neutral")).alias("sentiment_label"),
        F.coalesce(F.col("r.sentiment_reason"), F.lit("")).alias("sentiment_reason"),
    )


def validation_error(parsed: DataFrame) -> Column:
    """L4: reason a parsed record is rejected, null when valid."""
    bad_actor = F.exists("actors", lambda a: a["name"].isNull() | a["role"].isNull())
    bad_date = F.exists("dates", lambda d: d["date"].isNull() | d["event"].isNull())
    return (
        F.when(F.col("error").isNotNull(), F.lit("model_error"))
        .when(~F.col("parse_ok"), F.lit("malformed_json"))
        .when(~F.col("sentiment_label").isin(*SENTIMENT_LABELS), F.lit("invalid_sentiment_label"))
        .when(bad_actor, F.lit("actor_missing_field"))
        .when(bad_date, F.lit("date_missing_field"))
    )


def validate_extractions(parsed: DataFrame) -> DataFrame:
    """L4: the record with its rejection reason (null = valid)."""
    return parsed.withColumn("reject_reason", validation_error(parsed))


def inference_quarantine(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good records, dead-letter records). Both come from one validated
    frame; persist it once if both sides are written."""
    good = validated.filter(F.col("reject_reason").isNull()).drop("reject_reason", "error", "parse_ok")
    dead = validated.filter(F.col("reject_reason").isNotNull())
    return good, dead


def to_json_columns(records: DataFrame, cols=("actors", "key_metrics", "dates")) -> DataFrame:
    """L6 (write side): nested fields as JSON text for a text-only store."""
    out = records
    for c in cols:
        out = out.withColumn(c, F.to_json(c))
    return out


def from_json_columns(records: DataFrame) -> DataFrame:
    """L6 (read side): JSON text back to nested types; null reads as []."""
    return (records
            .withColumn("actors", F.from_json(F.coalesce("actors", F.lit("[]")), schemas.EXTRACTION["actors"].dataType))
            .withColumn("key_metrics", F.from_json(F.coalesce("key_metrics", F.lit("[]")), "array<string>"))
            .withColumn("dates", F.from_json(F.coalesce("dates", F.lit("[]")), schemas.EXTRACTION["dates"].dataType)))


def explode_actors(records: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row per actor (documents without actors keep one null row)."""
    return records.select(key, F.posexplode_outer("actors").alias("actor_no", "a")).select(
        key, "actor_no", F.col("a.name").alias("name"), F.col("a.role").alias("role"))


def echo_model() -> Callable[[str], str]:
    """A local model for tests: its record tells the length and hash of the request."""
    def call(request: str) -> str:
        seen = f"{len(request)} characters, {hashlib.sha256(request.encode()).hexdigest()}"
        return json.dumps({"core_issue": seen, "actors": [], "key_metrics": [], "dates": [],
                           "sentiment_label": "neutral", "sentiment_reason": ""})
    return call
