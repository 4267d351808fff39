"""Session history and the document cache.

The turn log and the cache are append-only tables; reads are views over
them. Latest-wins state is a partial ``max_by`` aggregate per (doc, key), so
a hot document or key is combined map-side. History is returned as ordered
rows (a range-partitioned sort on (session, turn) can split one very long
session across tasks), never collected into one array per session.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from textmill import schemas
from textmill.sources.committed import CommittedTables
from textmill.sources.tables import write_table

ROLE_MODEL_ALIASES = ("model", "assistant")


def session_history(turns: DataFrame, session: str = "session_id", order: str = "ts",
                    session_id=None) -> DataFrame:
    """All turns of one session (or of all sessions) in order."""
    out = turns if session_id is None else turns.filter(F.col(session) == F.lit(session_id))
    return out.orderBy(session, order)


def turn_rows(df: DataFrame, session: Column, ts: Column, role: Column, content: Column) -> DataFrame:
    """Plain turns in the log schema (content coerced to string)."""
    return df.select(session.cast("string").alias("session_id"), ts.alias("ts"), role.alias("role"),
                     content.cast("string").alias("content"), F.lit(None).cast("string").alias("tool_name"),
                     F.lit(None).cast("string").alias("args"), F.lit(None).cast("string").alias("observation"))


def tool_rows(df: DataFrame, session: Column, ts: Column, tool_name: Column, args: Column,
              observation: Column) -> DataFrame:
    """Tool turns; args and observation as JSON text."""
    return df.select(session.cast("string").alias("session_id"), ts.alias("ts"), F.lit("tool").alias("role"),
                     F.lit(None).cast("string").alias("content"), tool_name.alias("tool_name"),
                     args.alias("args"), observation.alias("observation"))


def append_turns(rows: DataFrame, path: str) -> str:
    """C2/C3 sink: append to the typed turn log (required fields enforced in the write)."""
    return write_table(rows, path, schemas.SESSION_TURNS, mode="append")


def history_expand(turns: DataFrame, role: str = "role", content: str = "content", tool_name: str = "tool_name",
                   args: str = "args", observation: str = "observation") -> DataFrame:
    """C4: model-facing history: user -> 1 part, model -> 1 part, tool -> 2 parts
    (model function call, user function response), unknown roles -> none;
    missing tool args become ``{}``."""
    r = F.col(role)
    part = "struct<part_no:int,part_role:string,kind:string,name:string,payload:string>"

    def p(no, prole, kind, name, payload):
        return F.struct(F.lit(no).alias("part_no"), F.lit(prole).alias("part_role"), F.lit(kind).alias("kind"),
                        name.cast("string").alias("name"), payload.cast("string").alias("payload"))

    none = F.lit(None).cast("string")
    parts = (
        F.when(r == "user", F.array(p(0, "user", "text", none, F.col(content))))
        .when(r.isin(*ROLE_MODEL_ALIASES), F.array(p(0, "model", "text", none, F.col(content))))
        .when(r == "tool", F.array(
            p(0, "model", "function_call", F.col(tool_name), F.coalesce(F.col(args), F.lit("{}"))),
            p(1, "user", "function_response", F.col(tool_name),
              F.concat(F.lit('{"result": '), F.coalesce(F.col(observation), F.lit("{}")), F.lit("}")))))
        .otherwise(F.array().cast(f"array<{part}>"))
    )
    keep = [c for c in turns.columns if c not in (content, args, observation)]
    return turns.select(*keep, F.inline(parts))


def cache_latest(log: DataFrame, doc: str = "doc_id", key: str = "key", value: str = "value",
                 order: tuple[str, ...] = ("ts",)) -> DataFrame:
    """Latest value per (doc, key) by (order...), with the number of writes."""
    return log.groupBy(doc, key).agg(
        F.max_by(F.col(value), F.struct(*[F.col(c) for c in order])).alias(value),
        F.count(F.lit(1)).alias("n_writes"),
    )


def cache_map(latest: DataFrame, doc: str = "doc_id", key: str = "key", value: str = "value") -> DataFrame:
    """C5 (one row per doc): key -> value map over the already reduced state
    (at most one entry per key of the document)."""
    return latest.groupBy(doc).agg(F.map_from_entries(F.collect_list(F.struct(key, value))).alias("entries"))


def cache_lookup(requests: DataFrame, latest: DataFrame, doc: str = "doc_id", key: str = "key",
                 value: str = "value") -> DataFrame:
    """Value per requested (doc, key), null on a miss, with a hit flag."""
    right = latest.select(doc, key, value).withColumn("_hit", F.lit(True))
    out = requests.select(doc, key).join(right, [doc, key], "left")
    return out.select(doc, key, value, F.coalesce(F.col("_hit"), F.lit(False)).alias("hit"))


def open_cache(spark: SparkSession, root: str, log: DataFrame, doc: str = "doc_id", key: str = "key", value: str = "value",
               order: tuple[str, ...] = ("ts",)) -> CommittedTables:
    """C5 kept up to date: the state of a cache log of the columns of ``log``, under ``root``."""
    fields = log.select(F.col(doc), F.col(key), F.col(value), F.struct(*order).alias("at")).schema.fields
    return CommittedTables.open(spark, root, {"state": StructType([*fields, StructField("n_writes", LongType())])})


def merged_state(state: DataFrame) -> DataFrame:
    doc, key, value = state.columns[:3]
    latest = F.max_by(F.struct(value, "at"), "at")
    out = state.groupBy(doc, key).agg(latest.alias("x"), F.sum("n_writes").alias("n_writes"))
    return out.select(doc, key, F.col("x").getField(value).alias(value), F.col("x.at").alias("at"), "n_writes")


def add_to_cache(cache: CommittedTables, part: DataFrame, name: str, compact_every: int = 16) -> bool:
    """A new part of the log, by its name, once: only the part itself is read and reduced to a row for
    each (doc, key), in the map tasks first. When many parts have come together, their rows become
    one for each (doc, key). False if the part was added before."""
    doc, key, value, at, _ = cache.tables["state"].names
    order = [f.name for f in cache.tables["state"][at].dataType.fields]
    rows = part.select(doc, key, value, F.struct(*order).alias("at"), F.lit(1).cast("long").alias("n_writes"))
    added = cache.write(name, state=merged_state(rows))
    if added and cache.live("state").count() >= compact_every:
        cache.compact("state", merged_state)
    return added


def cache_now(cache: CommittedTables) -> DataFrame:
    """``cache_latest`` of all parts added so far, from their rows and not from the log. A
    part that comes late counts by its own order, not by when it was added."""
    doc, key, value = cache.tables["state"].names[:3]
    return merged_state(cache.read("state").drop("batch")).select(doc, key, value, "n_writes")
