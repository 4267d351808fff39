"""Mixing sources to target weights.

Words are counted per source, targets are shared out by weight (a source stops at a limit
times its size, what it leaves goes to the others by weight), and target / size is a source's
repetition rate: each document is emitted floor(rate) times, and once more with the
probability of the fraction, by a hash of its id and a seed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textmill.llm import base

WEIGHTS = (5, 2, 1)


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(base.WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, limit: int = 3, share: float = 1.0) -> DataFrame:
    """(source, source_size, target): ``sizes`` has rows (source, size); the sources, by code
    point and null last, weigh ``weights`` in turn. One row a source, so the ordering
    window holds the list of sources only, never documents."""
    by = sizes.groupBy("source").agg(F.coalesce(F.sum("size"), F.lit(0)).cast("long").alias("source_size"))
    turn = F.row_number().over(Window.partitionBy(F.lit(1)).orderBy(F.col("source").asc_nulls_last())) - 1
    by = by.withColumn("w", F.element_at(F.array(*map(F.lit, weights)), (turn % len(weights) + 1).cast("int")).cast("double"))
    # the level (words a unit of weight) at which the sources from here on, by cap, share what
    # the ones before leave; the first level that is not above its own source's cap holds, and
    # levels only fall from there
    by = by.withColumn("cap", F.lit(limit) * F.col("source_size") / F.col("w"))
    order = Window.partitionBy(F.lit(1)).orderBy("cap", F.col("source").asc_nulls_last())
    whole = Window.partitionBy(F.lit(1))
    left = F.sum("source_size").over(whole) * F.lit(share) - limit * F.coalesce(F.sum("source_size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    by = by.withColumn("level", left / F.sum("w").over(order.rowsBetween(0, Window.unboundedFollowing)))
    level = F.max(F.when(F.col("level") <= F.col("cap"), F.col("level"))).over(whole)
    most = (F.lit(limit) * F.col("source_size")).cast("double")
    return by.select("source", "source_size", F.coalesce(F.least(most, level * F.col("w")), most).alias("target"))


def chance(doc_id: str, seed: int) -> Column:
    """A number in [0, 1) from the first 32 bits of md5(seed:doc_id)."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("null")))), 1, 8), 16, 10).cast("double") / 4294967296.0


def source_key(source: str) -> Column:
    """A key that also tells null from every text."""
    return F.coalesce(F.concat(F.lit("s"), F.col(source).cast("string")), F.lit("n"))


def rates(sizes: DataFrame, weights: tuple = WEIGHTS, limit: int = 3, share: float = 1.0, seeds: int = 8) -> DataFrame:
    """One row a source: __key, __source_size, __target, __whole (copies of every document),
    __fraction (chance of one more) and __seed (whose draws are used).

    The Bernoulli draws of ``seeds`` hash seeds are summed per source in one pass, and each
    source uses the seed whose words come nearest to its target (the smaller seed on a tie):
    with few or very uneven documents a single draw can miss by many per cent."""
    by = targets(sizes, weights, limit, share)
    rate = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(limit)))).otherwise(0.0)
    by = by.select(source_key("source").alias("__key"), F.col("source_size").alias("__source_size"), F.col("target").alias("__target"), F.floor(rate).cast("int").alias("__whole"), (rate - F.floor(rate)).alias("__fraction"))
    by = base.stage(by, "mix-targets")
    drawn = sizes.select("doc_id", "size", source_key("source").alias("__key")).join(by.select("__key", "__fraction"), "__key")
    sums = drawn.groupBy("__key").agg(*[F.sum(F.when(chance("doc_id", k) < F.col("__fraction"), F.col("size")).otherwise(0)).alias(f"d{k}") for k in range(seeds)])
    miss = lambda k: F.abs(F.col("__whole") * F.col("__source_size") + F.col(f"d{k}") - F.col("__target"))
    best = F.array_min(F.array(*[F.struct(miss(k).alias("miss"), F.lit(k).alias("k")) for k in range(seeds)]))["k"]
    return base.stage(by.join(sums, "__key").select(*by.columns, best.alias("__seed")), "mix-rates")


def with_copies(rows: DataFrame, by: DataFrame, seeds: int) -> DataFrame:
    """``rows`` with the columns of ``rates`` of its source and __copies. Rows meet their
    source's row only: it is broadcast as long as Spark finds the table of sources small."""
    draw = F.element_at(F.array(*[chance("doc_id", k) for k in range(seeds)]), F.col("__seed") + 1)
    out = rows.withColumn("__key", source_key("source")).join(by, "__key")
    return out.withColumn("__copies", F.col("__whole") + (draw < F.col("__fraction")).cast("int"))


def sizes_of(docs: DataFrame) -> DataFrame:
    return base.stage(docs.select("doc_id", "source", word_count("text").alias("size")), "mix-sizes")


def plan(docs: DataFrame, weights: tuple = WEIGHTS, limit: int = 3, share: float = 1.0, seeds: int = 8) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken) of every document.

    Reruns agree; repeated rows with one doc_id draw alike. A null text has size 0, a null
    source is a source of its own, a source without words has rate 0; an empty table gives no
    rows. Columns of ``docs`` other than doc_id, text and source play no part."""
    sizes = sizes_of(docs)
    out = with_copies(sizes, rates(sizes, weights, limit, share, seeds), seeds)
    return out.select("doc_id", "source", "size", F.col("__source_size").alias("source_size"), F.col("__target").alias("target"), F.col("__copies").alias("copies"), (F.col("__copies") * F.col("size")).cast("long").alias("taken"))


def mix(docs: DataFrame, weights: tuple = WEIGHTS, limit: int = 3, share: float = 1.0, seeds: int = 8) -> DataFrame:
    """``docs`` with each row as often as the mix takes it (all columns, no others). Rows travel
    as one struct, so other columns may have any names."""
    rows = base.packed(docs, "doc_id", "source")
    out = with_copies(rows, rates(sizes_of(docs), weights, limit, share, seeds), seeds)
    return base.unpacked(out.withColumn("__n", F.explode(F.expr("array_repeat(0, __copies)"))), docs.columns)
