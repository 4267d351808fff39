"""Sharding by sampled splitters.

Documents are keyed by the hash of their text, so equal texts are neighbours. A size-weighted
sample of keys gives quantiles that split the keys into ranges; records are partitioned by
range; ranges that turn out overfull, in bytes or in rows, are sampled again and subdivided.
Shards are cut out of the ranges in order, each up to its share of the bytes. Keys that weigh
much (a long text, or many copies of one) have ranges of their own, which are placed whole
where a shard has room and are cut between documents where none has.

Only keys with their sizes are sampled and partitioned; what comes to the driver is bounded by
the number of ranges, not by the number of documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from textmill.llm import base

#: Ranges that the first splitters make, and keys drawn for each of them.
RANGES, DRAWS = 1024, 64
#: A range is overfull above this many times the mean of bytes or of rows.
OVERFULL = 4
#: Rows under which a range is never subdivided: a task sorts them at once.
FEW_ROWS = 1_000
#: A text hash drawn this often is looked at exactly; it is heavy above the part HEAVY of a shard,
#: in bytes or in rows, for which some 20 draws are expected.
OFTEN, HEAVY = 4, 0.005

LEAST, LAST = -(1 << 63), (1 << 63) - 1
KEY = ("a", "b")


def size_of(text: Column) -> Column:
    """UTF-8 bytes of the text (null: none) plus 1."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def keyed(docs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, size, text_crc32 and the key (a: hash of the text, b: hash of the document and
    of the row's own number, so that no two rows share a key), written once."""
    text = F.col("text").cast("string")
    columns = [F.col("doc_id"), size_of(text).alias("size"), F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32")]
    columns += [F.xxhash64(F.lit(11), text).alias("a"), F.xxhash64(F.lit(12), F.col("doc_id").cast("string"), F.monotonically_increasing_id()).alias("b")]
    if keep:
        columns.append(F.struct(*[F.col(c) for c in keep]).alias("kept"))
    return base.stage(docs.select(columns), "shards-keyed")


def uniform(seed: int) -> Column:
    """A number in [0, 1) for each key, the same in every run."""
    return F.pmod(F.xxhash64(F.lit(seed), "a", "b"), F.lit(1 << 52)).cast("double") / float(1 << 52)


def drawn(rows: DataFrame, weight: Column, draws: int, seed: int) -> list:
    """Keys (a, b) and how often each is drawn, in order; ``weight`` sums to 1, and so about
    ``draws`` are drawn in all, however many rows there are."""
    often = F.floor(weight * draws + uniform(seed)).cast("long")
    return sorted((r["a"], r["b"], r["often"]) for r in rows.select(*KEY, often.alias("often")).where("often > 0").collect())


def quantiles(sample: list, pieces: int) -> list[tuple[int, int]]:
    """At most ``pieces`` - 1 keys that split a sorted sample into parts of equal weight."""
    total, done, part, out = sum(s[2] for s in sample), 0, 0, []
    for a, b, often in sample:
        if done * pieces // total > part:
            part = done * pieces // total
            out.append((a, b))
        done += often
    return out


def packed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Keys as strings of 16 bytes that sort as the pairs of numbers do."""
    out = np.empty((len(a), 2), ">u8")
    for at, x in enumerate((a, b)):
        out[:, at] = np.ascontiguousarray(x, np.int64).view(np.uint64) ^ np.uint64(1 << 63)
    return out.view("V16").ravel().view("S16")


def with_range(rows: DataFrame, splitters: list[tuple[int, int]]) -> DataFrame:
    """``rows`` with the number of splitters at or below each key, as ``part``."""
    cuts = packed(np.array([s[0] for s in splitters], np.int64), np.array([s[1] for s in splitters], np.int64))
    at = [rows.columns.index(c) for c in KEY]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = packed(*(batch.column(i).to_numpy() for i in at))
            yield base.frame_of(batch, part=np.searchsorted(cuts, keys, "right").astype(np.int32))

    return rows.mapInArrow(base.tidy(run), StructType([*rows.schema.fields, StructField("part", IntegerType())]))


def heavy_texts(rows: DataFrame, sample: list, bytes_over: float, rows_over: float) -> dict[int, int]:
    """Bytes of the text hashes that were drawn ``OFTEN`` or more and hold more than that."""
    often: dict[int, int] = {}
    for a, _, n in sample:
        often[a] = often.get(a, 0) + n
    seen = [(a,) for a, n in often.items() if n >= OFTEN]  # at most draws / OFTEN
    if not seen:
        return {}
    wanted = rows.sparkSession.createDataFrame(seen, "a long")
    sums = rows.join(F.broadcast(wanted), "a", "left_semi").groupBy("a").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))
    return {r["a"]: r["bytes"] for r in sums.where((F.col("bytes") > bytes_over) | (F.col("n") > rows_over)).collect()}


def lines_for(heavy: dict[int, int], total: int, shards: int) -> dict[int | None, list[tuple[int, int]]]:
    """Where each heavy text's documents go, and (None) where all others go, as (bytes up to
    here, shard) in rising order: the heaviest text first, whole to the emptiest shard if it
    has room, else as much as each of the emptiest takes; the others fill what room is left."""
    room = [(total * (s + 1)) // shards - (total * s) // shards for s in range(shards)]
    lines: dict[int | None, list[tuple[int, int]]] = {}
    for a, size in sorted(heavy.items(), key=lambda x: (-x[1], x[0])):
        lines[a], done = [], 0
        while done < size:  # the rooms add up to all that is not placed yet
            s = max(range(shards), key=lambda i: (room[i], -i))
            some = min(room[s], size - done)
            done, room[s] = done + some, room[s] - some
            lines[a].append((done, s))
    lines[None] = [(sum(room[: s + 1]), s) for s in range(shards)]
    return lines


def subdivided(rows: DataFrame, splitters: list[tuple[int, int]], total: int, n: int) -> tuple[list[tuple[int, int]], list]:
    """Splitters after every overfull range has been sampled again and split, and (part, rows,
    bytes) of all ranges. New splitters lie between texts where they can."""
    seed = 100
    while True:
        held = with_range(rows, splitters)
        counts = sorted((r["part"], r["n"], r["bytes"]) for r in held.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes")).collect())
        full = [(p, m, size) for p, m, size in counts if m > FEW_ROWS and (size > OVERFULL * total / RANGES or m > OVERFULL * n / RANGES)]
        if not full:
            return splitters, counts
        table = [(p, m, size, max(2, -(-size * RANGES // total), -(-m * RANGES // n))) for p, m, size in full]
        parts = rows.sparkSession.createDataFrame(table, "part int, of_rows long, of_bytes long, pieces long")
        inside = held.join(F.broadcast(parts), "part")
        often = F.floor((F.col("size") / F.col("of_bytes") + 1 / F.col("of_rows")) / 2 * F.col("pieces") * DRAWS + uniform(seed)).cast("long")
        again: dict[int, list] = {}
        for r in inside.select("part", *KEY, often.alias("often")).where("often > 0").collect():
            again.setdefault(r["part"], []).append((r["a"], r["b"], r["often"]))
        begins = [(LEAST, LEAST), *splitters]
        more = set(splitters)
        for p, _, _, pieces in table:
            more.update((a, LEAST) if a > begins[p][0] else (a, b) for a, b in quantiles(sorted(again.get(p, [])), pieces))
        if len(more) == len(splitters):  # nothing left to split
            return splitters, counts
        splitters, seed = sorted(more), seed + 1


def assign(docs: DataFrame, shards: int = 8, keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) of every document, and what is kept as one
    struct ``kept``: shards 0 to ``shards`` - 1 of nearly equal bytes, slots from 0 in each
    shard without gaps, in the order of the key.

    A document goes where the middle of its text's group falls, a group that weighs over
    ``HEAVY`` of a shard where ``lines_for`` says; so equal texts share a shard unless their
    group is larger than what any shard has room for, and no shard is off by more than such a
    light group or one document. Null texts are a group of their own with size 1, the empty
    text another; repeated rows are documents each; ties are ordered by a hash of the row; with
    fewer documents than shards some shards are empty; an empty table gives no rows."""
    rows = keyed(docs, keep)
    narrow = rows.select(*KEY, "size")
    n, total = narrow.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    if not n:
        return rows.select("doc_id", "size", "text_crc32", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"), *(["kept"] if keep else []))
    # half of a key's weight is its size; the other half, for its row, shows texts that are short but many
    sample = drawn(narrow, (F.col("size") / float(total) + 1.0 / n) / 2, RANGES * DRAWS, 1)
    heavy = heavy_texts(narrow, sample, total / shards * HEAVY, n / shards * HEAVY)
    lines = lines_for(heavy, total, shards)
    own = {(a, LEAST) for a in heavy} | {(a + 1, LEAST) for a in heavy if a < LAST}
    splitters, counts = subdivided(narrow, sorted(own | {(a, LEAST) for a, _ in quantiles(sample, RANGES)}), total, n)
    # the line of each range, and how many bytes of that line lie before it
    begins = [(LEAST, LEAST), *splitters]
    before: dict[int | None, int] = {}
    table = []
    for part, _, size in counts:
        a = begins[part][0] if begins[part][0] in heavy else None
        table.append((part, before.get(a, 0), a is not None, [{"upto": u, "shard": s} for u, s in lines[a]]))
        before[a] = before.get(a, 0) + size
    spark = rows.sparkSession
    ranges = spark.createDataFrame(table, "part int, bytes_before long, alone boolean, cuts array<struct<upto: long, shard: int>>")
    placed = with_range(rows, splitters).join(F.broadcast(ranges), "part")
    order = Window.partitionBy("part").orderBy(*KEY)
    group = Window.partitionBy("part", "a")
    upto = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = placed.withColumn("rn", F.row_number().over(order)).withColumn("upto", upto)
    whole = (F.min(F.col("upto") - F.col("size")).over(group) + F.max("upto").over(group)) / 2
    middle = F.col("bytes_before") + F.when(F.col("alone"), F.col("upto") - F.col("size") / 2).otherwise(whole)
    fitting = F.filter("cuts", lambda c: middle < c["upto"])
    last = F.element_at("cuts", -1)
    placed = placed.withColumn("shard", F.coalesce(F.get(fitting, F.lit(0))["shard"], last["shard"]))
    placed = base.stage(placed.select("doc_id", "size", "text_crc32", "part", "rn", "shard", *(["kept"] if keep else [])), "shards-placed")
    # first slots: at most one row for each cut of each range
    runs = placed.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"), F.min("rn").alias("first")).collect()
    starts, slot = [], {}
    for r in sorted(runs, key=lambda r: (r["shard"], r["part"])):
        starts.append((r["shard"], r["part"], slot.get(r["shard"], 0) - r["first"]))
        slot[r["shard"]] = slot.get(r["shard"], 0) + r["n"]
    first = spark.createDataFrame(starts, "shard int, part int, offset long")
    out = placed.join(F.broadcast(first), ["shard", "part"])
    return out.select("doc_id", "size", "text_crc32", "shard", (F.col("offset") + F.col("rn")).alias("slot"), *(["kept"] if keep else []))


def write(docs: DataFrame, path: str, shards: int = 8) -> None:
    """``docs`` as Parquet in one folder a shard (path/shard=0 ...), rows in the order of
    their slots; a shard of many bytes takes many files. The columns are those of ``docs``."""
    folder = "shard"
    while folder in docs.columns:
        folder += "_"
    placed = assign(docs, shards, keep=tuple(docs.columns))
    rows = placed.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    rows.select(*[F.col("kept").getField(c).alias(c) for c in docs.columns], F.col("shard").alias(folder)).write.partitionBy(folder).parquet(path)
