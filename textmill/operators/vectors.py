"""Semantic search (X2): the k most similar vectors of a table for every query vector, exactly.

``build_index`` gives each vector the nearest of a few centres and its angle to it. Vectors of
a cell, ordered by that angle, are packed into blocks, so a block is the part of a cell between
two angles (``near`` and ``far``) and no block grows with the table. ``search`` first looks at
the most promising blocks of each query, which bounds the angle its k-th neighbour can have. By
the triangle inequality of angles a vector of a block is at least ``a - far`` and ``near - a``
away from a query that is ``a`` away from the centre: blocks that lie beyond the bound are left
out, all others are compared. Nothing is lost: vectors without any structure only lead to more
blocks. Of each query and block at most k rows leave a task.

Similarity is the cosine in double precision, rounded to 9 places; ties go to the smaller key.
Null, empty and zero vectors, and those with null or non-finite entries, are never found and,
as queries, find nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textmill.session import stage_table

#: Centres, and vectors (by a hash of their key) that they are fitted on.
CELLS, SAMPLE = 64, 8_192
#: Vectors in a block at most; more where the table would have over BLOCKS blocks.
BLOCK_ROWS, BLOCKS = 2_048, 65_536
QUERY_ROWS = 256
PLACES = 9
SLACK = 1e-6  # radians that rounding may cost a bound


@dataclass
class VectorIndex:
    """centres: unit vectors as rows. blocks: (block, cell, near, far, n, ids, vectors), the
    vectors as 32-bit floats one after the other."""

    centres: np.ndarray
    blocks: DataFrame
    rows: int


def usable(vector: Column) -> Column:
    fine = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    whole = F.forall(vector, lambda c: F.coalesce(fine(c.cast("float")), F.lit(False)))
    return F.coalesce(whole & F.exists(vector, lambda c: c.cast("float") != 0), F.lit(False))


def vectors_of(rows: DataFrame, vector: str, key: str) -> DataFrame:
    return rows.where(usable(F.col(vector))).select(F.col(key).alias("id"), F.col(vector).cast("array<float>").alias("v"))


def unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def angles(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(x @ centres.T, -1.0, 1.0))


def fit_centres(sample: np.ndarray, cells: int, rounds: int = 8) -> np.ndarray:
    """Spherical k-means on a bounded sample of unit vectors."""
    centres = np.unique(sample, axis=0)
    centres = centres[np.random.default_rng(7).permutation(len(centres))[:cells]]
    for _ in range(rounds):
        own = (sample @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, sample)
        size = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
        centres = np.where(size > 1e-9, sums / np.maximum(size, 1e-9), centres)
    return centres


def matrix(lists: pa.Array) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)


def in_blocks(rows: DataFrame, centres: np.ndarray, most: int) -> DataFrame:
    """(id, v) packed by cell and angle: cell, near, far, n, ids, vectors. Ranges of (cell,
    angle, id) are spread over the tasks, so a large cell, or many equal vectors, take many."""
    kind = dict(rows.dtypes)["id"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                a = angles(unit(matrix(b.column(1))), centres)
                cell = a.argmin(axis=1)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell.astype(np.int32)), pa.array(a[np.arange(len(a)), cell])], ["id", "v", "cell", "angle"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        cell, n = None, 0

        def block() -> pa.RecordBatch:
            x = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            angle, ids = x.column(3).to_numpy(), pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), x.column(0))
            data = matrix(x.column(1)).astype(np.float32).tobytes()
            arrays = [pa.array([cell], pa.int32()), pa.array([angle.min()]), pa.array([angle.max()]), pa.array([n], pa.int32()), ids, pa.array([data], pa.binary())]
            return pa.RecordBatch.from_arrays(arrays, ["cell", "near", "far", "n", "ids", "vectors"])

        for b in batches:
            lo, cells = 0, b.column(2).to_numpy()
            while lo < b.num_rows:
                if cell is not None and (cells[lo] != cell or n >= most):
                    yield block()
                    held, n = [], 0
                cell = int(cells[lo])
                other = np.flatnonzero(cells[lo : lo + most - n] != cell)
                hi = lo + int(other[0]) if len(other) else min(b.num_rows, lo + most - n)
                held.append(b.slice(lo, hi - lo))
                n, lo = n + hi - lo, hi
        if held:
            yield block()

    placed = rows.mapInArrow(place, f"id {kind}, v array<float>, cell int, angle double")
    ordered = placed.repartitionByRange("cell", "angle", "id").sortWithinPartitions("cell", "angle", "id")
    return ordered.mapInArrow(pack, f"cell int, near double, far double, n int, ids array<{kind}>, vectors binary")


def build_index(rows: DataFrame, vector: str = "embedding", key: str = "vec_id", cells: int = CELLS) -> VectorIndex:
    """Index every usable vector of ``rows``; all must be of one length. The centres come from
    at most ``SAMPLE`` vectors, which bears on speed only. The blocks are written in the shared
    folder."""
    v = vectors_of(rows, vector, key)
    lengths = [r[0] for r in v.select(F.size("v")).distinct().limit(2).collect()]
    if len(lengths) > 1:
        raise ValueError(f"vectors of several lengths: {sorted(lengths)}")
    sample = v.orderBy(F.xxhash64(F.col("id").cast("string")), "id").limit(SAMPLE).select("v").collect() if lengths else []
    centres = fit_centres(unit(np.array([r[0] for r in sample], np.float32)), cells) if sample else np.zeros((1, 1))
    n = v.count()
    blocks = in_blocks(v, centres, max(BLOCK_ROWS, -(-n // BLOCKS)))
    return VectorIndex(centres, stage_table(blocks.withColumn("block", F.monotonically_increasing_id()), "vector-blocks"), n)


def promising(index: VectorIndex, packed: DataFrame, meta: np.ndarray, wanted: int, bounded: bool) -> DataFrame:
    """(qblock, block): blocks to compare with the queries of a query block. Without bounds,
    for each query the nearest that hold ``wanted`` vectors; with bounds (``limits``: for each
    query the angle of its k-th neighbour so far) all within reach that were not compared yet."""
    centres = index.centres
    block, cell, near, far, size = meta["block"], meta["cell"], meta["near"], meta["far"], meta["n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                n = b.column(1)[i].as_py()
                x = unit(np.frombuffer(b.column(2)[i].as_buffer(), np.float32).reshape(n, -1))
                found: set[int] = set()
                for lo in range(0, n, 32):
                    a = angles(x[lo : lo + 32], centres)[:, cell]
                    least = np.maximum(np.maximum(a - far, near - a), 0.0)
                    if bounded:
                        limit = np.array(b.column(3)[i].as_py()[lo : lo + 32])[:, None]
                        found.update(block[(least <= limit + SLACK).any(axis=0)].tolist())
                    else:
                        for order, own in zip(np.lexsort((a, least), axis=1), range(len(a))):
                            found.update(block[order[: 1 + int(np.searchsorted(np.cumsum(size[order]), wanted))]].tolist())
                if bounded:
                    found -= set(b.column(4)[i].as_py())
                yield pa.RecordBatch.from_arrays([pa.array([b.column(0)[i].as_py()] * len(found), pa.int64()), pa.array(sorted(found), pa.int64())], ["qblock", "block"])

    columns = ["qblock", "n", "vectors", *(["limits", "seen"] if bounded else [])]
    return packed.select(columns).mapInArrow(run, "qblock long, block long")


def compared(index: VectorIndex, packed: DataFrame, pairs: DataFrame, top_k: int, skip_same: bool) -> DataFrame:
    """(query, place, qblock, block, id, score): of every query and block at most ``top_k`` rows, in order."""
    kinds = dict(packed.dtypes)["ids"][6:-1], dict(index.blocks.dtypes)["ids"][6:-1]
    limits = F.col("limits") if "limits" in packed.columns else F.lit(None).cast("array<double>").alias("limits")
    q = packed.select("qblock", F.col("n").alias("q_n"), F.col("ids").alias("q_ids"), F.col("vectors").alias("q_vectors"), limits)
    joined = pairs.join(q, "qblock").join(index.blocks.select("block", "n", "ids", "vectors"), "block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            col = {name: b.column(i) for i, name in enumerate(b.schema.names)}
            for i in range(b.num_rows):
                q_n, n = col["q_n"][i].as_py(), col["n"][i].as_py()
                x = unit(np.frombuffer(col["q_vectors"][i].as_buffer(), np.float32).reshape(q_n, -1))
                y = unit(np.frombuffer(col["vectors"][i].as_buffer(), np.float32).reshape(n, -1))
                q_ids, ids = col["q_ids"][i].values, col["ids"][i].values
                scores = np.round(x @ y.T, PLACES) + 0.0
                if col["limits"][i].is_valid:  # what is too far for a query's first k is left out
                    floor = np.cos(np.minimum(np.array(col["limits"][i].as_py()) + SLACK, np.pi))
                    scores[scores < floor[:, None]] = -np.inf
                if skip_same:
                    scores[q_ids.to_numpy(zero_copy_only=False)[:, None] == ids.to_numpy(zero_copy_only=False)[None, :]] = -np.inf
                rank = key_order(ids)  # ties go to the smaller key
                place, at = [], []
                for k in range(q_n):
                    s = scores[k]
                    good = np.flatnonzero(s >= (np.partition(s, n - top_k)[n - top_k] if n > top_k else -2.0))
                    good = good[s[good] > -2.0]
                    good = good[np.lexsort((rank[good], -s[good]))][:top_k]
                    place += [k] * len(good)
                    at += good.tolist()
                if at:
                    arrays = [q_ids.take(pa.array(place)), pa.array(place, pa.int32()), pa.array([col["qblock"][i].as_py()] * len(at), pa.int64()), pa.array([col["block"][i].as_py()] * len(at), pa.int64()), ids.take(pa.array(at)), pa.array(scores[place, at])]
                    yield pa.RecordBatch.from_arrays(arrays, ["query", "place", "qblock", "block", "id", "score"])

    return joined.mapInArrow(run, f"query {kinds[0]}, place int, qblock long, block long, id {kinds[1]}, score double")


def key_order(ids: pa.Array) -> np.ndarray:
    """Place of each key in ascending order, null keys first as Spark has them."""
    order = pc.sort_indices(ids, null_placement="at_start").to_numpy()
    out = np.empty(len(order), np.int64)
    out[order] = np.arange(len(order))
    return out


def best(found: DataFrame, top_k: int) -> DataFrame:
    """The first ``top_k`` of every query; the rank filter plans as a WindowGroupLimit, so no
    task sends more than that of a query."""
    order = Window.partitionBy("qblock", "place").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top_k)


def search(index: VectorIndex, queries: DataFrame, vector: str = "embedding", key: str = "vec_id", top_k: int = 10,
           skip_same: bool = True) -> DataFrame:
    """(query, rank, id, score), the ``top_k`` vectors of the index with the greatest cosine
    for every row of ``queries``; with ``skip_same`` a query does not find its own key. Queries
    of equal keys are answered each."""
    if not isinstance(top_k, int) or isinstance(top_k, bool) or top_k < 1:
        raise ValueError("top_k must be a positive integer")
    v = vectors_of(queries, vector, key)
    kinds = dict(v.dtypes)["id"], dict(index.blocks.dtypes)["ids"][6:-1]
    meta = index.blocks.select("block", "cell", "near", "far", "n").orderBy("block").collect()  # at most about BLOCKS rows
    if not meta:
        return v.sparkSession.createDataFrame([], f"query {kinds[0]}, rank int, id {kinds[1]}, score double")
    meta = np.array([tuple(r) for r in meta], [("block", np.int64), ("cell", np.int64), ("near", float), ("far", float), ("n", np.int64)])
    packed = in_blocks(v, index.centres, QUERY_ROWS).withColumn("qblock", F.monotonically_increasing_id())
    packed = stage_table(packed.select("qblock", "n", "ids", "vectors"), "vector-queries")
    pairs = stage_table(promising(index, packed, meta, top_k + skip_same, bounded=False), "vector-pairs")
    first = stage_table(best(compared(index, packed, pairs, top_k, skip_same), top_k), "vector-first")
    # the angle that a query's k-th neighbour has at most; pi where there are not yet k
    known = first.groupBy("qblock", "place").agg(F.min("score").alias("least"), F.count(F.lit(1)).alias("n_found"))
    angle = F.when(F.col("n_found") < top_k, F.lit(np.pi)).otherwise(F.acos(F.greatest(F.least(F.col("least") - 2.0 * 10**-PLACES, F.lit(1.0)), F.lit(-1.0))))
    limits = known.groupBy("qblock").agg(F.map_from_entries(F.collect_list(F.struct("place", angle))).alias("by_place"))  # at most QUERY_ROWS
    seen = pairs.groupBy("qblock").agg(F.collect_list("block").alias("seen"))  # a few for each query
    every = F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda i: F.coalesce(F.try_element_at("by_place", i), F.lit(np.pi)))
    bounded = packed.join(limits, "qblock", "left").join(seen, "qblock", "left")
    bounded = bounded.withColumn("by_place", F.coalesce("by_place", F.create_map().cast("map<int,double>"))).withColumn("limits", every)
    bounded = stage_table(bounded.select("qblock", "n", "ids", "vectors", "limits", "seen"), "vector-bounded")
    more = promising(index, bounded, meta, top_k, bounded=True)
    rest = compared(index, bounded, stage_table(more, "vector-more"), top_k, skip_same)
    found = first.drop("rank").unionByName(rest)
    return best(found, top_k).select("query", "rank", "id", "score")
