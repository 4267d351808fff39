"""Exact semantic search against brute force, on structured and unstructured vectors."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from textmill.operators import vectors as V

VEC = "vec_id long, embedding array<float>, label int"


def clustered(n, d, seed=1, clusters=12):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(clusters, d))
    x = centres[r.integers(0, clusters, n)] + 0.05 * r.normal(size=(n, d))
    x[n // 2 : n // 2 + 30] = x[0]  # many equal vectors
    return x.astype(np.float32)


def brute(ids, x, q, k, skip):
    u = x.astype(float)
    u /= np.sqrt((u * u).sum(axis=1, keepdims=True))
    out = {}
    for i in q:
        s = np.round(u @ u[i], V.PLACES) + 0.0
        order = [j for j in np.lexsort((ids, -s)) if not (skip and ids[j] == ids[i])][:k]
        out[ids[i]] = [(ids[j], s[j]) for j in order]
    return out


def answers(found):
    out = {}
    for r in found.orderBy("query", "rank").collect():
        out.setdefault(r["query"], []).append((r["id"], r["score"]))
    return out


@pytest.mark.parametrize("kind", ["clustered", "unstructured"])
@pytest.mark.parametrize("skip", [True, False])
def test_equals_brute_force(spark, monkeypatch, kind, skip):
    monkeypatch.setattr(V, "BLOCK_ROWS", 40)
    monkeypatch.setattr(V, "QUERY_ROWS", 7)
    x = clustered(900, 12) if kind == "clustered" else np.random.default_rng(3).normal(size=(900, 12)).astype(np.float32)
    ids = list(range(100, 1000))
    rows = spark.createDataFrame([(i, v.tolist(), 1) for i, v in zip(ids, x)], VEC).repartition(5)
    for c in ("id", "v", "block", "cell", "near", "far", "n", "score", "rank", "query"):
        rows = rows.withColumn(c, F.lit("x"))
    index = V.build_index(rows, cells=12)
    got = answers(V.search(index, rows.where("vec_id % 20 = 0"), top_k=7, skip_same=skip))
    assert got == brute(ids, x, [k for k, i in enumerate(ids) if i % 20 == 0], 7, skip)


def test_bounds_leave_blocks_of_other_clusters_out(spark, monkeypatch):
    monkeypatch.setattr(V, "BLOCK_ROWS", 50)
    pairs = []
    real = V.promising
    monkeypatch.setattr(V, "promising", lambda *a, **k: pairs.append(real(*a, **k)) or pairs[-1])
    x = clustered(1200, 16, seed=5)
    rows = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], VEC)
    index = V.build_index(rows, cells=12)
    V.search(index, rows.where("vec_id % 50 = 0"), top_k=5).collect()
    blocks, visited = index.blocks.count(), sum(p.count() for p in pairs)
    queries = index.blocks.select("cell").distinct().count()
    assert visited < 0.5 * blocks * queries  # all pairs would be every block for each block of queries


def test_no_block_grows_and_every_vector_is_indexed(spark, monkeypatch):
    monkeypatch.setattr(V, "BLOCK_ROWS", 25)
    rows = spark.createDataFrame([(i, [1.0, 0.0], 1) for i in range(500)] + [(i, [float(i), 1.0], 1) for i in range(500, 700)], VEC)
    index = V.build_index(rows)
    found = index.blocks.select("n", F.explode("ids").alias("id")).collect()
    assert sorted(r["id"] for r in found) == list(range(700)) and max(r["n"] for r in found) <= 25


def test_odd_vectors_and_tables(spark):
    bad = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [None, 1.0]), (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0])]
    rows = spark.createDataFrame([(i, v, None) for i, v in bad] + [(7, [1.0, 0.0], None), (8, [2.0, 0.0], None), (None, [3.0, 0.1], None)], VEC)
    got = answers(V.search(V.build_index(rows), rows.where("vec_id < 8"), top_k=5))
    assert got == {7: [(8, 1.0), (None, round(3 / np.sqrt(9 + np.float64(np.float32(0.1)) ** 2), 9))]}
    empty = spark.createDataFrame([], VEC)
    assert V.search(V.build_index(empty), rows, top_k=3).collect() == []
    assert V.search(V.build_index(rows), empty, top_k=3).collect() == []
    with pytest.raises(ValueError, match="several lengths"):
        V.build_index(spark.createDataFrame([(1, [1.0], 1), (2, [1.0, 2.0], 1)], VEC))
    with pytest.raises(ValueError, match="top_k"):
        V.search(V.build_index(rows), rows, top_k=0)


def test_repeated_queries_are_answered_each(spark):
    rows = spark.createDataFrame([(i, [float(i), 1.0], 1) for i in range(20)], VEC)
    twice = rows.where("vec_id = 3")
    out = V.search(V.build_index(rows), twice.unionAll(twice), top_k=4)
    assert out.count() == 8
