"""Batches, ranks and stems that do not grow with the input."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from textmill.functions import porter, textrank
from textmill.operators import resumable as R
from textmill.operators.inference import echo_model


def test_batches_of_the_resumed_stage_have_a_bound(spark, tmp_path):
    rows = spark.range(400).select(F.col("id").alias("doc_id"), F.concat(F.col("id").cast("string"), F.repeat(F.lit("x"), 800)).alias("request"))
    log = R.open_answers(spark, str(tmp_path / "answers"))
    out = R.answer(rows, log, echo_model, "v", tasks=2, waves=2, batch_cost=20_000).collect()
    assert len(out) == 400 and all(r["n_sent"] == 1 and r["error"] is None and r["response"].startswith("{") for r in out)
    assert log.commits().count() == 2  # still so many waves
    placed = R.in_batches(rows.select(F.sha2("request", 256).alias("request_hash"), "request"), 4, 20_000)
    costs = [r["c"] for r in placed.groupBy("batch").agg(F.sum("cost").alias("c")).collect()]
    assert len(costs) > 4 and max(costs) <= 20_000 + 1_100  # and one request


@pytest.mark.parametrize("n", [1, 2, 7, 40])
def test_ranks_by_pairs_equal_ranks_by_words(n, monkeypatch):
    rng = np.random.default_rng(n)
    sents = [" ".join(rng.choice(["a", "b", "cd", "ef", "g1", "hi"], rng.integers(1, 9))) for _ in range(n)]
    fast = textrank.ranks(sents, 20, 0.85)
    monkeypatch.setattr(textrank, "PAIRS", 0)
    assert np.allclose(fast, textrank.ranks(sents, 20, 0.85), rtol=0, atol=1e-13)


def test_stems_take_distinct_words_once(spark):
    data = [(1, ["running", "the", "running"]), (2, []), (3, None), (4, ["flies", None, "ab"]), (5, ["running"])]
    d = spark.createDataFrame(data[:3] + data[4:], "id int, t array<string>").coalesce(1)
    seen = spark.sparkContext.accumulator(0)
    real = porter.stem_long_words

    def counted(tokens, min_len=4):
        seen.add(len(tokens))
        return real(tokens, min_len)

    udf, old = porter.stem_tokens_udf(), porter.stem_long_words
    porter.stem_long_words = counted
    try:
        direct = udf.func(__import__("pyarrow").array([x for _, x in data[:3]] + [["running"]]))
    finally:
        porter.stem_long_words = old
    assert direct.to_pylist() == [["run", "the", "run"], [], None, ["run"]] and seen.value == 2
    assert {r["id"]: r["s"] for r in d.select("id", udf("t").alias("s")).collect()} == {1: ["run", "the", "run"], 2: [], 3: None, 5: ["run"]}
