"""Inference that goes on where it stopped, in batches of equal cost."""

import os
import tempfile
from collections import Counter
from statistics import median

import pytest
from pyspark.sql import functions as F

from textmill.operators import resumable as R
from textmill.sources.committed import CommittedTables


def requests(spark, n, skew=True):
    rows = [(i, f"request {i} " + "x" * (3000 if skew and i % 17 == 0 else 10 * (i % 30))) for i in range(n)]
    return spark.createDataFrame([*rows, (n, rows[0][1]), (n + 1, None)], "doc_id long, request string").repartition(3)


def model_writing_to(folder, fail=()):
    def make():
        def call(request):
            with open(f"{folder}/calls-{os.getpid()}", "a") as f:
                f.write(request.split("x")[0].strip() + "\n")
            if any(request.startswith(f"request {k} ") for k in fail):
                raise ValueError("no")
            return request[::-1]

        return call

    return make


def calls(folder):
    return Counter(line.strip() for name in os.listdir(folder) if name.startswith("calls-") for line in open(f"{folder}/{name}"))


def test_a_run_that_was_stopped_sends_only_the_rest(spark, monkeypatch):
    folder = tempfile.mkdtemp(prefix="tm-calls-")
    log, r = R.open_answers(spark, tempfile.mkdtemp(prefix="tm-answers-")), requests(spark, 200)
    real, seen = CommittedTables.commit, []

    def stopped(self, *a, **k):
        if len(seen) == 2:
            raise RuntimeError("stopped")
        seen.append(a)
        return real(self, *a, **k)

    monkeypatch.setattr(CommittedTables, "commit", stopped)
    with pytest.raises(RuntimeError):
        R.answer(r, log, model_writing_to(folder), "v1", tasks=3, waves=4)
    kept = {x["request_hash"] for x in log.read("answers").collect()}
    assert 60 < len(kept) < 140  # two of four waves
    monkeypatch.setattr(CommittedTables, "commit", real)
    before = sum(calls(folder).values())
    out = {x["doc_id"]: x for x in R.answer(r, log, model_writing_to(folder), "v1", tasks=3, waves=4).collect()}
    assert sum(calls(folder).values()) - before == 200 - len(kept)
    assert all(x["response"] == x2["request"][::-1] and x["n_sent"] == 1 for x2 in r.where("request IS NOT NULL").collect() for x in [out[x2["doc_id"]]])
    assert (out[201]["response"], out[201]["n_sent"]) == (None, 0)
    assert max(calls(folder).values()) <= 2 and out[200]["response"] == out[0]["response"]  # equal requests are one
    # nothing is left to do; another version of the model starts anew
    n = sum(calls(folder).values())
    R.answer(r, log, model_writing_to(folder), "v1", tasks=3, waves=4)
    assert sum(calls(folder).values()) == n
    R.answer(r, log, model_writing_to(folder), "v2", tasks=3, waves=4)
    assert sum(calls(folder).values()) == n + 200


def test_failed_requests_are_sent_again_and_then_given_up(spark):
    folder = tempfile.mkdtemp(prefix="tm-calls-")
    log, r = R.open_answers(spark, tempfile.mkdtemp(prefix="tm-answers-")), requests(spark, 40)
    fail = (3, 7)
    first = {x["doc_id"]: x for x in R.answer(r, log, model_writing_to(folder, fail), "v1", tasks=2, waves=2, passes=1).collect()}
    assert first[3]["error"] == "ValueError: no" and first[3]["n_sent"] == 1 and first[4]["error"] is None
    out = {x["doc_id"]: x for x in R.answer(r, log, model_writing_to(folder, (7,)), "v1", tasks=2, waves=2).collect()}
    assert out[3]["response"] is not None and out[3]["error"] is None and out[3]["n_sent"] == 2
    assert out[7]["response"] is None and out[7]["n_sent"] == 3 and out[7]["error"] == "ValueError: no"
    n = sum(calls(folder).values())
    R.answer(r, log, model_writing_to(folder), "v1", tasks=2, waves=2)
    assert sum(calls(folder).values()) == n  # given up


def test_batches_cost_the_same(spark):
    rows = requests(spark, 3000).where("request IS NOT NULL").select(F.sha2("request", 256).alias("request_hash"), "request").dropDuplicates(["request_hash"])
    costs = [r["c"] for r in R.in_batches(rows, 16).groupBy("batch").agg(F.sum("cost").alias("c")).collect()]
    assert len(costs) == 16 and max(costs) <= 1.2 * median(costs) and min(costs) >= 0.8 * median(costs)
    one = R.sent(R.in_batches(rows, 16).where("batch < 8"), lambda: str.upper, 8).select(F.spark_partition_id().alias("p"), "cost").groupBy("p").agg(F.sum("cost").alias("c")).collect()
    assert len(one) == 8 and max(r["c"] for r in one) <= 2 * median([r["c"] for r in one])  # a batch a task
    assert R.in_batches(rows.limit(0), 4).count() == 0
