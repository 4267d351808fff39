"""A batch inference stage that can be stopped and started again.

Requests go to the model in waves of equally expensive batches, one batch a task, and the
answers of a wave are committed to a log together. A run first takes away what the log has
answered: a run that was stopped sends only the rest, and equal requests are sent once. A
request that failed is sent again in a later pass, up to a number of times, without a task
that waits in between; what still fails is the dead-letter part of the result.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from textmill.session import stage_table
from textmill.sources.committed import CommittedTables

ANSWERS = StructType([
    StructField("request_hash", StringType(), False), StructField("version", StringType(), False),
    StructField("response", StringType()), StructField("error", StringType()), StructField("cost", DoubleType()),
])
#: What a request costs besides its length, in characters.
FIXED_COST = 200
#: Cost of a batch beyond which more of them are made than were asked for.
BATCH_COST = 10_000_000


def open_answers(spark: SparkSession, root: str) -> CommittedTables:
    return CommittedTables.open(spark, root, {"answers": ANSWERS})


def in_batches(requests: DataFrame, batches: int, most: float | None = None) -> DataFrame:
    """``requests`` (request_hash, request) with ``cost`` and ``batch``: 0 to ``batches`` - 1, of
    about equal cost; a multiple as many where they would else cost more than ``most`` each.

    The running cost follows the hash, whose first characters deal the requests out into even groups:
    a window runs within a group, and what lies before a group comes from one row for each."""
    rows = requests.withColumn("cost", (F.length("request") + FIXED_COST).cast("double")).withColumn("grp", F.substring("request_hash", 1, 3))
    rows = stage_table(rows, "inference-costs")
    sums = rows.groupBy("grp").agg(F.sum("cost").alias("own")).collect()  # at most 16 ** 3 rows
    total, before, table = sum(r["own"] for r in sums), 0.0, []
    for r in sorted(sums, key=lambda r: r["grp"]):
        table.append((r["grp"], before))
        before += r["own"]
    batches *= max(1, math.ceil(total / batches / most)) if most else 1
    groups = rows.sparkSession.createDataFrame(table, "grp string, before double")
    running = F.sum("cost").over(Window.partitionBy("grp").orderBy("request_hash"))
    placed = rows.join(F.broadcast(groups), "grp").withColumn("middle", F.col("before") + running - F.col("cost") / 2)
    return placed.withColumn("batch", F.least(F.floor(F.col("middle") * batches / max(total, 1.0)), F.lit(batches - 1)).cast("int")).drop("grp", "before", "middle")


def sent(rows: DataFrame, make_model: Callable[[], Callable[[str], str]], batches: int) -> DataFrame:
    """Each batch to the model, in a task of its own; a request that fails has an ``error``."""
    import pandas as pd

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = None
        for f in frames:
            model = model or make_model()
            out = []
            for r in f["request"]:
                try:
                    out.append((model(r), None))
                except Exception as e:  # noqa: BLE001 - isolated per request
                    out.append((None, f"{type(e).__name__}: {e}"))
            response, error = zip(*out) if out else ((), ())
            yield pd.DataFrame({"request_hash": f["request_hash"], "cost": f["cost"], "response": pd.Series(response, f.index, object), "error": pd.Series(error, f.index, object)})

    rows = rows.repartitionById(batches, F.pmod("batch", F.lit(batches))).select("request_hash", "cost", "request")
    return rows.mapInPandas(run, "request_hash string, cost double, response string, error string")


def answer(requests: DataFrame, log: CommittedTables, make_model: Callable[[], Callable[[str], str]], version: str, key: str = "doc_id",
           tasks: int = 8, waves: int = 4, attempts: int = 3, passes: int | None = None, batch_cost: float = BATCH_COST) -> DataFrame:
    """(key, response, error, n_sent) for every row of ``requests`` (key, request): the answer in
    the log, else one of its errors, and how often its request was sent in all runs. A null
    request is never sent and has neither.

    ``waves`` of ``tasks`` batches are sent one after the other, each committed on its own; of more
    batches each, where one would cost more than ``batch_cost``, so that no task grows with the input. An
    answer of another ``version`` does not count. ``passes`` limits what one run sends."""
    hashed = requests.select(key, "request", F.sha2("request", 256).alias("request_hash"))
    hashed = stage_table(hashed, "inference-requests")
    mine = lambda: log.read("answers").where(F.col("version") == version)
    for _ in range(attempts if passes is None else passes):
        past = mine().groupBy("request_hash").agg(F.count("response").alias("n_good"), F.count(F.lit(1)).alias("n_sent"))
        closed = past.where((F.col("n_good") > 0) | (F.col("n_sent") >= attempts)).select("request_hash")
        todo = hashed.where("request IS NOT NULL").select("request_hash", "request").dropDuplicates(["request_hash"]).join(closed, "request_hash", "left_anti")
        todo = stage_table(in_batches(todo, tasks * waves, batch_cost), "inference-todo")
        last = todo.agg(F.max("batch")).first()[0]
        if last is None:
            break
        own_tasks = tasks * (last // (tasks * waves) + 1)
        for w in range(waves):
            own = todo.where(F.floor(F.col("batch") / own_tasks) == w)
            log.write(uuid.uuid4().hex, answers=sent(own, make_model, own_tasks).withColumn("version", F.lit(version)))
    found = mine().groupBy("request_hash").agg(F.max("response").alias("response"), F.max_by("error", "batch").alias("error"), F.count(F.lit(1)).alias("n_sent"))
    out = hashed.select(key, "request_hash").join(found, "request_hash", "left")
    return out.select(key, "response", F.when(F.col("response").isNull(), F.col("error")).alias("error"), F.coalesce("n_sent", F.lit(0)).alias("n_sent"))
