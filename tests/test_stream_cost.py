"""What a batch of the stream shuffles: hashes, no texts."""

import tempfile

import pytest
from pyspark.sql import functions as F

from textmill.operators import clean as C
from textmill.sources.committed import CommittedTables
from textmill.streaming import ingest as IN

TABLE = "doc_id long, text string, text_hash string, token_count long, ingested_at timestamp"


def batch(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, text_hash string, token_count long, ingested_at timestamp").withColumn(IN.CORRUPT, F.lit(None).cast("string"))


def rows_of(ids, at="2024-01-01 00:00:00"):
    from datetime import datetime

    return [(i, f"text {i % 5}", f"{i % 5:02x}" + "0" * 62, 2, datetime.fromisoformat(at)) for i in ids]


def test_no_text_is_shuffled_to_find_what_was_taken_before(spark, monkeypatch):
    plans = []
    real = CommittedTables.put

    def put(self, name, table, df):
        if table == "documents":
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return real(self, name, table, df)

    monkeypatch.setattr(CommittedTables, "put", put)
    schema = spark.createDataFrame([], TABLE).schema
    t = IN.open_ingested(spark, tempfile.mkdtemp(prefix="tm-narrow-"), schema)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as where the index is large
    try:
        for name, ids in (("a", [7, 2, 5, 0, 12]), ("b", [1, 2, 3, 6, 5, None]), ("c", [4, 0, 9])):
            assert IN.take_batch(t, batch(spark, rows_of([i for i in ids if i is not None])), name, IN.required("doc_id"), lambda x: x)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sorted((r.batch, r.doc_id) for r in t.read("documents").collect()) == [("a", 0), ("a", 2), ("b", 1), ("b", 3), ("c", 4)]
    assert t.read("seen").count() == 5
    assert len(plans) == 3 and not any("Exchange hashpartitioning" in p for p in plans)


@pytest.mark.parametrize("most", [C.BROADCAST_MAX_ROWS, 0])
def test_known_hashes_are_left_out_of_the_wide_dedupe(spark, monkeypatch, most):
    monkeypatch.setattr(C, "BROADCAST_MAX_ROWS", most)
    hashes = [None, None, "a", "a", "b", "c", "c", "d", "e", "a"]
    df = spark.createDataFrame([(10 - i, h, f"t{h}") for i, h in enumerate(hashes)], "doc_id long, text_hash string, text string")
    known = spark.createDataFrame([("a",), ("b",), ("b",), ("x",), (None,)], "text_hash string")
    out = C.dedupe_numbered(C.number_rows(df), known=known)
    assert out.columns == df.columns
    assert sorted((r.text_hash or "", r.doc_id) for r in out.collect()) == [("", 9), ("c", 4), ("d", 3), ("e", 2)]


def test_folders_of_a_split_table_are_written_by_all_tasks(spark):
    t = CommittedTables.open(spark, tempfile.mkdtemp(prefix="tm-split-"), {"b": spark.createDataFrame([], "y long, k string").schema}, {"b": "k"})
    df = spark.range(400).select(F.col("id").alias("y"), (F.col("id") % 40).cast("string").alias("k"))
    status, sc = spark.sparkContext.statusTracker(), spark.sparkContext
    sc.setJobGroup("split-write", "")
    back = t.put("1", "b", df)
    tasks = [status.getStageInfo(s).numTasks for j in status.getJobIdsForGroup("split-write") for s in status.getJobInfo(j).stageIds]
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert int(spark.conf.get("spark.sql.shuffle.partitions")) in tasks  # others list files or make rows
    assert back.count() == 400 and back.select("k", F.input_file_name()).distinct().count() == 40
