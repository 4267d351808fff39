"""Tables committed together: dead letters, lasting deduplication, entity write-back, narrow dedupe."""

import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from textmill.operators import clean as C
from textmill.operators import entities as EN
from textmill.sources.committed import CommittedTables
from textmill.streaming import ingest as IN

GOOD = "the cat and the dog sat on the mat and that was it for them "


def schema_of(**fields):
    out = StructType()
    for name, kind in fields.items():
        out = out.add(name, kind)
    return out


RECORD = schema_of(doc_id="long", text="string", source="string")
TABLE = schema_of(doc_id="long", text="string", text_hash="string", token_count="long", ingested_at="timestamp")


def text(i):
    return GOOD * 12 + f"number {i}"


def open_two(spark, root):
    return CommittedTables.open(spark, root, {"a": schema_of(x="long"), "b": schema_of(y="string", k="string")}, {"b": "k"})


def test_only_committed_batches_are_read(spark):
    t = open_two(spark, tempfile.mkdtemp(prefix="tm-committed-"))
    assert t.read("a").collect() == [] and not t.has("1")
    assert t.write("1", a=spark.range(3).toDF("x"), b=spark.createDataFrame([("p", "k1"), ("q", "k2")], "y string, k string"))
    t.put("2", "a", spark.range(100).toDF("x"))  # a batch that dies before its commit
    assert t.read("a").count() == 3 and t.read("b").where("k = 'k1'").select("y").collect() == [("p",)]
    assert t.write("2", a=spark.range(5).toDF("x"), b=spark.createDataFrame([], "y string, k string"))
    assert not t.write("2", a=spark.range(50).toDF("x"))  # committed before
    assert t.read("a").groupBy("batch").count().orderBy("batch").collect() == [("1", 3), ("2", 5)]


def test_compaction_changes_no_rows_of_either_table(spark):
    t = open_two(spark, tempfile.mkdtemp(prefix="tm-committed-"))
    for k in range(4):
        t.write(str(k), a=spark.range(k).toDF("x"), b=spark.createDataFrame([(f"v{k}", "k")], "y string, k string"))
    before = sorted(r["y"] for r in t.read("b").collect())
    name = t.compact("b")
    assert sorted(r["y"] for r in t.read("b").collect()) == before and {r["batch"] for r in t.read("b").collect()} == {name}
    assert t.read("a").count() == 6 and t.has("3")
    t.write("4", a=spark.range(1).toDF("x"), b=spark.createDataFrame([("v4", "k")], "y string, k string"))
    t.compact("b")
    assert sorted(r["y"] for r in t.read("b").collect()) == [*before, "v4"] and t.compact("b") is None


def lines(spark, rows):
    return spark.createDataFrame([(r,) for r in rows], "value string")


def as_json(i, body, **more):
    import json

    return json.dumps({"doc_id": i, "text": body, "source": "s", **more})


def test_json_lines_that_are_no_records(spark):
    rows = [as_json(1, "x"), "{", "", "[1]", '"text"', '{"doc_id": "no number", "text": "y"}', '{"doc_id": 2}', None]
    got = IN.json_records(lines(spark, rows), RECORD).collect()
    assert [(r["doc_id"], r["text"], r["_corrupt"] is None) for r in got if r["_corrupt"] is None] == [(1, "x", True), (2, None, True)]
    assert sum(r["_corrupt"] is not None for r in got) == 6


def stream_run(spark, base, rules=None):
    stream = IN.json_records(spark.readStream.text(f"{base}/in"), RECORD)
    IN.ingest_committed(stream, f"{base}/t", TABLE, f"{base}/ck", rules or IN.required("doc_id", "text"), F.to_timestamp(F.lit("2024-01-01 00:00:00")), available_now=True, compact_every=2).awaitTermination(120)
    t = IN.open_ingested(spark, f"{base}/t", TABLE)
    return sorted(r["doc_id"] for r in t.read("documents").collect()), sorted(r["reason"] for r in t.read("dead").collect()), t


def test_stream_keeps_bad_rows_apart_and_drops_duplicates_for_good(spark):
    base = tempfile.mkdtemp(prefix="tm-lasting-")
    lines(spark, [as_json(1, text(1)), as_json(2, text(1)), as_json(3, text(3)), as_json(4, None), "{broken", as_json(5, "too short")]).coalesce(1).write.text(f"{base}/in")
    assert stream_run(spark, base)[:2] == ([1, 3], ["malformed", "null text"])
    assert stream_run(spark, base)[:2] == ([1, 3], ["malformed", "null text"])  # a restart adds nothing
    for wave, rows in enumerate([[as_json(6, text(1)), as_json(7, text(7))], [as_json(8, text(3)), as_json(None, "x")], [as_json(9, text(7)), as_json(10, text(10))]]):
        lines(spark, rows).coalesce(1).write.mode("append").text(f"{base}/in")
        kept, dead, t = stream_run(spark, base)
    assert kept == [1, 3, 7, 10] and dead == ["malformed", "null doc_id", "null text"]
    assert t.read("seen").count() == 4 and any(r["batch"].startswith("compact") for r in t.live("seen").collect())


def test_a_batch_that_fails_between_its_tables_is_taken_once(spark, monkeypatch):
    base = tempfile.mkdtemp(prefix="tm-fails-")
    lines(spark, [as_json(1, text(1)), as_json(2, None)]).coalesce(1).write.text(f"{base}/in")
    real = CommittedTables.commit
    monkeypatch.setattr(CommittedTables, "commit", lambda self, *a, **k: (_ for _ in ()).throw(RuntimeError("lost the driver")))
    with pytest.raises(Exception, match="lost the driver"):
        stream_run(spark, base)
    t = IN.open_ingested(spark, f"{base}/t", TABLE)
    assert t.read("documents").count() == t.read("dead").count() == t.read("seen").count() == 0
    monkeypatch.setattr(CommittedTables, "commit", real)
    assert stream_run(spark, base)[:2] == ([1], ["null text"])
    # committed by us but not yet by Spark: the same batch comes again and is left alone
    batch = IN.json_records(lines(spark, [as_json(1, text(1))]), RECORD)
    name = t.live("documents").first()["batch"]
    assert not IN.take_batch(t, batch, name, IN.required("doc_id"), lambda x: x)
    assert t.read("documents").count() == 1


def entity_setup(spark):
    docs = spark.createDataFrame([(1, "Anna Smith met Bob Jones. It was good."), (2, "nothing here"), (3, "Carl Brown left.")], "doc_id long, text string")
    calls = []

    def compute(rows):
        calls.append(sorted(r["doc_id"] for r in rows.select("doc_id").collect()))
        return EN.extract_entities(rows, extracted_at=F.to_timestamp(F.lit("2024-01-01 00:00:00")))

    return docs, compute, calls, EN.extract_entities(docs.limit(0), extracted_at=F.current_timestamp()).schema


def sources(out):
    return sorted((r["doc_id"], r["entity_name"] or "", r["source"]) for r in out.collect())


def test_entities_are_computed_once_for_each_version(spark):
    docs, compute, calls, schema = entity_setup(spark)
    store = EN.entity_store(spark, tempfile.mkdtemp(prefix="tm-ents-"), schema)
    ids = spark.createDataFrame([(1,), (1,), (2,), (9,), (None,)], "doc_id long")
    first = EN.entities_write_back(ids, store, docs, compute, "v1")
    want = [(1, "Anna Smith", "computed"), (1, "Bob Jones", "computed"), (9, "", "not_found")]
    assert sources(first) == want and calls == [[1, 2]]
    second = EN.entities_write_back(ids, store, docs, compute, "v1")
    assert sources(second) == [(a, b, c.replace("computed", "cache")) for a, b, c in want]
    assert calls == [[1, 2]]  # document 2 has no entities and is not worked on again either
    more = spark.createDataFrame([(1,), (3,)], "doc_id long")
    assert sources(EN.entities_write_back(more, store, docs, compute, "v1")) == [(1, "Anna Smith", "cache"), (1, "Bob Jones", "cache"), (3, "Carl Brown", "computed")]
    assert calls[1:] == [[3]]
    assert {s for *_, s in sources(EN.entities_write_back(more, store, docs, compute, "v2"))} == {"computed"}


def test_a_failed_write_back_leaves_nothing(spark, monkeypatch):
    docs, compute, calls, schema = entity_setup(spark)
    store = EN.entity_store(spark, tempfile.mkdtemp(prefix="tm-ents-"), schema)
    ids = docs.select("doc_id")
    real = CommittedTables.commit
    monkeypatch.setattr(CommittedTables, "commit", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        EN.entities_write_back(ids, store, docs, compute, "v1")
    monkeypatch.setattr(CommittedTables, "commit", real)
    assert {s for *_, s in sources(EN.entities_write_back(ids, store, docs, compute, "v1"))} == {"computed"}
    assert {s for *_, s in sources(EN.entities_write_back(ids, store, docs, compute, "v1"))} == {"cache"}
    assert len(calls) == 2


def test_two_writers_of_one_document_count_once(spark):
    docs, compute, _, schema = entity_setup(spark)
    store = EN.entity_store(spark, tempfile.mkdtemp(prefix="tm-ents-"), schema)
    tag = F.lit("v1").alias("version")
    for name in ("x", "y"):
        store.write(name, entities=compute(docs).withColumn("version", tag), done=docs.select("doc_id", tag))
    assert sources(EN.entities_write_back(docs.select("doc_id"), store, docs, compute, "v1")) == [(1, "Anna Smith", "cache"), (1, "Bob Jones", "cache"), (3, "Carl Brown", "cache")]


@pytest.mark.parametrize("most", [10**6, 0])
def test_wide_dedupe_equals_the_plain_one(spark, monkeypatch, most):
    monkeypatch.setattr(C, "BROADCAST_MAX_ROWS", most)
    rows = [(i, f"h{i % 700 if i % 3 else i}", f"text {i}") for i in range(3000)] + [(5, "h5", "text 5"), (None, "h5", "none"), (8, None, "a"), (9, None, "b")]
    df = spark.createDataFrame(rows, "doc_id long, text_hash string, text string").repartition(4)
    want = sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["text_hash"] or "") for r in C.dedupe_exact(df).collect())
    out = C.dedupe_texts(df)
    assert sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["text_hash"] or "") for r in out.collect()) == want
    plan = out._jdf.queryExecution().toString()
    assert out.columns == df.columns and ("BroadcastHashJoin" in plan or most == 0)


def test_filter_of_hashes_misses_none(spark):
    keys = spark.range(5000).select(F.sha2(F.col("id").cast("string"), 256).alias("h"))
    maps, size = C.hash_filter(keys, "h", 5000)
    marked = C.may_hold(spark.range(40000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("h")), "h", maps, size)
    held, wrong = marked.select(F.expr("count_if(id < 5000 AND _may)"), F.expr("count_if(id >= 5000 AND _may)")).first()
    assert held == 5000 and wrong < 0.1 * 35000


def test_a_cache_in_parts_equals_the_whole_log(spark):
    from textmill.operators import sessions as SS

    rows = [(i % 7, f"k{i % 3}", f"v{i}" if i % 5 else None, (i * 37) % 211, i) for i in range(200)]
    log = spark.createDataFrame(rows, "doc_id long, key string, value string, ts long, event_id long")
    order = ("ts", "event_id")
    cache = SS.open_cache(spark, tempfile.mkdtemp(prefix="tm-cache-"), log, order=order)
    assert SS.cache_now(cache).count() == 0
    for k in (3, 0, 2, 1):  # what is written last is not what counts
        assert SS.add_to_cache(cache, log.where(f"event_id % 4 = {k}"), f"p{k}", compact_every=3)
        assert not SS.add_to_cache(cache, log.where(f"event_id % 4 = {k}"), f"p{k}", compact_every=3)
    want = sorted(map(tuple, SS.cache_latest(log, order=order).collect()), key=str)
    assert sorted(map(tuple, SS.cache_now(cache).collect()), key=str) == want
    assert cache.live("state").count() == 2  # three parts became one
    assert cache.read("state").count() <= 2 * 21
    late = spark.createDataFrame([(0, "k0", "late", 5, 999)], log.schema)  # older than what is there
    SS.add_to_cache(cache, late, "late")
    got = {(r["doc_id"], r["key"]): r for r in SS.cache_now(cache).collect()}
    old = {(r[0], r[1]): r for r in want}
    assert got[0, "k0"]["value"] == old[0, "k0"][2] and got[0, "k0"]["n_writes"] == old[0, "k0"][3] + 1
