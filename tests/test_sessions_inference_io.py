import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from textmill.operators import inference as L
from textmill.operators import sessions as SS
from textmill.sources import tables as S

from conftest import SF


def turns(spark, rows):
    return spark.createDataFrame(rows, "session_id string, turn int, role string, content string, "
                                       "tool_name string, args string, observation string")


def test_history_expand_counts(spark):
    rows = [("s", 0, "user", "hi", None, None, None), ("s", 1, "model", "yo", None, None, None),
            ("s", 2, "tool", None, "search", None, '{"n": 1}'), ("s", 3, "system", "x", None, None, None),
            ("s", 4, "assistant", "ok", None, None, None)]
    out = SS.history_expand(turns(spark, rows)).orderBy("turn", "part_no").collect()
    assert [(r.turn, r.part_role, r.kind) for r in out] == [
        (0, "user", "text"), (1, "model", "text"), (2, "model", "function_call"),
        (2, "user", "function_response"), (4, "model", "text")]
    call = [r for r in out if r.kind == "function_call"][0]
    assert call.payload == "{}" and call.name == "search"


def test_cache_latest_and_lookup(spark):
    log = spark.createDataFrame([(1, "entities", "a", 1, 1), (1, "entities", "b", 2, 2), (1, "summary", "s", 1, 3),
                                 (2, "entities", "c", 5, 4)],
                                "doc_id bigint, key string, value string, ts long, event_id long")
    latest = SS.cache_latest(log, order=("ts", "event_id"))
    got = {(r.doc_id, r.key): r.value for r in latest.collect()}
    assert got == {(1, "entities"): "b", (1, "summary"): "s", (2, "entities"): "c"}
    req = spark.createDataFrame([(1, "entities"), (3, "entities")], "doc_id bigint, key string")
    res = {(r.doc_id, r.key): (r.value, r.hit) for r in SS.cache_lookup(req, latest).collect()}
    assert res == {(1, "entities"): ("b", True), (3, "entities"): (None, False)}
    m = SS.cache_map(latest).filter("doc_id = 1").first().entries
    assert m == {"entities": "b", "summary": "s"}


def responses(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, response string, error string")


def test_parse_defaults_enum_and_malformed(spark):
    ok = json.dumps({"core_issue": "x", "actors": [{"name": "A", "role": "r"}]})
    bad_enum = json.dumps({"sentiment_label": "unknown"})
    missing = json.dumps({"actors": [{"name": "A"}]})
    rows = [(1, ok, None), (2, bad_enum, None), (3, "{not json", None), (4, None, "TimeoutError"), (5, missing, None)]
    v = L.validate_extractions(L.parse_extractions(responses(spark, rows))).orderBy("doc_id").collect()
    assert v[0].reject_reason is None and v[0].sentiment_label == "neutral" and v[0].key_metrics == []
    assert [r.reject_reason for r in v[1:]] == ["invalid_sentiment_label", "malformed_json", "model_error",
                                               "actor_missing_field"]
    good, dead = L.inference_quarantine(L.validate_extractions(L.parse_extractions(responses(spark, rows))))
    assert good.count() == 1 and dead.count() == 4


def test_model_call_isolates_failures(spark):
    def make():
        def call(req):
            if "boom" in req:
                raise RuntimeError("boom")
            return json.dumps({"core_issue": req[:3]})
        return call
    req = spark.createDataFrame([(1, "abc"), (2, "boom!")], "doc_id bigint, request string")
    out = {r.doc_id: (r.response, r.error) for r in L.model_call(req, make, retries=2, backoff_s=0.0).collect()}
    assert out[1][1] is None and json.loads(out[1][0])["core_issue"] == "abc"
    assert out[2][0] is None and "boom" in out[2][1]


def test_json_roundtrip_and_explode(spark):
    rows = [(1, json.dumps({"actors": [{"name": "A", "role": "x"}, {"name": "B", "role": "y"}]}), None),
            (2, json.dumps({}), None)]
    p = L.parse_extractions(responses(spark, rows)).select("doc_id", "actors", "key_metrics", "dates")
    back = L.from_json_columns(L.to_json_columns(p))
    assert sorted(map(tuple, back.select("doc_id", F.to_json("actors")).collect())) == \
        sorted(map(tuple, p.select("doc_id", F.to_json("actors")).collect()))
    ex = L.explode_actors(p).orderBy("doc_id", "actor_no").collect()
    assert [(r.doc_id, r.name) for r in ex] == [(1, "A"), (1, "B"), (2, None)]


def test_jsonl_round_trip_and_required_fields(spark):
    from textmill import schemas
    d = spark.createDataFrame([(1, "a", "s"), (2, "b", "s")], "doc_id bigint, text string, source string")
    path = os.path.join(tempfile.mkdtemp(prefix="tm-jsonl-"), "out")
    S.write_jsonl(d, path)
    lines = [json.loads(x) for f in os.listdir(path) if f.startswith("part-") for x in open(os.path.join(path, f))]
    assert sorted(x["doc_id"] for x in lines) == [1, 2]
    back = S.read_jsonl(spark, path, d.schema)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, d.collect()))
    bad = spark.createDataFrame([("x", None, None, None, None)],
                                "doc_id string, text string, reference_summary string, source string, ingested_at timestamp")
    with pytest.raises(Exception):
        S.write_table(bad, os.path.join(tempfile.mkdtemp(prefix="tm-req-"), "t"), schemas.DOCUMENTS)


def test_fetch_by_id_keeps_misses(spark):
    d = spark.createDataFrame([(1, "a")], "doc_id bigint, text string")
    ids = spark.createDataFrame([(1,), (1,), (5,)], "doc_id bigint")
    got = sorted((r.doc_id, r.found) for r in S.fetch_by_id(ids, d).collect())
    assert got == [(1, True), (1, True), (5, False)]


def test_entry_and_contract(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and df.columns == ["doc_id", "snippet", "score"]
    from textmill.plans.catalog import QUERIES

    qs, sqls = E.queries(), E.oracle_sql()
    assert set(sqls) <= set(qs)
    assert set(QUERIES) <= set(sqls)


@pytest.mark.parametrize("name", ["clean_documents", "textrank_summary", "rouge_n", "cache_latest"])
def test_queries_run_on_smoke_data(spark, name):
    assert E.queries()[name](spark, SF).count() >= 0


def test_streaming_append_survives_restarts_and_new_checkpoints(spark):
    from textmill import schemas
    from textmill.streaming.append import append_stream, read_appended

    base = tempfile.mkdtemp(prefix="tm-stream-")
    conv = spark.read.parquet(f"{SF}/conversations.parquet")
    rows = SS.turn_rows(conv, F.col("conv_id"), F.timestamp_seconds(F.col("turn")), F.col("role"), F.col("text"))
    out, n = f"{base}/turns", conv.count()

    def append(source, checkpoint):
        stream = spark.readStream.schema(rows.schema).parquet(f"{base}/{source}")
        append_stream(stream, out, schemas.SESSION_TURNS, f"{base}/{checkpoint}", available_now=True).awaitTermination(120)
        return read_appended(spark, out, schemas.SESSION_TURNS).count()

    rows.write.parquet(f"{base}/s1")
    assert append("s1", "c1") == n
    assert append("s1", "c1") == n  # a restart from its checkpoint adds nothing
    rows.limit(7).write.mode("append").parquet(f"{base}/s1")
    assert append("s1", "c1") == n + 7
    rows.limit(5).write.parquet(f"{base}/s2")
    assert append("s2", "c2") == n + 12  # another checkpoint is another query and takes nothing away
    table = read_appended(spark, out, schemas.SESSION_TURNS)
    assert set(table.columns) == {f.name for f in schemas.SESSION_TURNS.fields}


def test_stream_ingest_cleans_and_drops_copies(spark):
    from pyspark.sql.types import _parse_datatype_string

    from textmill.streaming.append import read_appended
    from textmill.streaming.ingest import ingest

    base = tempfile.mkdtemp(prefix="tm-ingest-")
    good = "the cat and the dog sat on the mat and that was it for them " * 12
    raw = spark.createDataFrame([(1, good), (2, good.replace(" cat", "  cat")), (3, "short text"), (4, good + "and more")], "doc_id long, text string")
    raw.write.parquet(f"{base}/in")
    schema = _parse_datatype_string("text string, text_hash string, token_count bigint")
    stream = spark.readStream.schema(raw.schema).parquet(f"{base}/in")
    for _ in range(2):
        ingest(stream, f"{base}/out", schema, f"{base}/ck", F.to_timestamp(F.lit("2024-01-01 00:00:00")), available_now=True).awaitTermination(120)
    got = read_appended(spark, f"{base}/out", schema).collect()
    assert sorted(r.token_count for r in got) == [180, 182]


def test_create_table_never_overwrites(spark):
    from pyspark.sql.types import _parse_datatype_string

    from textmill.sources import tables as S

    base = tempfile.mkdtemp(prefix="tm-create-")
    schema = _parse_datatype_string("a bigint, b string")
    S.write_table(spark.createDataFrame([(1, "x")], schema), f"{base}/t", schema)
    S.create_table_if_absent(spark, f"{base}/t", schema)
    assert spark.read.parquet(f"{base}/t").count() == 1
    with pytest.raises(ValueError):
        S.create_table_if_absent(spark, f"{base}/t", _parse_datatype_string("a bigint, c string"))
    with open(f"{base}/file", "w") as f:
        f.write("not a table")
    with pytest.raises(Exception):  # noqa: B017, PT011 - whatever the reader says
        S.create_table_if_absent(spark, f"{base}/file", schema)
    assert open(f"{base}/file").read() == "not a table"
