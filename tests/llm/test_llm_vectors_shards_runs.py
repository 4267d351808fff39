"""Whitening, sharding and periodic runs against brute force, with nulls, ties, repeats and clashing columns."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from textmill.llm import queries, runs, shards, whiten

WORD = re.compile("[^\x20\x09-\x0d]+")
SF = "/root/testdata/sf0.001"
VEC = "vec_id long, embedding array<float>, label int"
DOC = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], DOC).repartition(3)


# whitening


@pytest.mark.parametrize("low,high,shape", [(0, 3, (5, 3)), (999_000, 1_001_000, (200, 9)), (-(1 << 50), 1 << 50, (70, 4)), (7, 8, (64, 2))])
def test_bit_planes_give_exact_cross_products(low, high, shape):
    x = np.random.default_rng(1).integers(low, high, shape)
    n, sums, cross = whiten.scatter(x)
    y = x.astype(object)
    assert (n, sums) == (shape[0], [int(v) for v in y.sum(axis=0)])
    assert all(cross[j][k] == sum(y[:, j] * y[:, k]) for j in range(shape[1]) for k in range(j, shape[1]))


def brute_whitening(rows):
    x = {i: [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)}
    fit = sorted(set(map(tuple, x.values())))
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    m = np.array(fit, float) - np.array(sums, float) / n
    return n, sums, x, np.linalg.eigvalsh(m.T @ m / n)[::-1], np.linalg.eigh(m.T @ m / n)[1][:, ::-1], m


def vectors():
    r = np.random.default_rng(2)
    rows = [(i, [float(v) for v in r.normal(0, 1, 20) * np.arange(1, 21)]) for i in range(300)]
    rows += [(1000 + i, rows[0][1]) for i in range(50)]
    rows += [(2000, None), (2001, [None] + [0.0] * 19), (2002, [float("nan")] + [0.0] * 19), (2003, [float("inf")] + [0.0] * 19), (2004, []), (5, rows[5][1]), (None, rows[6][1])]
    return rows


def test_whitening_equals_brute_force(spark):
    rows = vectors()
    table = spark.createDataFrame([(i, v, None) for i, v in rows], VEC).repartition(3)
    for c in ("x", "key", "deviation", "component", "n", "white", "at"):
        table = table.withColumn(c, F.lit("7"))
    model = whiten.fit(table)
    out = whiten.transform(table, model).collect()
    n, sums, x, values, axes, m = brute_whitening([r for r in rows if r[0] is not None])
    assert {r["n"] for r in out} == {n} and n == 300
    assert Counter(r["vec_id"] for r in out) == Counter({i: 16 for i in x} | {5: 32, None: 16})
    assert np.allclose(model.values, values[:16], rtol=1e-10)
    white = defaultdict(dict)
    for r in out:
        if r["vec_id"] is not None:
            white[r["vec_id"]][r["component"]] = r["whitened"]
            assert int(r["deviation"]) == sum((n * c - s) ** 2 for c, s in zip(x[r["vec_id"]], sums))
            assert abs(r["explained"] - values[r["component"] - 1] / values.sum()) < 1e-9
            assert 0 <= r["identity_error"] < 1e-9
    for k in range(16):
        want = (np.array([x[i] for i in white], float) - np.array(sums, float) / n) @ axes[:, k] / np.sqrt(values[k])
        got = np.array([white[i][k + 1] for i in white])
        assert min(np.abs(got - want).max(), np.abs(got + want).max()) < 1e-7
    distinct = {tuple(x[i]): [white[i][k + 1] for k in range(16)] for i in white}
    cov = np.cov(np.array(list(distinct.values())).T, bias=True)
    assert np.abs(cov - np.eye(16)).max() < 1e-9


def test_whitening_of_small_and_odd_tables(spark):
    empty = spark.createDataFrame([], VEC)
    assert whiten.transform(empty, whiten.fit(empty)).collect() == []
    same = spark.createDataFrame([(1, [1.0, 2.0], 1), (2, [1.0, 2.0], 1)], VEC)
    assert whiten.transform(same, whiten.fit(same)).collect() == []
    line = spark.createDataFrame([(i, [float(i), 2.0 * i, 5.0], 1) for i in range(9)], VEC)  # one direction with variance
    out = whiten.transform(line, whiten.fit(line)).collect()
    assert len(out) == 9 and {r["component"] for r in out} == {1} and abs(out[0]["explained"] - 1) < 1e-9
    with pytest.raises(ValueError, match="several lengths"):
        whiten.fit(spark.createDataFrame([(1, [1.0], 1), (2, [1.0, 2.0], 1)], VEC))


def test_whitening_beyond_64_bits(spark):
    far = spark.createDataFrame([(i, [float(i) * 2.0**40, float(i * i) * 2.0**40], 1) for i in range(50)], VEC)
    out = whiten.transform(far, whiten.fit(far)).collect()
    rows = [(i, [float(i) * 2.0**40, float(i * i) * 2.0**40]) for i in range(50)]
    n, sums, x, *_ = brute_whitening(rows)
    assert all(int(r["deviation"]) == sum((n * c - s) ** 2 for c, s in zip(x[r["vec_id"]], sums)) for r in out)


def test_whitening_query(spark):
    out = queries.op11_embedding_whitening(spark, SF)
    assert dict(out.dtypes) == {"vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double", "explained": "double", "identity_error": "double"}
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    n, sums, x, values, _, _ = brute_whitening(rows)
    got = out.collect()
    assert len(got) == 16 * len(x) and {r["n"] for r in got} == {n}
    assert all(r["deviation"] == sum((n * c - s) ** 2 for c, s in zip(x[r["vec_id"]], sums)) for r in got)
    assert max(abs(r["explained"] - values[r["component"] - 1] / values.sum()) for r in got) < 1e-9
    assert {r["identity_error"] for r in got}.pop() < 1e-9


# sharding


def texts():
    r = random.Random(5)
    rows = [(i, " ".join(r.choice("abcdefgh") * r.randint(1, 9) for _ in range(r.randint(0, 60)))) for i in range(700)]
    rows += [(1000 + i, "copied often " * 8) for i in range(400)]  # of many bytes and rows
    rows += [(2000 + i, None) for i in range(600)] + [(3000 + i, "") for i in range(300)]  # of many rows
    rows += [(4000, "long " * 2000), (4001, "é" * 500), (None, "no id"), (3, "twice"), (3, "twice")]
    return rows


def brute_shards(rows, n_shards):
    """rows: (doc_id, size, a, b). Exactly what the sampled ranges should come to."""
    total, n = sum(r[1] for r in rows), len(rows)
    groups = defaultdict(list)
    for r in rows:
        groups[r[2]].append(r)
    size = {a: sum(r[1] for r in g) for a, g in groups.items()}
    heavy = {a: size[a] for a, g in groups.items() if size[a] > total / n_shards * shards.HEAVY or len(g) > n / n_shards * shards.HEAVY}
    lines = shards.lines_for(heavy, total, n_shards)
    out, done = {}, 0
    for a in sorted(groups):
        line, at = lines[a if a in heavy else None], 0
        for r in sorted(groups[a], key=lambda r: r[3]):
            middle = at + r[1] / 2 if a in heavy else done + size[a] / 2
            out[r[2:]] = next((s for upto, s in line if middle < upto), line[-1][1])
            at += r[1]
        done += 0 if a in heavy else size[a]
    return out


@pytest.mark.parametrize("n_shards", [1, 3, 8])
def test_sharding_equals_brute_force(spark, monkeypatch, n_shards):
    monkeypatch.setattr(shards, "FEW_ROWS", 20)
    seen = {}

    def keyed(rows, keep=(), real=shards.keyed):
        seen["rows"] = real(rows, keep)
        return seen["rows"]

    monkeypatch.setattr(shards, "keyed", keyed)
    table = docs(spark, texts())
    for c in ("a", "b", "part", "size", "shard", "slot", "upto", "rn", "cuts", "kept", "offset"):
        table = table.withColumn(c, F.lit(7))
    got = shards.assign(table, n_shards, keep=("doc_id", "text", "a")).collect()
    keys = [(r["doc_id"], r["size"], r["a"], r["b"]) for r in seen["rows"].collect()]
    want = brute_shards(keys, n_shards)
    place = {}
    for i, *_, a, b in keys:
        place.setdefault(i, []).append(want[a, b])
    assert Counter((r["doc_id"], r["shard"]) for r in got) == Counter((i, s) for i, many in place.items() for s in many)
    assert Counter((r["doc_id"], r["kept"]["text"]) for r in got) == Counter(texts()) and {r["kept"]["a"] for r in got} == {7}
    for s in range(n_shards):
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(sum(r["shard"] == s for r in got)))
    sizes = Counter()
    for r in got:
        sizes[r["shard"]] += r["size"]
        assert r["size"] == len((r["kept"]["text"] or "").encode()) + 1 and r["text_crc32"] == zlib.crc32((r["kept"]["text"] or "").encode())
    goal = sum(sizes.values()) / n_shards
    # a text of 10,001 bytes may be a fifth of a shard, so that is how far a small table can be off
    assert max(abs(sizes[s] - goal) for s in range(n_shards)) <= max(0.01 * goal, 120)


def test_sharding_keeps_equal_texts_together_where_there_is_room(spark):
    rows = [(i, f"text number {i} " * 5) for i in range(900)] + [(1000 + 9 * i + k, f"same {i} " * 6) for i in range(50) for k in range(9)]
    got = shards.assign(docs(spark, rows), 8).collect()
    by_text = defaultdict(set)
    for r in got:
        by_text[r["text_crc32"]].add(r["shard"])
    assert all(len(s) == 1 for s in by_text.values())
    sizes = Counter()
    for r in got:
        sizes[r["shard"]] += r["size"]
    assert max(sizes.values()) - min(sizes.values()) < 0.02 * sum(sizes.values()) / 8


def test_sharding_of_small_tables(spark):
    assert shards.assign(docs(spark, []), 8).collect() == []
    got = shards.assign(docs(spark, [(1, "a"), (2, None)]), 8).collect()
    assert len(got) == 2 and all(r["slot"] == 0 and 0 <= r["shard"] < 8 for r in got)
    assert shards.quantiles([(k, 0, 1) for k in range(8)], 4) == [(2, 0), (4, 0), (6, 0)]


def test_sharding_subdivides_a_text_that_overfills_its_range(spark, monkeypatch):
    monkeypatch.setattr(shards, "FEW_ROWS", 20)
    seen = []
    real = shards.subdivided
    monkeypatch.setattr(shards, "subdivided", lambda *a: seen.append(real(*a)) or seen[-1])
    got = shards.assign(docs(spark, [(i, "one text") for i in range(3000)] + [(5000 + i, f"t{i}") for i in range(200)]), 4).collect()
    assert max(m for _, m, _ in seen[0][1]) <= max(20, 4 * 3200 / shards.RANGES) * 2
    sizes = Counter()
    for r in got:
        sizes[r["shard"]] += r["size"]
    assert max(sizes.values()) - min(sizes.values()) <= 30


def test_shards_as_files(spark, tmp_path):
    rows = texts()
    table = docs(spark, rows).withColumn("shard", F.lit("x"))
    shards.write(table, str(tmp_path / "out"), 4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert Counter((r["doc_id"], r["text"]) for r in back.select(table.columns).collect()) == Counter(rows)
    assert {r["shard_"] for r in back.select("shard_").distinct().collect()} == {0, 1, 2, 3}


def test_sharding_query(spark):
    out = queries.op12_sharding(spark, SF)
    assert out.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    got = out.collect()
    want = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert len(got) == len(want) and all(r["size"] == len((want[r["doc_id"]] or "").encode()) + 1 for r in got)
    sizes = Counter()
    for r in got:
        sizes[r["shard"]] += r["size"]
    assert max(sizes.values()) - min(sizes.values()) <= max(r["size"] for r in got)


# periodic runs


def brute_runs(w):
    best = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            s = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            if i + q - s >= max(12, 2 * q) and i > s:
                best.setdefault((s, i + q), q)
            i += i == s
    return sorted((s, e - s, q) for (s, e), q in best.items())


def collapse(w, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def worded():
    r = random.Random(7)
    out = [None, "", " \n\t", "one", "a " * 11, "a " * 12, "a b\n" * 6, "a b c " * 4 + "a", "é ü " * 9, "A a " * 20 + "a A " * 20]
    a, b = ["0"], ["0", "1"]
    while len(b) < 200:
        a, b = b, b + a
    out.append(" ".join(b))
    for _ in range(250):
        vocabulary = r.choice([1, 2, 3, 5, 50])
        w = [str(r.randrange(vocabulary)) for _ in range(r.choice([5, 13, 30, 100, 200]))]
        if r.random() < 0.5:
            w = w[: r.randint(0, len(w))] + w[: r.randint(1, 20)] * r.randint(1, 12) + w[r.randint(0, len(w)) :]
            w += w[: r.randint(0, len(w))] * 2
        out.append(r.choice([" ", "\n", " \t "]).join(w))
    return out


def test_runs_equal_brute_force(spark):
    rows = [(i, t) for i, t in enumerate(worded())] + [(None, "x y " * 8), (3, "x y " * 8), (3, "x y " * 8)]
    table = docs(spark, rows)
    for c in ("runs", "n_words", "collapsed", "start", "w"):
        table = table.withColumn(c, F.lit(7))
    got = Counter((r["doc_id"], r["n_words"], tuple(map(tuple, r["runs"])), r["collapsed"]) for r in runs.detect(table).collect())
    want = Counter()
    for i, t in rows:
        w = WORD.findall(t or "")
        found = brute_runs(w)
        want[i, len(w), tuple(found), collapse(w, found)] += 1
    assert got == want
    assert runs.detect(docs(spark, [])).collect() == []


def test_grammar_stands_for_the_text():
    r = random.Random(9)
    w = np.array([r.randrange(4) for _ in range(500)] + [9, 8, 7] * 60, np.int64)
    g = runs.repair(w, np.zeros(len(w), np.int64))
    assert len(g.rest) < len(w) // 3 and len(g.rule) >= 2 * len(g.first)  # every symbol is used twice at least
    for k, at in zip(g.rule, g.at):  # and stands for the same words wherever it is used
        size = g.last[k] - g.first[k]
        assert (w[at : at + size] == w[g.first[k] : g.last[k]]).all() and g.first[k] < g.middle[k] < g.last[k]
    assert len(runs.repair(np.zeros(4096, np.int64), np.zeros(4096, np.int64)).first) == 11  # doubles until two are left


def test_runs_of_a_very_long_text(spark):
    r = random.Random(11)
    w = [str(r.randrange(300)) for _ in range(150_000)]
    w[40_000:40_000] = w[10_000:22_000] * 2
    got = runs.detect(docs(spark, [(1, " ".join(w)), (2, "z " * 200_000)])).orderBy("doc_id").collect()
    want = [tuple(x) for x in got[0]["runs"] if x["period"] == 12_000]
    assert len(want) == 1 and want[0][1] >= 24_000 and want[0][0] <= 40_000
    assert [tuple(x) for x in got[1]["runs"]] == [(0, 200_000, 1)] and got[1]["collapsed"] == "z"


def test_runs_query(spark):
    got = {r["doc_id"]: r for r in queries.op13_periodic_runs(spark, SF).collect()}
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert got.keys() == texts.keys()
    for i, t in texts.items():
        w, h = WORD.findall(t or ""), zlib.crc32(str(i).encode())
        if h % 10 == 0 and w:
            g = h // 10
            a = g % len(w)
            p = 1 + (len(w) - a) // (3 + g % 8)
            w = [x if k < a else w[a + (k - a) % p] for k, x in enumerate(w)]
        if len(w) > 1500:
            continue  # the slow check of long texts is test_runs_equal_brute_force's matter
        found, r = brute_runs(w), got[i]
        top = max(found, key=lambda x: (x[1], -x[0], -x[2])) if found else None
        assert (r["n_runs"], r["start"], r["length"], r["period"]) == (len(found), *(top or (None,) * 3))
        assert r["exponent_milli"] == (1000 * top[1] // top[2] if top else None)
        assert r["runs_sha256"] == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in found).encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(collapse(w, found).encode()).hexdigest()
