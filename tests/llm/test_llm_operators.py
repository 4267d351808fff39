"""Operators on small tables against brute force, with nulls, ties, repeats and clashing columns."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from textmill.llm import base, components, grades, jaccard, langid, licenses, lines, mix, neighbours, pack, queries, tokens, toxicity

DOC = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile("[^\x20\x09-\x0d]+")
SF = "/root/testdata/sf0.001"


def docs(spark, rows):
    return spark.createDataFrame(rows, DOC).repartition(3)


ODD = [
    (1, None, None, None, None), (2, "", "en", "s1", 0), (3, "a b", "en", None, 3), (3, "a b", "en", None, 3), (None, "c d e", None, "s1", 1),
    (4, "word " * 5000, "en", "s2", 1), (5, "   \n", None, "s2", 4), (6, "12 34 !!", "en", "s3", 8),
]


def extra(df):
    """Columns whose names the operators use inside."""
    for c in ("score", "size", "target", "point", "node", "length", "row", "host", "line", "k", "rank", "copies", "kept"):
        df = df.withColumn(c, F.lit(7))
    return df


def near_copies():
    r = random.Random(3)
    vocabulary = [f"w{i}" for i in range(400)]
    rows, first = [], [r.choice(vocabulary) for _ in range(80)]
    for i in range(90):
        w = list(first)
        for _ in range(r.randint(0, 6)):
            w[r.randrange(len(w))] = r.choice(vocabulary)
        rows.append((i * 3 + 1, " ".join(w)))
    for i in range(40):
        rows.append((1000 + i, " ".join(first[:40] + [r.choice(vocabulary) for _ in range(r.randint(0, 30))])))
    rows += [(5000, None), (5001, ""), (5002, "a b"), (5003, "A b"), (None, "a b"), (5003, "A b"), (7, " ".join(first)), (5004, "x y z u v w " * 5)]
    return [(i, t, "en", "s", 0) for i, t in rows]


def brute_jaccard(rows):
    sets = []
    for _, t in rows:
        w = WORD.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    up = list(range(len(rows)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            common = len(a & sets[j])
            if common and 100 * common >= 75 * (len(a) + len(sets[j]) - common):
                up[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return [(d, len(s), least.get(find(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))]


@pytest.mark.parametrize("leaf,pivots", [(256, 16), (8, 3)])
def test_jaccard_join_equals_brute_force(spark, monkeypatch, leaf, pivots):
    monkeypatch.setattr(jaccard, "LEAF", leaf)
    monkeypatch.setattr(jaccard, "PIVOTS", pivots)
    rows = near_copies()
    got = [tuple(r) for r in jaccard.join(extra(docs(spark, rows))).collect()]
    assert sorted(got, key=str) == sorted(brute_jaccard([r[:2] for r in rows]), key=str)


def test_jaccard_representatives(spark):
    rows = near_copies() + [(6000, "b c d", "x", "s", 0), (6000, "z y x", "x", "s", 0)]
    exp = brute_jaccard([r[:2] for r in rows])
    out = jaccard.representatives(docs(spark, rows))
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    got = [r["doc_id"] for r in out.collect()]
    linked = {e[2] for e in exp if e[1]} | {6000}
    empty = [e[0] for e in exp if not e[1]]
    # two texts that share an id but no link are groups of their own
    assert sorted(got) == sorted([*linked, 6000, *empty])
    assert jaccard.representatives(docs(spark, rows).limit(0)).count() == 0


def test_components(spark):
    r = random.Random(1)
    edges = [(r.randrange(1 << 60), 0) for _ in range(0)]
    names = r.sample(range(1 << 60), 60)
    edges += [(names[i], names[i + 1]) for i in range(30)] + [(names[40], names[k]) for k in range(41, 60)] + [(names[3], names[3])]
    got = {x["node"]: x["root"] for x in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert len({got[n] for n in names[:31]}) == 1 and len({got[n] for n in names[40:]}) == 1 and len(set(got.values())) == 2
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0


def brute_vectors(rows, threshold=0.93):
    by = {}
    for i, (_, e, g) in enumerate(rows):
        if g is not None and e and all(x is not None and np.isfinite(x) for x in e) and any(e):
            by.setdefault((g, len(e)), []).append(i)
    up, n = list(range(len(rows))), [0] * len(rows)

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for ids in by.values():
        x = np.array([rows[i][1] for i in ids], float)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        s = x @ x.T >= threshold
        np.fill_diagonal(s, False)
        for a, i in enumerate(ids):
            n[i] = int(s[a].sum())
        for a, b in zip(*np.nonzero(s)):
            up[find(ids[a])] = find(ids[b])
    least = {}
    for i, r in enumerate(rows):
        least[find(i)] = min(least.get(find(i), r[0]), r[0])
    return sorted((r[0], n[i], least[find(i)], r[0] == least[find(i)]) for i, r in enumerate(rows))


def test_neighbours_equal_brute_force(spark):
    rng = np.random.default_rng(0)
    centre = rng.normal(size=16)
    rows = [(i, (centre + 0.15 * rng.normal(size=16)).astype(np.float32).tolist(), 1) for i in range(120)]
    rows += [(200 + i, rng.normal(size=16).astype(np.float32).tolist(), i % 2) for i in range(150)]
    rows += [(400 + i, rows[5][1], 1) for i in range(30)] + [(500, rows[5][1], None), (501, None, 1), (502, [0.0] * 16, 1), (503, [float("nan")] * 16, 1), (504, [1.0, None], 1), (505, [], 0), (506, [1.0, 2.0], 1), (507, [2.0, 4.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("node", F.lit(1)).repartition(3)
    got = sorted(tuple(r) for r in neighbours.near_duplicates(df).collect())
    assert got == brute_vectors(rows)


def around(rng, centre, inside, n):
    """``n`` vectors near ``centre`` whose cosines with each other are about ``inside``."""
    return (centre + rng.normal(size=(n, len(centre))) * np.sqrt((1 / inside - 1) / len(centre))).tolist()


def turned(rng, centre, cosine):
    """A unit vector with this cosine to ``centre``."""
    other = rng.normal(size=len(centre))
    other -= other @ centre * centre
    return cosine * centre + np.sqrt(1 - cosine**2) * other / np.linalg.norm(other)


def unit(rng, size=64):
    x = rng.normal(size=size)
    return x / np.linalg.norm(x)


def assert_neighbours(spark, vectors, labels=None):
    rows = [(i * 7 % 20011, list(map(float, x)), labels[i] if labels else 1) for i, x in enumerate(vectors)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(3)
    exp = brute_vectors(rows)
    assert sorted(tuple(r) for r in neighbours.near_duplicates(df).collect()) == exp
    return exp


def test_neighbours_link_dense_groups_with_each_other(spark):
    rng = np.random.default_rng(11)
    first = unit(rng)
    second = turned(rng, first, 0.95)
    exp = assert_neighbours(spark, around(rng, first, 0.99, 100) + around(rng, second, 0.99, 100))
    assert len({r[2] for r in exp}) == 1 and min(r[1] for r in exp) > 100


def test_neighbours_of_a_middling_group(spark):
    rng = np.random.default_rng(12)
    # most vectors have a label of their own
    vectors, labels = around(rng, unit(rng, 16), 0.97, 35), [0] * 35
    vectors += [unit(rng, 16) for _ in range(12000)]
    labels += range(1, 12001)
    exp = assert_neighbours(spark, vectors, labels)
    assert Counter(r[1] for r in exp) == {34: 35, 0: 12000}


def test_neighbours_finds_rare_pairs(spark):
    rng = np.random.default_rng(13)
    vectors = [unit(rng) for _ in range(6000)]
    vectors += [turned(rng, x, 0.931) for x in vectors[:12]]
    exp = assert_neighbours(spark, vectors)
    assert sum(r[1] for r in exp) == 24


def test_neighbours_in_blocks_without_a_near_pair(spark, monkeypatch):
    # blocks of 8 vectors, most pairs of which hold no two that are near each other
    monkeypatch.setattr(neighbours, "BLOCK_BYTES", 8 * 64 * 8)
    rng = np.random.default_rng(14)
    vectors = [unit(rng) for _ in range(120)]
    vectors += [turned(rng, x, 0.95) for x in vectors[:10]] + around(rng, unit(rng), 0.97, 30)
    exp = assert_neighbours(spark, vectors)
    assert sum(r[1] for r in exp) == 20 + 30 * 29


def test_neighbours_of_an_empty_table(spark):
    assert neighbours.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


def test_mix_targets_stop_at_the_limit(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 100), (None, 90), ("e", 0)], "source string, size long")
    got = {r["source"]: r["target"] for r in mix.targets(sizes).collect()}
    # a, b, c, e, null weigh 5, 2, 1, 5, 2; a and e stop first, then null and c
    assert got["a"] == 30 and got["e"] == 0 and got[None] == 270
    assert sum(got.values()) == pytest.approx(1200) and all(got[s] <= 3 * n for s, n in (("b", 1000), ("c", 100)))


def test_mix_takes_near_its_targets_and_reruns_agree(spark):
    r = random.Random(2)
    rows = ODD + [(100 + i, " ".join(["w"] * r.randint(1, 60)), "en", f"s{i % 4}", 0) for i in range(800)]
    df = extra(docs(spark, rows))
    a, b = ({(x["doc_id"], x["source"], x["size"]): x for x in mix.plan(df).collect()} for _ in range(2))
    assert {k: v["taken"] for k, v in a.items()} == {k: v["taken"] for k, v in b.items()}
    by, target = Counter(), {}
    for x in mix.plan(df).collect():
        assert x["taken"] == x["copies"] * x["size"] <= 3 * x["size"]
        by[x["source"]] += x["taken"]
        target[x["source"]] = x["target"]
    big = [s for s in target if target[s] > 1000 and s != "s2"]
    assert big and all(abs(by[s] - target[s]) < 0.05 * target[s] for s in big)
    out = mix.mix(df)
    assert out.columns == df.columns
    assert out.count() == sum(x["copies"] for x in mix.plan(df).collect())
    assert mix.plan(df.limit(0)).count() == 0 and mix.mix(df.limit(0)).count() == 0


def test_token_counts_of_a_table(spark):
    P = pytest.importorskip("public_tokenizers")
    path = P.path("byte_bpe_50k.json")
    tok = tokens.load(path)
    got = sorted((tuple(r) for r in tokens.count(extra(docs(spark, ODD)), path, chunk=700, overlap=20).collect()), key=str)
    assert got == sorted(((r[0], len((r[1] or "").encode()), len(tok.encode(r[1] or "", add_special_tokens=False))) for r in ODD), key=str)


def test_packing_a_table(spark):
    P = pytest.importorskip("public_tokenizers")
    import zlib

    path = P.path("word_bpe_49k.json")
    r = random.Random(4)
    rows = ODD + [(100 + i, " ".join(r.choice(["the", "of", "word", "extraordinary"]) for _ in range(r.randint(0, 60))), "en", "s", 0) for i in range(300)]
    tok = pack.load(path)
    exp = Counter()
    for row in rows:
        ids = np.array([*tok.encode(row[1] or "", add_special_tokens=False).ids, 0], "<u4")
        for k, at in enumerate(range(0, len(ids), 128)):
            own = ids[at : at + 128]
            exp[row[0], k, at, len(own), zlib.crc32(own.tobytes())] += 1
    got = pack.pack(extra(docs(spark, rows)), path, capacity=128).collect()
    assert Counter(tuple(x)[:5] for x in got) == exp
    by = {}
    for x in got:
        by.setdefault(x["sequence_id"], []).append((x["offset"], x["length"]))
    for own in by.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 128
    assert len(by) <= 1.02 * -(-sum(x["length"] for x in got) // 128) + 1
    assert pack.pack(docs(spark, rows).limit(0), path).count() == 0


def test_language_of_a_table(spark):
    base_docs = base.documents(spark, SF)
    model = langid.fit(base_docs)
    got = {(r["doc_id"]): r for r in langid.identify(extra(docs(spark, ODD)), model).collect()}
    assert [got[i]["lang_pred"] for i in (1, 2, 5, 6)] == ["und"] * 4 and got[6]["rejected"] and got[4]["lang_pred"] in model.languages
    assert langid.identify(docs(spark, ODD).limit(0), model).count() == 0
    rows = langid.identify(base_docs, model, keep=("doc_id", "lang")).where(base.held_out("doc_id")).collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.9 * len(rows)
    assert sum(r["rejected"] for r in rows) <= 0.02 * len(rows)


def test_rare_languages_are_learned(spark):
    r = random.Random(6)
    word = {"aa": "abcd", "bb": "mnop", "cc": "wxyz"}
    text = lambda lang: " ".join("".join(r.choice(word[lang]) for _ in range(4)) for _ in range(30))
    langs = ["aa"] * 900 + ["bb"] * 90 + ["cc"] * 4
    df = docs(spark, [(i, text(k), k, "s", 0) for i, k in enumerate(langs)])
    model = langid.fit(df, max_docs=30)
    assert model.languages == ["aa", "bb", "cc"]
    assert "cc" in langid.fit(df, max_docs=30, max_bytes=300).languages
    assert langid.shares({"a": 100, "b": 2, "c": 50}, 60) == {"b": 2, "c": 29, "a": 29}


def test_toxicity_of_a_table(spark):
    d, labels = base.documents(spark, "/root/testdata/sf0.01"), base.documents(spark, "/root/testdata/sf0.01", "labels")
    model = toxicity.fit(d, labels)
    got = toxicity.score(extra(docs(spark, ODD)), model).collect()
    assert len(got) == len(ODD) and all(0 <= r["score"] <= 1 for r in got)
    assert toxicity.score(docs(spark, ODD).limit(0), model).count() == 0
    rows = toxicity.score(d, model).join(labels, "doc_id").where(base.held_out("doc_id")).collect()
    assert sum(r["predicted"] == r["toxic"] for r in rows) >= 0.9 * len(rows)
    assert toxicity.score(d, toxicity.fit(d, labels.limit(0))).where("predicted = 1").count() == 0


def test_grades_of_a_table(spark):
    d, labels = base.documents(spark, "/root/testdata/sf0.01"), base.documents(spark, "/root/testdata/sf0.01", "labels")
    model = grades.fit(d, grades.ratings(labels))
    assert (np.diff(model.thresholds) > 0).all()
    got = grades.grade(extra(docs(spark, ODD)), model).collect()
    assert len(got) == len(ODD) and all(0 <= r["tail"] <= 1 and 0 <= r["expected_grade"] <= 2 for r in got)
    rows = grades.grade(d, model).join(labels, "doc_id").where(base.held_out("doc_id")).collect()
    assert sum(r["kept"] == (r["quality"] == 1) for r in rows) >= 0.9 * len(rows)
    assert grades.grade(d.limit(0), model).count() == 0


def test_grades_of_a_longer_scale_are_all_learned(spark):
    r = random.Random(8)
    rows = [(i, " ".join(r.choice([f"word{i % 5}", "the", "of"]) for _ in range(60)), "en", "s", 0) for i in range(400)]
    rated = spark.createDataFrame([(i, i % 5 + 1) for i in range(400)] + [(1000, None)], "doc_id long, grade int")
    model = grades.fit(docs(spark, rows), rated)
    assert len(model.thresholds) == 5
    got = {x["doc_id"]: x["expected_grade"] for x in grades.grade(docs(spark, rows), model).collect()}
    mean = [np.mean([got[i] for i in range(400) if i % 5 + 1 == k]) for k in (3, 4, 5)]
    assert mean == sorted(mean) and mean[-1] > 4
    for wrong in (-1, grades.MOST + 1):
        with pytest.raises(ValueError):
            grades.fit(docs(spark, rows), rated.withColumn("grade", F.lit(wrong)))


def test_licenses_of_a_table(spark):
    rows = ODD + [(50, "é\nReleased under the MIT License.\nmore", "en", "s", 0)]
    got = licenses.scan_licenses(extra(docs(spark, rows))).collect()
    assert [(r["doc_id"], r["license"], r["coverage"]) for r in got] == [(50, "MIT", 1.0)]
    assert rows[-1][1][got[0]["start"] : got[0]["end"]] == "Released under the MIT License"
    assert licenses.scan_licenses(docs(spark, rows), templates={}).count() == 0
    # the whole table: exactly the documents that hold a notice
    d = base.documents(spark, "/root/testdata/sf0.01")
    plain = {r["doc_id"] for r in d.collect() if any(t.lower() in " ".join(r["text"].split()).lower() for t in licenses.TEMPLATES.values())}
    assert {r["doc_id"] for r in queries.op6_license_scan(spark, "/root/testdata/sf0.01").collect()} == plain


def test_frequent_lines_are_removed_and_depleted_documents_rejected(spark):
    r = random.Random(9)
    own = lambda n: " ".join(f"u{r.randrange(10**9)}" for _ in range(n))
    foot = "All rights reserved " + " ".join(f"f{i}" for i in range(40))
    rows = [(i, f"{own(60)}\n{foot}", "en", "h1", 0) for i in range(1000, 1040)]
    rows += [(100 + i, f"{own(12)}\n  {foot.upper()}", "en", "h1", 0) for i in range(5)]
    rows += [(200 + i, f"{own(12)}\n{foot}", "en", "h2", 0) for i in range(5)]
    copy = own(80)
    rows += [(300 + i, copy, "en", "h1", 0) for i in range(60)]
    df = extra(docs(spark, rows + ODD).drop("host"))
    got = {}
    for x in lines.judge(df).collect():
        got.setdefault(x["doc_id"], []).append(x)
    kept = {i for i, x in got.items() if x[0]["kept"]}
    # lines of one host say nothing of another, and copies of a text are one document
    assert kept == set(range(1000, 1040)) | {200 + i for i in range(5)} | {300 + i for i in range(60)}
    assert not got[100][0]["base_failed"] and got[100][0]["kept_words"] == 12
    assert got[1][-1]["doc_id"] == 1 and len(got[3]) == 2 and got[4][0]["base_failed"]
    stripped = lines.strip(df)
    assert stripped.columns == df.columns and stripped.count() == df.count()
    text = {x["doc_id"]: x["text"] for x in stripped.where("doc_id in (100, 200, 1, 2)").collect()}
    assert foot.upper() not in text[100] and foot in text[200] and text[1] is None and text[2] == ""
    assert lines.judge(df.limit(0)).count() == 0


@pytest.mark.parametrize("n", [100, 3000])
def test_a_footer_goes_in_a_host_of_any_size(spark, n):
    """The footer is on 60 documents; others of the host hold lines of their own."""
    foot = "all rights reserved " + " ".join(f"f{i}" for i in range(60))
    rows = [(i, f"{' '.join(f'u{i}x{k}' for k in range(40))}" + (f"\n\n{foot}\nlast line of {i}" if i < 60 else ""), "en", "h", 0) for i in range(n)]
    got = {x["doc_id"]: x for x in lines.judge(docs(spark, rows), most=50, min_words=10).collect()}
    assert all(not got[i]["kept"] and got[i]["kept_words"] == 44 for i in range(60)) and all(got[i]["kept"] for i in range(60, n))
    text = {x["doc_id"]: x["text"] for x in lines.strip(docs(spark, rows), most=50).collect()}
    assert all(text[i] == rows[i][1].replace(f"\n{foot}", "") for i in range(n))
    # without the bound on documents the share of a large host would keep it
    assert lines.judge(docs(spark, rows), most=10**6, min_words=10).where("not kept").count() == (60 if n == 100 else 0)


def test_pipeline_stages_take_effect_and_keep_columns(spark):
    sf = "/root/testdata/sf0.01"
    d, columns = base.documents(spark, sf), base.documents(spark, sf).columns
    rows = [r["doc_id"] for r in d.collect()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = base.stage(stage(spark, d, sf), f"test-{name}")
        assert out.columns == columns
        now = [r["doc_id"] for r in out.collect()]
        if name != "source_mix":
            assert len(now) == len(set(now)) and set(now) <= set(rows)
        if name == "toxicity":
            toxic = {r["doc_id"] for r in base.documents(spark, sf, "labels").where("toxic = 1").collect()}
            assert len(toxic & set(now)) <= 0.2 * len(toxic & set(rows)) and len(now) >= 0.85 * len(rows)
        if name == "near_duplicates":
            exp = brute_jaccard([(r["doc_id"], r["text"]) for r in d.collect()])
            assert sorted(now) == sorted({e[2] for e in exp})
        d, rows = out, now
    packed = corpus_pipeline.packing(spark, d, sf).collect()
    assert Counter(r["doc_id"] for r in packed if r["piece"] == 0) == Counter(rows)


CLASHING = (
    "row", "score", "rejected", "lang_pred", "predicted", "point", "maybe", "kept", "id", "times", "n", "key", "x", "k", "part", "place", "piece", "length", "start", "offset", "rank",
    "sequence_id", "size", "target", "node", "root", "region", "rep", "__text", "__point", "__maybe", "__kept", "__id", "__times", "__key", "__n", "__copies", "__whole", "__seed",
    "__fraction", "__target", "__source_size", "a.b", "with blank",
)


def test_pipeline_leaves_columns_of_any_name_alone(spark):
    rows = [(i, f"the cat and the dog number {i} went over the hill and it was good for them " * 3, "en", f"s{i % 3}", 1) for i in range(40)]
    rows += [(100 + i, f"der Hund und die Katze mit der Nummer {i} sind nicht auf dem Berg und das ist gut " * 3, "de", "s1", 1) for i in range(40)]
    rows += [(3, rows[3][1], "en", "s0", 1), (200, rows[5][1], "en", None, 1), (201, None, None, None, None), (None, "the end of the story is that the cat was on the mat", "en", "s1", 1)]
    d = docs(spark, rows)
    plain = d
    for c in CLASHING:
        d = d.withColumn(c, F.concat(F.lit(f"{c}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out, want = base.stage(stage(spark, d, SF), f"test-{name}"), stage(spark, plain, SF)
        assert out.columns == d.columns
        for r in out.collect():
            assert all(r[c] == f"{c}:{'null' if r['doc_id'] is None else r['doc_id']}" for c in CLASHING)
        if name != "language":  # its model is trained on the table, which is the same
            assert Counter((r["doc_id"], r["text"]) for r in out.collect()) == Counter((r["doc_id"], r["text"]) for r in want.collect())
        d, plain = out, out.select(plain.columns)
    assert corpus_pipeline.packing(spark, d, SF).count() == corpus_pipeline.packing(spark, plain, SF).count() > 0


def test_pipeline_of_an_empty_table(spark):
    d = base.documents(spark, SF).limit(0)
    for name, stage in corpus_pipeline.STAGES:
        d = base.stage(stage(spark, d, SF), f"test-empty-{name}")
        assert d.count() == 0
