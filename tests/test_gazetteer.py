"""E3 by a trie: the rows of the n-gram join, for any dictionary."""

import random

import pytest

from textmill.operators import entities as EN
from textmill.operators import gazetteer as G

GZ = "name string, raw_label string"


def rows_of(df):
    return sorted(map(tuple, df.select("doc_id", "name", "raw_label", "pos").collect()), key=str)


@pytest.mark.parametrize("shard", [10**6, 40])
def test_equals_the_join(spark, shard):
    r = random.Random(1)
    words = ["Alpha", "beta", "Gamma", "9", "of", "the", "Delta1"]
    names = {(" ".join(r.choice(words) for _ in range(r.randint(1, 4))), r.choice(["ORG", "LOC"])) for _ in range(150)}
    names |= {("  alpha   beta ", "ORG"), ("no match here", "X"), ("Über alles", "Y"), ("alpha", "A"), ("alpha", "B")}
    docs = [(i, " ".join(r.choice([*words, "other", "ALPHA"]) for _ in range(r.randint(0, 40))) + r.choice(["", ".", " é"])) for i in range(120)]
    docs += [(500, None), (501, ""), (502, "alpha-beta, gamma."), (3, "alpha beta"), (None, "the of")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    gz = spark.createDataFrame(list(names), GZ)
    want = rows_of(EN.extract_gazetteer(df, gz))
    assert rows_of(G.extract_gazetteer(df, gz, shard_names=shard)) == want and len(want) > 500
    assert rows_of(G.extract_gazetteer(df, gz, max_chars=20)) == rows_of(EN.extract_gazetteer(df, gz, max_chars=20))


def test_a_dictionary_of_many_names(spark):
    """200,000 names, a third of which begin with the same word, as do most words of the text."""
    names = [(f"hot n{i}" if i % 3 == 0 else f"first{i} n{i}", "ORG") for i in range(200_000)]
    text = "hot " * 5000 + "hot n300 and First301 N301 hot"
    df = spark.createDataFrame([(1, text), (2, "nothing")], "doc_id long, text string")
    got = rows_of(G.extract_gazetteer(df, spark.createDataFrame(names, GZ).repartition(4)))
    assert got == [(1, "First301 N301", "ORG", 5004), (1, "hot n300", "ORG", 5001)]


def test_empty_sides(spark):
    df = spark.createDataFrame([(1, "alpha")], "doc_id long, text string")
    assert G.extract_gazetteer(df, spark.createDataFrame([], GZ)).count() == 0
    assert G.extract_gazetteer(df.limit(0), spark.createDataFrame([("alpha", "A")], GZ)).count() == 0
    assert "Exchange" not in G.extract_gazetteer(df, spark.createDataFrame([("alpha", "A")], GZ))._jdf.queryExecution().executedPlan().toString()
