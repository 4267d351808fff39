"""Secrets found by pattern and check, merged and replaced."""

import math
import random
import re
from collections import Counter

import pytest

from textmill.operators import secrets as S


def finds(spark, *texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [[(x["kind"], texts[r["doc_id"]][x["start"] : x["stop"]]) for x in r["finds"]] for r in S.with_finds(rows).orderBy("doc_id").collect()]


CARD, IBAN = "4111111111111111", "DE89370400440532013000"


@pytest.mark.parametrize("text,want", [
    (f"pay {CARD} now", [("CARD", CARD)]),
    ("pay 4111 1111 1111 1111, or 5500-0000-0000-0004", [("CARD", "4111 1111 1111 1111"), ("CARD", "5500-0000-0000-0004")]),
    ("pay 4111111111111112 now", []),  # wrong sum
    (f"{CARD}{CARD}", []),  # too long for a card
    (f"to {IBAN}.", [("IBAN", IBAN)]),
    ("to DE89370400440532013001.", []),
    ("GB82WEST12345698765432 é", [("IBAN", "GB82WEST12345698765432")]),
    ("host 10.0.255.1 and 10.0.256.1", [("IP", "10.0.255.1")]),
    ('token = "04dbebab91ab85687d33eeaaf9ac699e1188f962"', [("KEY", "04dbebab91ab85687d33eeaaf9ac699e1188f962")]),
    ("averyveryveryveryverylongword and some-long-slug-of-2024-words", []),
    ("aaaaaaaaaa1a1a1a1aaaaaaaaaaa", []),  # little entropy
    ("write to a.b@mail.example.com or +1 (017) 555-7713", [("EMAIL", "a.b@mail.example.com"), ("PHONE", "+1 (017) 555-7713")]),
    ("04dbebab91ab85687d33eeaaf9ac699e@example.com", [("EMAIL", "04dbebab91ab85687d33eeaaf9ac699e@example.com")]),  # one inside the other
    ("", []),
    (None, []),
])
def test_finds(spark, text, want):
    assert finds(spark, text) == [want]


def test_places_hold_in_long_texts_with_many_finds(spark):
    r = random.Random(2)
    parts = [CARD, IBAN, "x@y.org", "word", "é", "12.34.56.78", "\n", "99"]
    text = " ".join(r.choice(parts) for _ in range(400))
    want = [m[0] for m in re.finditer(r"4111111111111111|DE89370400440532013000|x@y\.org|12\.34\.56\.78", text)]
    assert [x for _, x in finds(spark, text)[0]] == want


def test_redaction_keeps_the_rest(spark):
    rows = spark.createDataFrame([(1, f"é {CARD}, x@y.org; {IBAN}"), (2, "nothing"), (3, None)], "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in S.redact_secrets(rows).collect()}
    assert got == {1: "é [CARD], [EMAIL]; [IBAN]", 2: "nothing", 3: None}
    assert S.redact_secrets(rows.limit(0)).count() == 0


def test_entropy_equals_its_formula(spark):
    words = ["a", "abcabc", "04dbebab91ab85687d33", "aab"]
    rows = spark.createDataFrame([(w,) for w in words], "w string")
    for r in rows.select("w", S.entropy(rows.w).alias("e")).collect():
        c = Counter(r["w"])
        assert r["e"] == pytest.approx(-sum(k / len(r["w"]) * math.log2(k / len(r["w"])) for k in c.values()))


def test_a_check_tells_secrets_from_chance(spark):
    """One number of ten passes the sum of a card, one of 97 that of an account; planted ones all do."""
    r = random.Random(3)
    chance = " ".join("".join(r.choice("0123456789") for _ in range(16)) for _ in range(400))
    rows = spark.createDataFrame([(1, chance), (2, f"{CARD} " * 50)], "doc_id long, text string")
    got = {x["kind"]: x for x in S.secrets_report(rows).collect()}
    assert got["CARD"]["n_candidates"] == 450 and 50 + 15 <= got["CARD"]["n_confirmed"] <= 50 + 75 and got["CARD"]["n_docs"] == 2
    assert got["KEY"]["n_confirmed"] == 0 and got["EMAIL"]["n_candidates"] == 0
