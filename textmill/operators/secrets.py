"""Personal data and secrets in texts, found, checked and replaced; map-only, native expressions.

A kind is a pattern, which names candidates, and a check, which most chance candidates fail:
the Luhn sum of a card number, the remainder modulo 97 of an account number, numbers up to 255
in an address, and for keys the entropy of the characters and how often letters and digits take turns.
Finds that overlap become one, named after the longest of them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.operators.entities import PATTERNS
from textmill.session import barrier

#: Bits a character that a key has at least, and places in it where a letter and a digit meet.
KEY_BITS, KEY_TURNS = 3.0, 3


def characters(x: Column) -> Column:
    return F.split(x, "")


def luhn(x: Column) -> Column:
    """13 to 19 digits whose check sum is right; blanks and dashes do not count."""
    digits = F.transform(F.reverse(characters(F.regexp_replace(x, "[ -]", ""))), lambda c: c.cast("int"))
    each = F.transform(digits, lambda d, i: F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d))
    return F.size(digits).between(13, 19) & (F.aggregate(each, F.lit(0), lambda a, d: a + d) % 10 == 0)


def mod97(x: Column) -> Column:
    """An account number of 15 to 34 characters whose remainder is 1."""
    moved = characters(F.concat(F.substr(x, F.lit(5)), F.substring(x, 1, 4)))
    numbers = F.transform(moved, lambda c: F.ascii(c) - F.when(c.rlike("[0-9]"), 48).otherwise(55))  # A is 10
    rest = F.aggregate(numbers, F.lit(0), lambda a, v: (a * F.when(v > 9, 100).otherwise(10) + v) % 97)
    return F.length(x).between(15, 34) & (rest == 1)


def address(x: Column) -> Column:
    return F.forall(F.split(x, "[.]"), lambda n: n.cast("int") <= 255)


def entropy(x: Column) -> Column:
    """Bits a character: the entropy of the character counts."""
    n = F.length(x)
    counts = F.transform(F.array_distinct(characters(x)), lambda d: n - F.length(F.replace(x, d)))
    return F.aggregate(counts, F.lit(0.0), lambda a, k: a - k / n * F.log2(k / n))


def key(x: Column) -> Column:
    turns = F.regexp_count(x, F.lit("[0-9][A-Za-z]")) + F.regexp_count(x, F.lit("[A-Za-z][0-9]"))
    return (turns >= KEY_TURNS) & (entropy(x) >= KEY_BITS)


#: kind -> (pattern, check). Patterns mean the same to Java and RE2, and repeat single characters only.
KINDS: dict[str, tuple[str, Callable[[Column], Column] | None]] = {
    "EMAIL": (PATTERNS["EMAIL"], None),
    "PHONE": (PATTERNS["PHONE"], None),
    "CARD": (r"[0-9]{4}[ -][0-9]{4}[ -][0-9]{4}[ -][0-9]{1,7}|[0-9]{12,}", luhn),
    "IBAN": (r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11,}", mod97),
    "IP": (r"[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}", address),
    "KEY": (r"[A-Za-z0-9+_=-]{20,}", key),
}


def candidates(text: Column, kind: str) -> Column:
    """All matches of a kind's pattern as (start, stop, kind, find); places in characters, from 0.

    The pieces between the matches give their places: the k-th begins behind k + 1 pieces and
    k matches."""
    pattern, _ = KINDS[kind]
    finds, pieces = F.regexp_extract_all(text, F.lit(pattern), 0), F.split(text, pattern, -1)
    sums = lambda x, n: F.aggregate(F.slice(x, 1, n), F.lit(0), lambda a, p: a + F.length(p))

    def at(x: Column, i: Column) -> Column:
        start = sums(pieces, i + 1) + sums(finds, i)
        return F.struct(start.alias("start"), (start + F.length(x)).alias("stop"), F.lit(kind).alias("kind"), x.alias("find"))

    return F.transform(finds, at)


def confirmed(text: Column, kind: str) -> Column:
    _, check = KINDS[kind]
    found = candidates(text, kind)
    return found if check is None else F.filter(found, lambda x: check(x["find"]))


def merged(found: Column) -> Column:
    """Overlapping spans as one (start, stop, kind): that of the longest, of equally long ones
    the first, then by name."""
    spans = F.array_sort(F.transform(found, lambda x: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["stop"].alias("stop"))))
    kind = "array<struct<start:int,stop:int,kind:string,longest:int>>"

    def step(acc: Column, x: Column) -> Column:
        last, size = F.element_at(acc, -1), x["stop"] - x["start"]
        own = F.struct(x["start"].alias("start"), x["stop"].alias("stop"), x["kind"].alias("kind"), size.alias("longest"))
        joined = F.struct(
            last["start"].alias("start"), F.greatest(last["stop"], x["stop"]).alias("stop"),
            F.when(size > last["longest"], x["kind"]).otherwise(last["kind"]).alias("kind"), F.greatest(last["longest"], size).alias("longest"),
        )
        over = (F.size(acc) > 0) & (x["start"] < F.get(acc, F.size(acc) - 1)["stop"])
        return F.when(over, F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), F.array(joined))).otherwise(F.concat(acc, F.array(own)))

    return F.when(F.size(spans) > 0, F.aggregate(spans, F.array().cast(kind), step)).otherwise(F.array().cast(kind))


def with_finds(df: DataFrame, text_col: str = "text", kinds: tuple[str, ...] = tuple(KINDS)) -> DataFrame:
    """``df`` with ``finds``: the merged spans (start, stop, kind) of every text, by start. A null
    text has none."""
    every = F.concat(*[confirmed(F.col(text_col), k) for k in kinds])
    none = F.array().cast("array<struct<start:int,stop:int,kind:string,find:string>>")
    staged = barrier(df.withColumn("finds", F.coalesce(every, none)))
    out = barrier(staged.withColumn("finds", merged(F.col("finds"))))
    return out.withColumn("finds", F.transform("finds", lambda x: F.struct(x["start"].alias("start"), x["stop"].alias("stop"), x["kind"].alias("kind"))))


def redact_secrets(df: DataFrame, text_col: str = "text", kinds: tuple[str, ...] = tuple(KINDS)) -> DataFrame:
    """``df`` with every find replaced by ``[KIND]``, and ``finds`` (places in the text as it was)."""
    out = with_finds(df, text_col, kinds)
    step = lambda acc, x: F.struct(
        F.concat(acc["text"], F.substr(F.col(text_col), acc["at"] + 1, x["start"] - acc["at"]), F.lit("["), x["kind"], F.lit("]")).alias("text"), x["stop"].alias("at"),
    )
    rest = lambda acc: F.concat(acc["text"], F.substr(F.col(text_col), acc["at"] + 1))
    text = F.aggregate("finds", F.struct(F.lit("").alias("text"), F.lit(0).alias("at")), step, rest)
    return out.withColumn(text_col, F.when(F.size("finds") > 0, text).otherwise(F.col(text_col)))


def secrets_report(df: DataFrame, text_col: str = "text", kinds: tuple[str, ...] = tuple(KINDS)) -> DataFrame:
    """For each kind the candidates that its pattern names, those that pass its check, and the
    documents with one."""
    per = F.array(*[F.struct(F.lit(k).alias("kind"), F.size(candidates(F.col(text_col), k)).alias("named"), F.size(confirmed(F.col(text_col), k)).alias("passed")) for k in kinds])
    rows = df.where(F.col(text_col).isNotNull()).select(F.explode(per).alias("x")).select("x.*")
    sums = [F.sum("named").cast("bigint").alias("n_candidates"), F.sum("passed").cast("bigint").alias("n_confirmed")]
    return rows.groupBy("kind").agg(*sums, F.count_if(F.col("passed") > 0).alias("n_docs"))
