"""Porter (1980) suffix-stripping stemmer, written from the published
algorithm, plus an Arrow-batched column function that stems token arrays.

Used only by ROUGE tokenisation with ``stem=True`` (words longer than three
characters are stemmed). Each Python worker memoises the stems it has seen,
so every distinct word is stemmed about once per worker.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

VOWELS = frozenset("aeiou")

# The suffix rules of steps 2, 3 and 4 of the published algorithm.
STEP2 = (
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"),
    ("abli", "able"), ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"),
    ("ization", "ize"), ("ation", "ate"), ("ator", "ate"), ("alism", "al"), ("iveness", "ive"),
    ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"),
)
STEP3 = (
    ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""), ("ness", ""),
)
STEP4 = (
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou",
    "ism", "ate", "iti", "ous", "ive", "ize",
)


def _is_consonant(w: str, i: int) -> bool:
    c = w[i]
    if c in VOWELS:
        return False
    if c == "y":
        return i == 0 or not _is_consonant(w, i - 1)
    return True


def _measure(stem: str) -> int:
    """m in [C](VC)^m[V]."""
    m, prev_vowel = 0, False
    for i in range(len(stem)):
        cons = _is_consonant(stem, i)
        if cons and prev_vowel:
            m += 1
        prev_vowel = not cons
    return m


def _has_vowel(stem: str) -> bool:
    return any(not _is_consonant(stem, i) for i in range(len(stem)))


def _double_consonant(w: str) -> bool:
    return len(w) >= 2 and w[-1] == w[-2] and _is_consonant(w, len(w) - 1)


def _cvc(w: str) -> bool:
    if len(w) < 3:
        return False
    return (_is_consonant(w, len(w) - 3) and not _is_consonant(w, len(w) - 2)
            and _is_consonant(w, len(w) - 1) and w[-1] not in "wxy")


def _step1a(w: str) -> str:
    if w.endswith("sses"):
        return w[:-2]
    if w.endswith("ies"):
        return w[:-2]
    if w.endswith("ss"):
        return w
    if w.endswith("s"):
        return w[:-1]
    return w


def _step1b(w: str) -> str:
    if w.endswith("eed"):
        return w[:-1] if _measure(w[:-3]) > 0 else w
    for suf in ("ed", "ing"):
        if w.endswith(suf) and _has_vowel(w[:-len(suf)]):
            w = w[:-len(suf)]
            if w.endswith(("at", "bl", "iz")):
                return w + "e"
            if _double_consonant(w) and w[-1] not in "lsz":
                return w[:-1]
            if _measure(w) == 1 and _cvc(w):
                return w + "e"
            return w
    return w


def _step1c(w: str) -> str:
    if w.endswith("y") and _has_vowel(w[:-1]):
        return w[:-1] + "i"
    return w


def _replace_longest(w: str, rules, min_m: int) -> str:
    for suf, rep in sorted(rules, key=lambda r: -len(r[0])):
        if w.endswith(suf):
            stem = w[:-len(suf)]
            return stem + rep if _measure(stem) > min_m else w
    return w


def _step4(w: str) -> str:
    for suf in sorted(STEP4, key=len, reverse=True):
        if w.endswith(suf):
            stem = w[:-len(suf)]
            if _measure(stem) > 1 and (suf != "ion" or stem.endswith(("s", "t"))):
                return stem
            return w
    return w


def _step5(w: str) -> str:
    if w.endswith("e"):
        stem = w[:-1]
        m = _measure(stem)
        if m > 1 or (m == 1 and not _cvc(stem)):
            w = stem
    if _measure(w) > 1 and _double_consonant(w) and w.endswith("l"):
        w = w[:-1]
    return w


@lru_cache(maxsize=200_000)
def stem(word: str) -> str:
    """Porter stem of a lower-case word (words of up to two letters unchanged)."""
    if len(word) <= 2:
        return word
    w = _step1a(word)
    w = _step1b(w)
    w = _step1c(w)
    w = _replace_longest(w, STEP2, 0)
    w = _replace_longest(w, STEP3, 0)
    w = _step4(w)
    return _step5(w)


def stem_long_words(tokens, min_len: int = 4) -> list[str]:
    return [stem(t) if len(t) >= min_len else t for t in tokens]


def stem_tokens_udf():
    """``array<string> -> array<string>``: stems words longer than three characters."""
    from pyspark.sql.functions import arrow_udf

    @arrow_udf("array<string>")
    def stem_tokens(col: pa.Array) -> pa.Array:
        # only the distinct words of a batch are Python objects
        words = col.flatten().dictionary_encode()
        stems = pa.array(stem_long_words(words.dictionary.to_pylist()), pa.string()).take(words.indices)
        size = pc.fill_null(pc.list_value_length(col), 0).to_numpy(zero_copy_only=False)
        offsets = pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32))
        return pa.ListArray.from_arrays(offsets, stems, mask=col.is_null())

    return stem_tokens
