"""Column-level text helpers, all native Spark expressions (codegen, no Python).

Patterns are kept inside the subset that Java regex and RE2 read the same
way, so the DuckDB oracle can use the very same strings.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.split()/str.strip() treat as
# whitespace (str.isspace plus the U+001C..U+001F separators), as one class body.
WS_CLASS_BODY = (
    r"\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)
WS = f"[{WS_CLASS_BODY}]"
NON_WS_RUN = f"[^{WS_CLASS_BODY}]+"
# The same characters as a string, and runs of all others for Java's matcher alone: it asks the parts
# of a class one after the other, the innermost brackets last, so nearly every character is settled
# by the first range. (As a negated class each character costs a call for each part.)
WS_CHARS = "\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
NON_WS_RUN_JAVA = (
    r"[!-~[\x00-\x08\x0E-\x1B\x7F-\x{84}\x{86}-\x{9F}\x{A1}-\x{167F}\x{1681}-\x{1FFF}\x{200B}-\x{2027}"
    r"\x{202A}-\x{202E}\x{2030}-\x{205E}\x{2060}-\x{2FFF}\x{3001}-\x{10FFFF}]]+"
)

# A sentence ends at a line end, or at terminators before white space: a dot inside an
# e-mail address, a URL or a decimal ends none. (No repeated group: Java's matcher recurses
# on those and can run out of stack on long texts.)
SENTENCE_END = r"([.!?]+)[ \t\n]+"
# The head of a text in which its first sentences are looked for.
LEAD_CHARS = 1_000
# Words for scoring and graph building.
WORD_PATTERN = r"[a-z0-9]+"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def ustrip(text) -> Column:
    """Python ``str.strip()`` semantics (Unicode whitespace + U+001C..U+001F)."""
    return F.btrim(_c(text), F.lit(WS_CHARS))


def _replace_where(text: Column, marks: tuple[str, ...], pattern: str, by: str) -> Column:
    """``regexp_replace`` in the texts that hold one of ``marks``, without which ``pattern`` finds
    nothing; the others pass for a search of their bytes. ``text`` is evaluated once."""
    def replaced(t):
        held = functools.reduce(Column.__or__, [t.contains(m) for m in marks])
        return F.when(held, F.regexp_replace(t, pattern, by)).otherwise(t)

    return F.get(F.transform(F.array(text), replaced), 0)


def normalize_whitespace(text) -> Column:
    """CRLF/CR -> LF, runs of space/tab -> one space, 3+ LF -> 2 LF, then strip. Single spaces,
    most of all runs, are no matches, as they stay what they are."""
    t = F.replace(F.replace(_c(text), F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    t = _replace_where(t, ("\t", "  "), r"\t[ \t]*| [ \t]+", " ")
    t = _replace_where(t, ("\n\n\n",), r"\n{3,}", "\n\n")
    return ustrip(t)


def token_count(text) -> Column:
    """Whitespace token count; '' -> 0 (``size(split())`` would give 1)."""
    return F.regexp_count(_c(text), F.lit(NON_WS_RUN_JAVA)).cast("bigint")


def content_hash(text) -> Column:
    """SHA-256 hex of the UTF-8 bytes."""
    return F.sha2(_c(text), 256)


def truncate_bytes(text, n: int) -> Column:
    """First ``n`` UTF-8 bytes; a character cut in half at the end is dropped."""
    head = F.substring(_c(text).cast("binary"), 1, n)
    return F.rtrim(F.make_valid_utf8(head.cast("string")), F.lit("�"))


def sentences(text) -> Column:
    """Array of trimmed sentences that contain at least one letter or digit."""
    raw = F.split(F.regexp_replace(_c(text), SENTENCE_END, "$1\n"), "\n+")
    trimmed = F.transform(raw, lambda s: ustrip(s))
    return F.filter(trimmed, lambda s: s.rlike("[A-Za-z0-9]"))


def lead_sentences(text, n: int) -> Column:
    """The first ``n`` of ``sentences``. All but the last sentence of a text's head are sentences
    of the whole text, so the whole text is split only where its head has ``n`` or fewer."""
    head = F.slice(sentences(F.substring(_c(text), 1, LEAD_CHARS)), 1, n + 1)
    found = F.transform(F.array(head), lambda h: F.when(F.size(h) > n, h).otherwise(sentences(text)))
    return F.slice(F.get(found, 0), 1, n)


def words(text) -> Column:
    """Lower-case ``[a-z0-9]+`` tokens (scoring tokenisation)."""
    return F.regexp_extract_all(F.lower(_c(text)), F.lit(WORD_PATTERN), 0)


def first_n_words(text, n: int) -> Column:
    """First ``n`` whitespace tokens joined by one space."""
    toks = F.regexp_extract_all(_c(text), F.lit(NON_WS_RUN_JAVA), 0)
    return F.array_join(F.slice(toks, 1, n), " ")
