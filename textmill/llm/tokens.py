"""Token counts of whole texts, exactly as the tokenizer library gives them.

Huge documents: overlapping chunks are encoded with offsets and spliced at a boundary that is
proven stable in both (see ``stable``); where the overlap has none, it is widened until it
has. All other documents go through a memo: they are cut at the same kind of boundary, and
the library encodes every distinct segment once for as long as a worker remembers it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.llm import base

#: Segments end before ASCII white space that follows something else; texts with other white space are not cut.
SEGMENT = re.compile(r"[ \t-\r]*[^ \t-\r]+|[ \t-\r]+\Z")
BLANKS = " \t\n\v\f\r"
OTHER_SPACE = re.compile("[\x85\xa0  -     　]")
#: Distinct segments that a Python worker remembers at a time. When they are too many, those
#: it learned first stay: common ones come early.
MEMO, STAY = 500_000, 200_000


def load(path: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task a core
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


#: Places where a pre-token ends whatever else the text holds. The byte-level pattern has
#: runs of letters, of numbers and of other signs, each with at most one blank before it, and
#: runs of white space; only the apostrophe of a contraction stands at the head of letters. So a
#: pre-token ends before white space that follows something else, and where letters, digits and other signs
#: meet. Merges never cross pre-tokens: from such a place on the encoding depends on what
#: follows only, and up to it on what precedes only. Only characters whose kind is the same in
#: all versions of Unicode count, and no ``<``, ``|`` and ``>``, so no place is inside a special
#: string. ``\x1c`` to ``\x1f`` are no white space for the tokenizer, and count as neither.
LETTERS = "A-Za-zÀ-ÖØ-öø-ɏΑ-ΡЀ-џぁ-ゖァ-ヺ一-龥가-힣"
SIGNS = r"!-&(-/:;=?@\[-`{}~、。「」，！？；：（）"
STABLE = re.compile(rf"(?<=\S)(?=[ \t-\r])|(?<=[{LETTERS}])(?=[0-9'{SIGNS}])|(?<=[0-9])(?=['{LETTERS}{SIGNS}])|(?<=[{SIGNS}])(?=[0-9{LETTERS}])")


def stable(text: str, lo: int, hi: int) -> Iterator[int]:
    """Proven boundaries b with lo < b < hi, in order, seeing only text[lo:hi]."""
    return (m.start() for m in STABLE.finditer(text, lo, hi) if lo < m.start())


class Chunk:
    """An encoded stretch text[lo:hi] and where its tokens end."""

    def __init__(self, lo: int, hi: int, encoding):
        self.lo, self.hi = lo, hi
        self.ends = np.array([e for _, e in encoding.offsets], np.int64) + lo

    def before(self, at: int) -> int:
        """How many of its tokens end by ``at``, a place where one ends."""
        return int(np.searchsorted(self.ends, at, "right"))

    def ends_at(self, at: int) -> bool:
        i = self.before(at)
        return i > 0 and self.ends[i - 1] == at


def splice(tok, text: str, chunk: int, overlap: int) -> tuple[int, int]:
    """(tokens of the whole text, how often an overlap had to be widened).

    Where an overlap holds no boundary that both chunks have, it is widened to the next one in the
    text, however far that is, and the stretch from the last boundary before it is encoded
    once more, as a whole. So every character is encoded in its chunk, or in two where these
    overlap, and in one such stretch at most."""
    n = len(text)
    spans = [(lo, min(lo + chunk + overlap, n)) for lo in range(0, n, chunk)]
    encode = lambda some: [Chunk(a, b, e) for (a, b), e in zip(some, tok.encode_batch([text[a:b] for a, b in some], add_special_tokens=False))]
    chunks = (c for lo in range(0, len(spans), 4) for c in encode(spans[lo : lo + 4]))
    left, begin, total, widened = next(chunks), 0, 0, 0
    after = None  # the end of a widened overlap, from which on the next chunk counts
    for right in chunks:
        if after is not None:
            if after < right.hi:
                left, begin, after = right, after, None
            continue
        at = next((b for b in stable(text, max(right.lo, begin), min(left.hi, right.hi)) if left.ends_at(b) and right.ends_at(b)), None)
        if at is None and left.hi < n:
            widened += 1
            last = max((b for b in stable(text, begin, left.hi) if left.ends_at(b)), default=begin)
            after = next((m.start() for m in STABLE.finditer(text, left.hi) if m.start() > left.hi), n)
            total += left.before(last) - left.before(begin) + len(tok.encode_batch_fast([text[last:after]], add_special_tokens=False)[0])
            if after < right.hi:
                left, begin, after = right, after, None
        elif at is not None:
            total += left.before(at) - left.before(begin)
            left, begin = right, at
    return total + (len(left.ends) - left.before(begin) if after is None else 0), widened


@cache
def worker(path: str, chunk: int, overlap: int) -> "Counter":
    """One counter for all tasks that a Python worker runs."""
    return Counter(path, chunk, overlap)


base.KEPT["token counts"] = worker.cache_clear


class Counter:
    def __init__(self, path: str, chunk: int, overlap: int):
        self.tok, self.chunk, self.overlap, self.memo = load(path), chunk, overlap, {}

    def encoded(self, texts: list[str]) -> list[int]:
        return [len(e) for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def segments(self, new: list[str]) -> Iterator[tuple[str, int]]:
        """The library's counts of distinct segments. Those that begin with white space are
        encoded many in one text: each joint is a proven boundary."""
        first = [x for x in new if x[0] not in BLANKS or not x.rstrip(BLANKS)]
        yield from zip(first, self.encoded(first))
        rest = [x for x in new if x[0] in BLANKS and x.rstrip(BLANKS)]
        for lo in range(0, len(rest), 4096):
            part = rest[lo : lo + 4096]
            e = self.tok.encode("".join(part), add_special_tokens=False)
            ends = np.maximum.accumulate(np.array([b for _, b in e.offsets]))
            cut = np.searchsorted(ends, np.cumsum([len(x) for x in part]), "right")
            yield from zip(part, np.diff(cut, prepend=0).tolist())

    def counts(self, texts: list[str | None]) -> list[int]:
        out, cut = [0] * len(texts), {}
        for i, t in enumerate(texts):
            if not t:
                continue
            if len(t) > self.chunk + self.overlap:
                out[i] = splice(self.tok, t, self.chunk, self.overlap)[0]
            elif OTHER_SPACE.search(t):
                out[i] = self.encoded([t])[0]
            else:
                cut[i] = SEGMENT.findall(t)
        new = list(set().union(*cut.values()).difference(self.memo)) if cut else []
        if len(self.memo) + len(new) > MEMO:
            self.memo = dict(islice(self.memo.items(), STAY))
            new = list(set().union(*cut.values()).difference(self.memo))
        self.memo.update(self.segments(new))
        for i, segments in cut.items():
            out[i] = sum(map(self.memo.__getitem__, segments))
        return out


def count(docs: DataFrame, path: str, keep: tuple[str, ...] = ("doc_id",), chunk: int = 32_768, overlap: int = 256) -> DataFrame:
    """The columns ``keep``, n_bytes (UTF-8) and n_tokens of every whole text.

    ``path`` is a byte-level BPE file of the tokenizers library, readable on every executor;
    nothing is added, truncated or padded, and special strings count as the library's
    default has it. Texts of more than ``chunk`` characters are spliced from chunks. Null and
    empty texts have 0 of both; repeated rows give repeated rows."""
    rows = docs.select(*keep, F.coalesce("text", F.lit("")).alias("__text"))
    schema = rows.drop("__text").schema.add("n_bytes", "long").add("n_tokens", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc

        counter = worker(path, chunk, overlap)
        for b in batches:
            col = b.column(len(keep))
            n = [x for _, part in base.passes(col) for x in counter.counts(part.to_pylist())]
            yield base.frame_of(b.select(list(range(len(keep)))), n_bytes=pc.binary_length(col).cast(pa.int64()), n_tokens=pa.array(n, pa.int64()))

    return rows.mapInArrow(base.tidy(run, keeps="token counts"), schema)
