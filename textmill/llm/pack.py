"""Packing tokenised documents into few sequences of a fixed length.

The instance is the histogram of piece lengths, which has at most ``capacity`` entries
whatever the corpus holds; it alone goes to the driver. There the Martello-Toth reduction
fixes every small set of pieces that provably dominates all other fillings of a sequence
with its largest piece, again and again, and best-fit decreasing packs what is left. Both
work on runs of equal sequences, so their cost depends on the lengths, not on the documents.
Pieces are then numbered within their length, by task and place, and take their slots.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textmill.llm import base, scan
from textmill.llm.tokens import load

CAPACITY = 2048
#: Distinct words that a Python worker remembers, in two halves: a word that is not met while
#: one half fills up is forgotten.
MEMO = 500_000

Run = tuple[tuple[int, ...], int]  # the lengths in a sequence, and how many sequences are so

LETTER_DIGIT = np.zeros(256, bool)
LETTER_DIGIT[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
#: ASCII marks, without the apostrophe, which may begin a pre-token together with letters.
MARK = np.zeros(256, bool)
MARK[[c for c in range(0x21, 0x7F) if not LETTER_DIGIT[c] and c != 0x27]] = True


class Words(scan.Runs):
    """Words between ASCII white space; with ``split``, marks at the end of a word, behind an
    ASCII letter or digit, are a word of their own: the tokenizer never joins the two."""

    def __init__(self, data: np.ndarray, off: np.ndarray, split: bool):
        super().__init__(data, off, ~scan.SPACE[data])
        if split and len(self.start):
            stop = self.start + self.length
            other = np.maximum.accumulate(np.where(MARK[data], -1, np.arange(len(data))))[stop - 1]  # the last byte that is no mark
            cut = (other + 1)[(other >= self.start) & (other < stop - 1) & LETTER_DIGIT[data[other]]]
            self.start = np.sort(np.concatenate([self.start, cut]))
            self.length = np.sort(np.concatenate([stop, cut])) - self.start
            self.doc = np.searchsorted(off, self.start, "right") - 1
            self.counts = np.bincount(self.doc, minlength=self.n)


@cache
def worker(path: str) -> "WordIds":
    """One for all tasks that a Python worker runs."""
    return WordIds(path)


base.KEPT["word ids"] = worker.cache_clear


class WordIds:
    """Ids of whole texts by a tokenizer that drops white space and lower-cases: the library
    encodes each distinct word once while it is remembered, many in one text. Equal words of a
    pass are told by 64-bit hashes."""

    def __init__(self, path: str):
        self.tok, self.young, self.old = load(path), {}, {}
        uncached = getattr(self.tok.model, "_resize_cache", None)
        if uncached is not None:
            uncached(0)  # no word is asked for twice, so the library's own memo only costs time
        vocabulary = self.tok.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)  # tokens that end a pre-token
        self.ends[[i for x, i in vocabulary.items() if x.endswith("</w>")]] = True

    def remember(self, words: list[bytes], ids: np.ndarray, cut: np.ndarray) -> dict[bytes, bytes]:
        raw, at = ids.astype("<u4").tobytes(), (4 * cut).tolist()
        return {x: raw[a:b] for x, a, b in zip(words, [0, *at], at)}

    def learn(self, new: list[bytes]) -> dict[bytes, bytes]:
        """The library's ids of words, each on its own."""
        out, texts = {}, [x.decode() for x in new]
        plain = [x.isalpha() for x in texts]  # letters only: one pre-token
        for wanted in (True, False):
            own = [k for k, p in enumerate(plain) if p == wanted]
            for lo in range(0, len(own), 4096):
                part = own[lo : lo + 4096]
                words, joined = [new[k] for k in part], " ".join([texts[k] for k in part])
                if wanted:
                    ids = np.array(self.tok.encode_batch_fast([joined], add_special_tokens=False)[0].ids, np.int64)
                    cut = np.flatnonzero(self.ends[ids]) + 1
                    if len(cut) == len(part):
                        out |= self.remember(words, ids, cut)
                        continue
                e = self.tok.encode(joined, add_special_tokens=False)  # or by their places in the text
                ends = np.maximum.accumulate(np.array([b for _, b in e.offsets], np.int64)) if len(e) else np.zeros(0, np.int64)
                cut = np.searchsorted(ends, np.cumsum([len(texts[k]) + 1 for k in part]) - 1, "right")
                out |= self.remember(words, np.array(e.ids, np.int64), cut)
        return out

    def look_up(self, words: list[bytes]) -> list[bytes]:
        if len(self.young) + len(words) > MEMO // 2:
            self.old, self.young = self.young, {}
        young, old = self.young, self.old
        new = []
        for x in words:
            if x not in young:
                if x in old:
                    young[x] = old[x]
                else:
                    new.append(x)
        young |= self.learn(new)
        return [young[x] for x in words]

    def encode(self, texts: list[str | None]) -> Iterator[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        ids, begin = self.ids_of(pa.array(texts, pa.large_string()))
        for lo, hi in zip(begin.tolist(), begin[1:].tolist()):
            yield ids[lo:hi].tobytes()

    def ids_of(self, col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Little-endian unsigned 32-bit ids of all texts, and where each text's begin."""
        data, off = scan.flat(col)
        raw = data.tobytes()
        special = b"<|" in raw  # may be a special string, which is taken as it is
        if not special:
            data = scan.LOWER[data]
            raw = data.tobytes()
        w = Words(data, off, split=not special)
        if not len(w.start):
            return np.zeros(0, "<u4"), np.zeros(w.n + 1, np.int64)
        _, first, which = np.unique(w.hashes(), return_index=True, return_inverse=True)
        own = self.look_up([raw[a : a + n] for a, n in zip(w.start[first].tolist(), w.length[first].tolist())])
        size = np.array([len(x) for x in own], np.int64) // 4
        ids, begin = np.frombuffer(b"".join(own), "<u4"), np.cumsum(size) - size
        many = size[which]
        upto = np.concatenate([[0], np.cumsum(many)])
        out = ids[np.repeat(begin[which] - upto[:-1], many) + np.arange(upto[-1])]
        return out, upto[np.concatenate([[0], np.cumsum(w.counts)])]


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, part, place) of every document: its ids and
    an end mark, cut only if longer than ``capacity``. ``place`` counts the pieces of one
    length within the task ``part``; both are numbers only, and hold once the rows are
    written. Null and empty texts are the end mark alone; repeated rows are packed each."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("__text"))
    schema = rows.select("doc_id").schema
    for name, kind in (("piece", "integer"), ("start", "long"), ("length", "long"), ("ids_crc32", "long"), ("part", "integer"), ("place", "long")):
        schema = schema.add(name, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seen, tok = TaskContext.get().partitionId(), [0] * (capacity + 1), worker(path)
        last, size = np.array([end_id], "<u4").tobytes(), 4 * capacity
        for b in batches:
            for lo, col in base.passes(b.column(1)):
                doc, out = [], []
                found, begin = tok.ids_of(col)
                raw, begin = found.tobytes(), (4 * begin).tolist()
                for i in range(len(col)):
                    ids = raw[begin[i] : begin[i + 1]] + last
                    for k, at in enumerate(range(0, len(ids), size)):
                        own = ids[at : at + size]
                        n = len(own) // 4
                        doc.append(lo + i)
                        out.append((k, at // 4, n, zlib.crc32(own), seen[n]))
                        seen[n] += 1
                k, start, n, crc, place = (np.array(x, np.int64) for x in zip(*out)) if out else [np.zeros(0, np.int64)] * 5
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(doc, pa.int64())), pa.array(k.astype(np.int32)), pa.array(start), pa.array(n), pa.array(crc), pa.array(np.full(len(n), part, np.int32)), pa.array(place)],
                    schema.names,
                )

    return rows.mapInArrow(base.tidy(run, keeps="word ids"), schema)


class Bag:
    """Counts of lengths, and its lengths in order."""

    def __init__(self, counts: dict[int, int]):
        self.n = {k: v for k, v in counts.items() if v > 0}
        self.sizes = sorted(self.n)

    def take(self, items: tuple[int, ...], times: int) -> None:
        for x in items:
            self.n[x] -= times
            if not self.n[x]:
                del self.n[x]
                self.sizes.pop(bisect_left(self.sizes, x))

    def largest(self, most: int, used: tuple[int, ...]) -> int:
        """The largest length up to ``most`` of which one is left besides ``used``, or 0."""
        i = bisect_left(self.sizes, most + 1) - 1
        while i >= 0 and self.n[self.sizes[i]] <= used.count(self.sizes[i]):
            i -= 1
        return self.sizes[i] if i >= 0 else 0

    def smallest(self, k: int, used: tuple[int, ...], over: int = 0) -> list[int]:
        """The k smallest pieces over a length besides ``used``, fewer if there are no more."""
        out, i = [], bisect_left(self.sizes, over + 1)
        while len(out) < k and i < len(self.sizes):
            x = self.sizes[i]
            out += [x] * min(k - len(out), self.n[x] - used.count(x))
            i += 1
        return out


def best_pair(bag: Bag, room: int, used: tuple[int, ...]) -> int:
    """The largest sum up to ``room`` of two pieces besides ``used``."""
    best, i, j = 0, 0, bisect_left(bag.sizes, room + 1) - 1
    left = lambda x: bag.n[x] - used.count(x)
    while i <= j:
        a, b = bag.sizes[i], bag.sizes[j]
        if a + b > room or left(b) <= 0 or i == j and left(b) < 2:
            j -= 1
        else:
            if left(a) > 0:
                best = max(best, a + b)
            i += 1
    return best


def dominating(bag: Bag, big: int, capacity: int) -> tuple[int, ...] | None:
    """Pieces that some best packing puts in one sequence with a piece of length ``big``, or
    None if no set of at most three is proven to dominate all others. All the conditions
    still hold when pieces are taken away, as long as the set itself is there."""
    room, own = capacity - big, (big,)
    low = bag.smallest(3, own)
    if not low or low[0] > room:
        return own  # nothing fits beside it
    a = bag.largest(room, own)
    if a == room or len(low) < 2 or low[0] + low[1] > room:
        return (big, a)  # full, or at most one more fits: the largest is at least as good
    if len(low) == 3 and sum(low) <= room:
        return None
    # at most two more fit
    if a >= best_pair(bag, room, own):
        return (big, a)
    b = bag.largest(room - a, (big, a))
    over = bag.smallest(2, own, b)
    if b and (len(over) < 2 or sum(over) > room):
        return (big, a, b)  # of two that fit, one is at most b, and the other at most a
    return None


def reduce_instance(counts: dict[int, int], capacity: int) -> tuple[list[Run], dict[int, int]]:
    """Sequences fixed by dominance, and the counts that are left."""
    bag, fixed, changed = Bag(counts), [], True
    while changed:
        changed = False
        for big in sorted(bag.n, reverse=True):
            while big in bag.n and (items := dominating(bag, big, capacity)):
                times = min(bag.n[x] // items.count(x) for x in items)
                bag.take(items, times)
                fixed.append((items, times))
                changed = True
    return fixed, bag.n


def best_fit(counts: dict[int, int], capacity: int) -> list[Run]:
    """Best-fit decreasing over runs of equal pieces and equal sequences."""
    open_by: dict[int, list[list]] = {}  # room -> [lengths, sequences]
    rooms: list[int] = []

    def put(items: tuple[int, ...], room: int, times: int) -> None:
        if times:
            if room not in open_by:
                insort(rooms, room)
            open_by.setdefault(room, []).append([items, times])

    for x in sorted(counts, reverse=True):
        n = counts[x]
        while n:
            i = bisect_left(rooms, x)
            room = rooms[i] if i < len(rooms) else capacity
            items, times = open_by[room].pop() if i < len(rooms) else ((), n)
            if i < len(rooms) and not open_by[room]:
                del open_by[room]
                rooms.pop(i)
            each = room // x  # the fullest sequence that x fits goes on taking it
            take = min(times, n // each)
            put(items + (x,) * each, room - each * x, take)
            n -= take * each
            if take < times and n < each and n:
                put(items + (x,) * n, room - n * x, 1)
                take, n = take + 1, 0
            if items:
                put(items, room, times - take)
    return [(tuple(items), times) for room in open_by.values() for items, times in room]


def solve(counts: dict[int, int], capacity: int = CAPACITY) -> list[Run]:
    fixed, rest = reduce_instance(counts, capacity)
    return fixed + best_fit(rest, capacity)


def slots(runs: list[Run]) -> dict[str, np.ndarray]:
    """For each length, the runs of ranks that go to one place in consecutive sequences:
    arrays key (length and first rank), first, sequence, offset, sorted by key."""
    next_rank: dict[int, int] = {}
    out, seq = [], 0
    for items, times in runs:
        at = 0
        for x in items:
            lo = next_rank.get(x, 0)
            next_rank[x] = lo + times
            out.append((x, lo, seq, at))
            at += x
        seq += times
    out.sort()
    length, lo, sequence, offset = (np.array(x, np.int64) for x in zip(*out)) if out else [np.zeros(0, np.int64)] * 4
    return {"length": length, "lo": lo, "sequence": sequence, "offset": offset}


RANK_BITS = 48


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of every piece; an
    empty table gives no rows. Columns other than doc_id and text play no part."""
    spark = docs.sparkSession
    own = base.stage(pieces(docs, path, capacity, end_id), "pack-pieces")
    by_part = own.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    by_part = base.stage(by_part, "pack-counts")
    counts = {r["length"]: r["n"] for r in by_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most ``capacity`` rows
    table = slots(solve(counts, capacity))
    sent = spark.sparkContext.broadcast((table["length"] << RANK_BITS | table["lo"], table))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    by_part = by_part.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    # a row for each task and length: as many as the input has tasks, so never broadcast
    ranked = own.join(by_part.hint("shuffle_merge"), ["part", "length"]).select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("place")).alias("rank"))
    schema = ranked.drop("rank").schema.add("sequence_id", "long").add("offset", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, t = sent.value
        for b in batches:
            length, rank = (b.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (3, 5))
            i = np.searchsorted(key, length << RANK_BITS | rank, "right") - 1
            yield base.frame_of(b.select(list(range(5))), sequence_id=t["sequence"][i] + rank - t["lo"][i], offset=t["offset"][i])

    return ranked.mapInArrow(base.tidy(run), schema)
