"""Exact n-gram Jaccard join in the metric space of shingle sets.

1 - Jaccard is a metric, and two documents link within the radius r = 1 - threshold. Equal
sets are one point. Documents that link share some of their first shingles in any fixed
order, here common ones last and others by hash. Per such shingle, the document with the
smallest number is a pivot, and its region holds every document with the shingle: whatever
links meets in the region of some pivot. How many first shingles a document shares with any
partner at least is known (see ``first_shingles``), so most documents need not enter a region
at all, and the others only their main ones. Regions then join:

* a small region in one task: its documents are pivots in turn, and the triangle inequality
  with the distances so far rules out what need not be compared;
* a large one is dealt out: all its documents are measured against a few pivots. Whoever is
  within r of a pivot is linked with it; what is then not in the region's largest component
  falls in the Voronoi cell of its nearest pivot, every other document is replicated to the
  cells in whose triangle-inequality window it lies, and the cells join in blocks.

Only links that connect two parts are kept, so a group of m near copies costs about m rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from textmill.llm import base, scan
from textmill.llm.components import components

SIZE = 5
#: Documents of a region that one task joins alone, and that one block of a larger one holds.
LEAF = 256
PIVOTS = 16
#: Shingles ordered behind all others because they are in most documents. This is about speed
#: only: any order common to all documents gives the same links.
FREQUENT = 50_000
LOCAL, BUFFER = 8, 2_000_000
#: The first shingles are those in this part of the hash range, a quarter of the set at least.
FIRST = 0.36
#: Bits of a filter for each thing in it, and bits at least and at most: what a filter lets
#: through in vain goes in the join behind it.
FILTER_BITS, FILTER_LEAST, FILTER_MOST = 16, 1 << 20, 1 << 28
#: First shingles that a task holds before it sends them on, and that a slot has about in all.
HELD, SLOT = 4_000_000, 2_000_000
#: Sets with the most copies whose copies are passed over in all tasks; others only cost more.
COPIED = 1_000_000


def signatures(sets: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """A 64-bit number of each set; 0 for the empty one."""
    n = np.diff(begin)
    out = np.zeros(len(n), scan.U)
    held = np.flatnonzero(n)
    if len(held):
        out[held] = scan.mix(np.add.reduceat(scan.mix(sets ^ scan.STEP), begin[held]) + n[held].astype(scan.U)) | scan.U(1)
    return out


class Frequencies:
    """Counts of the shingles of a task's documents by lossy counting: a count is short by
    one at most for each time that the buffer was full."""

    def __init__(self):
        self.parts, self.held, self.times = [], 0, 0
        self.keys, self.counts = np.zeros(0, scan.U), np.zeros(0, np.int64)

    def add(self, shingles: np.ndarray) -> None:
        self.parts.append(shingles)
        self.held += len(shingles)
        if self.held > BUFFER:
            self.times += 1
            self.merge(self.times + 1)

    def merge(self, least: int) -> None:
        keys = np.concatenate([self.keys, *self.parts])
        weights = np.concatenate([self.counts, np.ones(self.held, np.int64)])
        order = np.argsort(keys)
        keys = keys[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
        counts = np.add.reduceat(weights[order], first) if len(first) else np.zeros(0, np.int64)
        keep = counts >= least
        self.keys, self.counts, self.parts, self.held = keys[first][keep], counts[keep], [], 0


def common_shingles(docs: DataFrame) -> DataFrame:
    """(shingle, n): the shingles that at least LOCAL points of a task have, a row for each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        freq, seen = Frequencies(), set()
        for b in batches:
            for _, col in base.passes(b.column(0)):
                sets, begin = scan.shingle_sets(col, SIZE)
                fresh = [i for i, p in enumerate(signatures(sets, begin).tolist()) if p not in seen and not seen.add(p)]
                freq.add(np.concatenate([sets[begin[i] : begin[i + 1]] for i in fresh]) if fresh else sets[:0])
                if len(seen) > BUFFER:
                    seen = set()
        freq.merge(LOCAL)
        yield pa.RecordBatch.from_arrays([pa.array(freq.keys.view(np.int64)), pa.array(freq.counts)], ["shingle", "n"])

    return docs.select("text").mapInArrow(base.tidy(run), "shingle long, n long")


def frequent(docs: DataFrame) -> list[np.ndarray]:
    """At most FREQUENT shingles, sorted, and the rank of each from rare to common."""
    sums = common_shingles(docs).groupBy("shingle").agg(F.sum("n").alias("n"))
    top = sums.orderBy(F.desc("n"), "shingle").limit(FREQUENT).collect()
    key, n = np.array([r["shingle"] for r in top], np.int64).view(scan.U), np.array([r["n"] for r in top], np.int64)
    rank = np.empty(len(key), np.int64)
    rank[np.lexsort((key, n))] = np.arange(len(key))
    order = np.argsort(key)
    return [key[order], rank[order]]


def first_shingles(sets: np.ndarray, begin: np.ndarray, keys: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places of the first shingles of all sets, how many each set shares at least with any
    partner).

    A set of n has its first L in the common order: those in the part FIRST of the hash range,
    floor(n / 4) + 1 at least. Take a linked pair, and of the two the set z of n_z whose first
    shingles end earlier in the order. The pair has 3 n_z / 4 or more shingles in common; at most
    n_z - L_z of these come later, and the others are first ones of both. So both share
    L_z - floor(n_z / 4) first shingles or more. If the end is the same for both, either can be
    z; if not, the other one has just floor(n / 4) + 1 and is only promised one.
    """
    n = np.diff(begin)
    doc = np.repeat(np.arange(len(n)), n)
    at = np.searchsorted(keys, sets)
    at[at == len(keys)] = 0
    common = (keys[at] == sets) if len(keys) else np.zeros(len(sets), bool)
    early = (sets < scan.U(int(FIRST * 2**64))) & ~common
    take = np.maximum(np.bincount(doc[early], minlength=len(n)), n // 4 + (n > 0))
    # within a document sets are in order already; only those with common shingles are sorted anew
    order = np.arange(len(sets))
    for i in np.unique(doc[common]):
        a, b = begin[i], begin[i + 1]
        order[a:b] = a + np.lexsort((sets[a:b], np.where(common[a:b], rank[at[a:b]], -1)))
    place = np.arange(len(sets)) - np.repeat(begin[:-1], n)
    return order[place < np.repeat(take, n)], take - n // 4


def profile(docs: DataFrame, order: list[np.ndarray]) -> DataFrame:
    """doc_id, n_shingles, point (the signature of its set) and need (first shingles shared with any partner)."""
    sent = docs.sparkSession.sparkContext.broadcast(order)
    rows = docs.select("doc_id", F.col("text").alias("__text"))
    schema = rows.select("doc_id").schema.add("n_shingles", "long").add("point", "long").add("need", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, col in base.passes(b.column(1)):
                sets, begin = scan.shingle_sets(col, SIZE)
                _, need = first_shingles(sets, begin, *sent.value)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, len(col)), pa.array(np.diff(begin)), pa.array(signatures(sets, begin).view(np.int64)), pa.array(need)], schema.names)

    return rows.mapInArrow(base.tidy(run), schema)


def copied(profiles: DataFrame) -> list[np.ndarray]:
    """Points that several documents have, sorted, and the hash of the document that stands
    for each: COPIED points at most, those with the most copies."""
    held = profiles.where("n_shingles > 0").groupBy("point").agg(F.min(F.xxhash64("doc_id")).alias("h"), F.count(F.lit(1)).alias("n"))
    top = held.where("n > 1").orderBy(F.desc("n"), "point").limit(COPIED).select("point", "h").toArrow()
    point, h = (top.column(c).to_numpy() for c in ("point", "h"))
    order = np.argsort(point)
    return [point[order], h[order]]


def fresh_first(col: pa.Array, ids: np.ndarray, order: list[np.ndarray], known: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The first shingles of every set of a pass, of copies once, and the points they are of.
    ids: hashes of the documents; known: see ``copied``."""
    sets, begin = scan.shingle_sets(col, SIZE)
    point = signatures(sets, begin)
    chosen, _ = first_shingles(sets, begin, *order)
    doc = np.repeat(np.arange(len(point)), np.diff(begin))
    many, stands = known
    own = np.ones(len(point), bool)
    if len(many):
        at = np.minimum(np.searchsorted(many, point.view(np.int64)), len(many) - 1)
        own = (many[at] != point.view(np.int64)) | (stands[at] == ids)
    fresh = np.zeros(len(point), bool)
    fresh[np.flatnonzero(own)[np.unique(point[own], return_index=True)[1]]] = True
    chosen = chosen[fresh[doc[chosen]]]
    return sets[chosen], point[doc[chosen]]


def twice(s: np.ndarray) -> np.ndarray:
    """A sorted array with the third and later of equal entries left out."""
    keep = np.ones(len(s), bool)
    keep[2:] = s[2:] != s[:-2]
    return s[keep]


def repeated_shingles(docs: DataFrame, order: list[np.ndarray], known: list[np.ndarray], n_first: int) -> tuple[DataFrame, int]:
    """(s), and the bits of a slot: numbers of first shingles that two points have (and a few that one point has twice,
    as a copy in another task).

    A shingle's slot are the upper bits of its hash; of the others 32 are sent, packed into one
    row for each slot and stretch of a task, a shingle twice at most. So a shingle that only
    one point has, as most are, costs four bytes here and is never a row."""
    bits = max(6, (n_first // SLOT).bit_length())
    sent = docs.sparkSession.sparkContext.broadcast((order, known))
    high, low = scan.U(64 - bits), scan.U(32 - bits)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0

        def rows() -> pa.RecordBatch:
            s = np.concatenate(parts) if parts else np.zeros(0, scan.U)
            s.sort()
            s = twice(s)
            slot = (s >> high).astype(np.int64)
            begin = np.flatnonzero(np.diff(slot, prepend=-1))
            data = (s >> low).astype("<u4").tobytes()
            cut = [*(4 * begin).tolist(), len(data)]
            return pa.RecordBatch.from_arrays([pa.array(slot[begin]), pa.array([data[x:y] for x, y in zip(cut, cut[1:])], pa.binary())], ["slot", "packed"])

        for b in batches:
            for lo, col in base.passes(b.column(0)):
                parts.append(fresh_first(col, b.column(1).slice(lo, len(col)).to_numpy(), *sent.value)[0])
                held += len(parts[-1])
                if held >= HELD:
                    yield rows()
                    parts, held = [], 0
        yield rows()

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (slot,), own in by_key(batches, 1):
            s = np.concatenate([np.frombuffer(x, "<u4") for (x,) in own])
            s.sort()
            again = np.unique(s[1:][s[1:] == s[:-1]])
            yield pa.RecordBatch.from_arrays([pa.array((slot << 32 | again.astype(np.int64)))], ["s"])

    packed = docs.select("text", F.xxhash64("doc_id")).mapInArrow(base.tidy(pack), "slot long, packed binary")
    return packed.repartition("slot").sortWithinPartitions("slot").mapInArrow(base.tidy(meet), "s long"), bits


def postings(docs: DataFrame, order: list[np.ndarray], known: list[np.ndarray], n_first: int) -> DataFrame:
    """(s, point): the first shingles of every set that are another point's as well, and few
    others; of copies once."""
    again, bits = repeated_shingles(docs, order, known, n_first)
    again = base.stage(again, "jaccard-repeated")
    sent = docs.sparkSession.sparkContext.broadcast((order, known, filter_bits(again, F.col("s"), again.count())))
    low = scan.U(32 - bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order, known, shared = sent.value
        for b in batches:
            for lo, col in base.passes(b.column(0)):
                s, point = fresh_first(col, b.column(1).slice(lo, len(col)).to_numpy(), order, known)
                keep = in_filter(shared, (s >> low).view(np.int64))
                s, point = s[keep], point[keep]
                yield pa.RecordBatch.from_arrays([pa.array(s.view(np.int64)), pa.array(point.view(np.int64))], ["s", "point"])

    return docs.select("text", F.xxhash64("doc_id")).mapInArrow(base.tidy(run), "s long, point long")


def regions_of(docs: DataFrame, profiles: DataFrame, points: DataFrame, order: list[np.ndarray]) -> DataFrame:
    """(region, point, rep, size): the documents of every region.

    A document whose first shingles are shared less often than it needs has no partner. Of
    its regions a document leaves the smallest, by shingles, as long as they sum up to less
    than half of its need: two partners then still have a shingle whose region neither left.
    """
    n_first = profiles.agg(F.sum(F.col("need") + F.floor(F.col("n_shingles") / 4))).first()[0] or 0
    own = base.stage(postings(docs, order, copied(profiles), n_first), "jaccard-postings")
    region = own.groupBy("s").agg(F.min("point").alias("region"), F.max("point").alias("other")).where("region <> other").drop("other")
    shared = own.join(region, "s").groupBy("region", "point").agg(F.count(F.lit(1)).alias("k"))
    shared = base.stage(shared, "jaccard-shared")
    held = shared.join(points, "point").withColumn("total", F.expr("sum(k) over (partition by point)"))
    held = held.withColumn("upto", F.expr("sum(k) over (partition by point order by k, region)"))
    held = held.where("total >= need and 2 * upto >= need").select("region", "point", "rep")
    held = base.stage(held, "jaccard-regions")
    sizes = held.groupBy("region").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    return base.stage(held.join(sizes, "region"), "jaccard-members")


def filter_bits(rows: DataFrame, value: Column, n: int) -> np.ndarray:
    """A filter with the bit ``value`` modulo its size set for each of ``n`` rows. Executors make
    the bits; at most FILTER_MOST / 8 bytes come to the driver."""
    size = min(max(1 << (FILTER_BITS * n).bit_length(), FILTER_LEAST), FILTER_MOST)
    place = rows.select((F.pmod(value, F.lit(size)) + 1).alias("b"))
    made = place.groupBy(F.bitmap_bucket_number("b").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("b")).alias("bits")).collect()
    out = np.zeros(size // 8, np.uint8)
    for r in made:  # buckets count from 1
        own = np.frombuffer(r["bits"], np.uint8)
        at = (r["bucket"] - 1) * len(own)
        out[at : at + len(own)] = own[: len(out) - at]
    return out


def in_filter(bits: np.ndarray, value: np.ndarray) -> np.ndarray:
    at = value & (8 * len(bits) - 1)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


def wanted_texts(docs: DataFrame, members: DataFrame) -> DataFrame:
    """(__id, __text) of the documents that represent a member, and few others: the filter
    keeps most others out of the shuffle to the join."""
    wanted = members.select("rep").distinct()
    sent = docs.sparkSession.sparkContext.broadcast(filter_bits(wanted, F.xxhash64("rep"), wanted.count()))
    texts = docs.select(F.col("doc_id").alias("__id"), F.col("text").alias("__text")).where(F.col("__text").isNotNull())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.select([1, 2]).filter(pa.array(in_filter(sent.value, b.column(0).to_numpy())))

    return texts.select(F.xxhash64("__id"), "__id", "__text").mapInArrow(base.tidy(run), texts.schema)


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Elements that two sorted sets share."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int(np.count_nonzero(b[at] == a))


def linked(common: int, n: int, m: int) -> bool:
    return 100 * common >= 75 * (n + m - common)


RADIUS = 0.25


class Parts:
    """Union-find over places 0 to n - 1."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = i = self.up[self.up[i]]
        return i

    def join(self, i: int, j: int) -> None:
        self.up[self.find(j)] = self.find(i)


def join_region(points: list[int], sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links that connect the documents of one small region just as all its links would."""
    n = np.array([len(s) for s in sets])
    order = np.argsort(-n, kind="stable")
    known: list[np.ndarray] = []  # distances to the pivots so far, nan: not measured
    parts, out = Parts(len(sets)), []
    for k, q in enumerate(order[:-1]):
        rest = order[k + 1 :]
        rest = rest[4 * n[rest] >= 3 * n[q]]
        for d in known:  # triangle inequality
            if len(rest) and d[q] == d[q]:
                rest = rest[~(np.abs(d[rest] - d[q]) > RADIUS + 1e-9)]
        here = parts.find(q)
        rest = [i for i in rest.tolist() if parts.find(i) != here]
        if not rest:
            continue
        d = np.full(len(sets), np.nan)
        for i in rest:
            common = overlap(sets[q], sets[i])
            d[i] = 1 - common / (n[q] + n[i] - common)
            if linked(common, n[q], n[i]):
                parts.join(q, i)
                out.append((points[q], points[i]))
        d[q] = 0
        if len(known) < PIVOTS:
            known.append(d)
    return out


def by_key(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """Runs of rows with the same first ``width`` columns of sorted batches, in turn."""
    key, rows = None, []
    for b in batches:
        columns = [c.to_pylist() for c in b.columns]
        for row in zip(*columns):
            if row[:width] != key:
                if rows:
                    yield key, rows
                key, rows = row[:width], []
            rows.append(row[width:])
    if rows:
        yield key, rows


def sets_of(rows: list[tuple]) -> dict[int, np.ndarray]:
    """The sets of (point, text) rows, of those whose text has that point."""
    out: dict[int, np.ndarray] = {}
    todo = {}
    for point, text in rows:
        todo.setdefault((point, text))
    keys = list(todo)
    for lo, col in base.passes(pa.array([t for _, t in keys], pa.string())):
        sets, begin = scan.shingle_sets(col, SIZE)
        point = signatures(sets, begin).view(np.int64).tolist()
        for i, p in enumerate(point):
            if keys[lo + i][0] == p:
                out[p] = sets[begin[i] : begin[i + 1]].copy()
    return out


def run_small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, rows in by_key(batches, 1):
        sets = sets_of(rows)
        points = sorted(sets)
        links = join_region(points, [sets[p] for p in points])
        if links:
            u, v = zip(*links)
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])


def run_measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """region, chunk | pivot place or -1, point, text -> region, point, n, distances in the order of the pivots."""
    for (region, _), rows in by_key(batches, 2):
        sets = sets_of([r[1:] for r in rows])
        pivots = [p for _, p in sorted({(k, p) for k, p, _ in rows if k >= 0}) if p in sets]
        points = sorted({p for k, p, _ in rows if k < 0} & set(sets))
        out = []
        for p in points:
            row = []
            for q in pivots:
                common = overlap(sets[p], sets[q])
                n, m = len(sets[p]), len(sets[q])
                row.append((1 - common / (n + m - common), linked(common, n, m)))
            out.append(row)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([region] * len(points), pa.int64()), pa.array(points, pa.int64()), pa.array([pivots] * len(points), pa.list_(pa.int64())),
                pa.array([[d for d, _ in row] for row in out], pa.list_(pa.float64())), pa.array([[x for _, x in row] for row in out], pa.list_(pa.bool_())),
            ],
            ["region", "point", "pivots", "d", "near"],
        )


def run_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """region, cell, block, chunk | alone, point, part, d, text -> links between a cell's own documents and all others."""
    for _, rows in by_key(batches, 4):
        sets = sets_of([(r[1], r[4]) for r in rows])
        info = {r[1]: (r[2], np.array(r[3])) for r in rows}
        alone = sorted({r[1] for r in rows if r[0]} & set(sets))
        others = sorted({r[1] for r in rows if not r[0]} & set(sets))
        out, part = [], {p: info[p][0] for p in sets}
        if others:
            far, n = np.stack([info[p][1] for p in others]), np.array([len(sets[p]) for p in others])
        done = set()
        for p in alone if others else ():
            m = len(sets[p])
            ok = (4 * n >= 3 * m) & (4 * m >= 3 * n) & (np.abs(far - info[p][1]).max(axis=1) <= RADIUS + 1e-9)
            for i in np.flatnonzero(ok).tolist():
                q = others[i]
                # one link to each part of the region is enough
                if part[p] != part[q] and (p, part[q]) not in done and linked(overlap(sets[p], sets[q]), m, int(n[i])):
                    done.add((p, part[q]))
                    out.append((p, q))
        if out:
            u, v = zip(*out)
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])


def dealt(rows: DataFrame, texts: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Rows with the text of their representative, keys together and in order."""
    out = rows.join(texts, F.col("rep").eqNullSafe(F.col("__id"))).select(*keys, *columns, "__text")
    return out.repartition(*keys).sortWithinPartitions(*keys)


def links(docs: DataFrame, profiles: DataFrame, order: list[np.ndarray]) -> DataFrame:
    """(u, v): links between points that connect them just as all links do."""
    points = profiles.where("n_shingles > 0").groupBy("point").agg(F.min("doc_id").alias("rep"), F.max("need").alias("need"))
    members = regions_of(docs, profiles, points, order)
    texts = wanted_texts(docs, members)
    small = dealt(members.where(F.col("size") <= LEAF), texts, ["region"], ["point"]).mapInArrow(base.tidy(run_small), "u long, v long")
    small = base.stage(small, "jaccard-small")
    large = members.where(F.col("size") > LEAF)
    if large.isEmpty():
        return small
    # all documents of a large region against its pivots
    pick = F.expr("row_number() over (partition by region order by xxhash64(point), point)")
    pivots = large.select("region", "point", "rep", "size", pick.alias("k")).where(F.col("k") <= PIVOTS)
    chunks = F.ceil(F.col("size") / LEAF).cast("int")
    spread = pivots.select("region", F.explode(F.sequence(F.lit(0), chunks - 1)).alias("chunk"), "k", "point", "rep")
    rows = large.select("region", F.pmod(F.xxhash64("point", F.lit(1)), chunks).cast("int").alias("chunk"), F.lit(-1).alias("k"), "point", "rep").unionByName(spread)
    far = dealt(rows, texts, ["region", "chunk"], ["k", "point"]).mapInArrow(base.tidy(run_measure), "region long, point long, pivots array<long>, d array<double>, near array<boolean>")
    far = base.stage(far, "jaccard-measured")
    first = far.select("point", F.explode(F.arrays_zip("pivots", "near")).alias("x")).where("x.near").select(F.col("point").alias("u"), F.col("x.pivots").alias("v"))
    found = base.stage(small.union(first), "jaccard-links")
    # what is not in the largest component of its region has its cell joined
    part = components(found)
    own = far.join(part.select(F.col("node").alias("point"), F.col("root").alias("part")), "point", "left").withColumn("part", F.coalesce("part", "point"))
    own = base.stage(own.join(large.select("region", "point", "rep", "size"), ["region", "point"]), "jaccard-parts")
    main = own.groupBy("region", "part").agg(F.count(F.lit(1)).alias("n")).groupBy("region").agg(F.max_by("part", F.struct("n", "part")).alias("main"))
    own = own.join(main, "region").withColumn("alone", F.col("part") != F.col("main"))
    nearest = F.array_position("d", F.array_min("d")).cast("int") - 1
    alone = own.where("alone").withColumn("cell", nearest).withColumn("radius", F.array_min("d"))
    cells = alone.groupBy("region", "cell").agg(F.min("radius").alias("lo"), F.max("radius").alias("hi"), F.ceil(F.count(F.lit(1)) / LEAF).cast("int").alias("blocks"))
    cells = base.stage(cells, "jaccard-cells")
    if cells.isEmpty():
        return found
    total = F.ceil(F.col("size") / LEAF).cast("int")
    in_block = alone.join(cells, ["region", "cell"]).withColumn("block", F.pmod(F.xxhash64("point", F.lit(2)), F.col("blocks")).cast("int"))
    in_block = in_block.withColumn("chunk", F.explode(F.sequence(F.lit(0), total - 1))).withColumn("is_alone", F.lit(True))
    other = own.withColumn("chunk", F.pmod(F.xxhash64("point", F.lit(1)), total).cast("int"))
    other = other.join(cells, "region").where(F.expr(f"d[cell] between lo - {RADIUS} - 1e-9 and hi + {RADIUS} + 1e-9"))
    other = other.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn("is_alone", F.lit(False))
    names = ["region", "cell", "block", "chunk", "is_alone", "point", "part", "d", "rep"]
    rows = in_block.select(names).unionByName(other.select(names))
    more = dealt(rows, texts, names[:4], ["is_alone", "point", "part", "d"]).mapInArrow(base.tidy(run_cells), "u long, v long")
    return found.union(more)


def classified(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, point, root (a point of the same component), component_id."""
    order = frequent(docs)
    rows = base.stage(profile(docs, order), "jaccard-profiles")
    roots = components(links(docs, rows, order))
    points = rows.where("n_shingles > 0").groupBy("point").agg(F.min("doc_id").alias("least"))
    points = points.join(roots.select(F.col("node").alias("point"), "root"), "point", "left").withColumn("root", F.coalesce("root", "point"))
    points = base.stage(points, "jaccard-roots")
    smallest = points.groupBy("root").agg(F.min("least").alias("component_id"))
    named = base.stage(points.join(smallest, "root").select("point", "root", "component_id"), "jaccard-named")
    out = rows.join(named, "point", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", "point", "root", component.alias("component_id"))


def join(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id (the smallest doc_id reachable by links) of every
    document, with five-word shingles and a Jaccard similarity of 0.75 or more.

    Null texts and texts without words have an empty set and link with nothing; a null
    doc_id counts for no smallest id unless all are null; repeated rows are points of one set
    and keep a row each; an empty table gives none. Sets are told apart by 64-bit numbers.
    """
    return classified(docs).select("doc_id", "n_shingles", "component_id")


def with_point(rows: DataFrame, bits: np.ndarray) -> DataFrame:
    """(row, doc_id, text) with the number of each text's set and whether it is in a filter."""
    sent = rows.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, col in base.passes(b.column(2)):
                point = signatures(*scan.shingle_sets(col, SIZE)).view(np.int64)
                yield base.frame_of(b.slice(lo, len(col)).select([0, 1]), point=point, maybe=in_filter(sent.value, point) & (point != 0))

    schema = StructType([*rows.drop("text").schema.fields, StructField("point", LongType()), StructField("maybe", BooleanType())])
    return rows.mapInArrow(base.tidy(run), schema)


def representatives(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of linked documents: that with the smallest doc_id
    (null last), then set number, then row. Documents with an empty set all stay.

    Only texts whose set has rows to drop (and few others, by a filter of bounded size) are
    shuffled to the join with what stays; all others pass. Rows travel as one struct, so other
    columns may have any names."""
    found = base.stage(classified(docs).where("n_shingles > 0").groupBy("root", "point", "doc_id").agg(F.count(F.lit(1)).alias("times")), "jaccard-found")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "point", "times")).alias("x")
    groups = found.groupBy("root").agg(first, F.count(F.lit(1)).alias("n"))
    chosen = base.stage(groups.select("root", F.col("x.doc_id").alias("id"), F.col("x.point").alias("kept"), F.col("x.times").alias("times"), "n"), "jaccard-chosen")
    mixed = chosen.where((F.col("n") > 1) | (F.col("times") > 1))
    dropping = found.join(mixed.select("root"), "root", "left_semi").select("point").distinct()
    rows = with_point(base.packed(docs, "doc_id", "text"), filter_bits(dropping, F.col("point"), dropping.count()))
    stay = chosen.select("id", "kept", "times")
    held = rows.where("maybe").join(stay, (F.col("point") == F.col("kept")) & F.col("doc_id").eqNullSafe(F.col("id")))
    once = held.where("times = 1").select("row")
    again = held.where("times > 1").groupBy("point", "id").agg(F.min("row").alias("row")).select("row")
    return base.unpacked(rows.where("not maybe").select("row").unionByName(once).unionByName(again), docs.columns)
