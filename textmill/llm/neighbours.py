"""Embedding near-duplicates by NN-descent, completed exactly.

Equal vectors of one label are one point. Every point gets a short neighbour list from a few
sorted random projections; then neighbours of neighbours are joined, again and again, and a
point keeps the nearest it has met. A list that is full of links is saturated and doubles.
Recall is audited against a brute-force search of a sample, and other projections and more
rounds follow while it is short. The listed pairs whose cosine in double precision reaches the
threshold are the edges that are kept; their components are groups.

Lists cannot hold all links of a dense group, and in 64 dimensions without structure they miss
rare pairs. So what they leave open is settled by the triangle inequality of angles: two points
of different groups can only link if the angle between the groups' first points is at most
that of the threshold and both radii. Only such groups are compared, in blocks, and each large
group with itself; a point without edges is a group of radius 0.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textmill.llm import base
from textmill.llm.components import components
from textmill.llm.jaccard import by_key

TABLES, BESIDE = 6, 4  # sorted projections, and neighbours on either side in each
K, K_MOST = 10, 40  # lengths of a list at first and at most
ROUNDS, SEEDS = 4, 2  # of neighbours of neighbours, for each set of projections
AUDITED = 400  # points that the audit searches by brute force
BLOCK_BYTES = 8 << 20  # of vectors in a block
STRIP = 1 << 20  # cosines held at a time
SLACK = 1e-5  # radians that rounding may cost a bound


def vectors(df: DataFrame, vec_id: str, embedding: str, label: str) -> DataFrame:
    """(vec_id, node, grp, embedding): node is the number of a point, null for vectors that
    link with nothing; only points of one grp (label and length) are compared."""
    e = F.col("e")
    rows = df.select(F.col(vec_id).alias("vec_id"), F.col(embedding).cast("array<double>").alias("e"), F.col(label).cast("string").alias("l"))
    sound = F.forall("e", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("e", lambda x: x != 0)
    valid = F.coalesce(F.col("l").isNotNull() & e.isNotNull() & sound, F.lit(False))
    return rows.select(
        "vec_id", F.when(valid, F.xxhash64("l", "e")).alias("node"), F.when(valid, F.xxhash64("l", F.size("e"))).alias("grp"), F.when(valid, e).alias("e"))


def units(e: pa.Array) -> list[np.ndarray]:
    out = []
    for row in e.to_pylist():
        x = np.array(row, np.float64)
        x = x / np.abs(x).max()
        out.append(x / np.sqrt((x * x).sum()))
    return out


def points_of(rows: DataFrame) -> DataFrame:
    """(node, grp, weight, x, q): the unit vector in double and in half precision."""
    classes = rows.where("node is not null").groupBy("node").agg(F.first("grp").alias("grp"), F.count(F.lit(1)).alias("weight"), F.first("e").alias("e"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = units(b.column(3))
            yield base.frame_of(b.select([0, 1, 2]), x=pa.array([v.tobytes() for v in x], pa.binary()), q=pa.array([v.astype(np.float16).tobytes() for v in x], pa.binary()))

    return classes.mapInArrow(base.tidy(run), "node long, grp long, weight long, x binary, q binary")


def matrix(raw: list[bytes], kind=np.float16) -> np.ndarray:
    return np.frombuffer(b"".join(raw), kind).reshape(len(raw), -1).astype(np.float32 if kind == np.float16 else kind)


def pairs_batch(u, v, s) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64()), pa.array(s, pa.float32())], ["u", "v", "sim"])


PAIRS = "u long, v long, sim float"


def beside(points: DataFrame, seed: int) -> DataFrame:
    """Neighbour candidates: points next to each other when a group is sorted by the signs of
    random projections, for TABLES such orders. Ranges of the order are dealt out, so one
    group may hold most points."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw, out = b.column(2).to_pylist(), {"t": [], "code": []}
            sizes = np.array([len(x) for x in raw])
            codes = np.zeros((len(raw), TABLES), np.int64)
            for n in np.unique(sizes):
                at = np.flatnonzero(sizes == n)
                x = matrix([raw[i] for i in at])
                planes = np.random.default_rng([seed, int(n)]).normal(size=(x.shape[1], TABLES * 24)).astype(np.float32)
                bits = (x @ planes > 0).reshape(len(at), TABLES, 24)
                codes[at] = bits @ (1 << np.arange(23, -1, -1))
            for t in range(TABLES):
                out["t"].append(np.full(len(raw), t, np.int32))
                out["code"].append(codes[:, t])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out["t"])), *(pa.concat_arrays([b.column(i)] * TABLES) for i in (1,)), pa.array(np.concatenate(out["code"])), pa.concat_arrays([b.column(0)] * TABLES), pa.concat_arrays([b.column(2)] * TABLES)], ["t", "grp", "code", "node", "q"])

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tail = None
        for b in batches:
            if tail is not None:
                b = pa.Table.from_batches([tail, b]).combine_chunks().to_batches()[0]
            key = b.column(0).to_numpy().astype(np.int64) * 31 + b.column(1).to_numpy()
            node, raw = b.column(3).to_numpy(), b.column(4).to_pylist()
            cut = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]]))
            for lo, hi in zip(cut, cut[1:]):
                x = matrix(raw[lo:hi])
                for k in range(1, min(BESIDE + 1, hi - lo)):
                    s = np.einsum("ij,ij->i", x[:-k], x[k:])
                    u, v = node[lo : hi - k], node[lo + k : hi]
                    ok = u != v
                    yield pairs_batch(np.concatenate([u[ok], v[ok]]), np.concatenate([v[ok], u[ok]]), np.concatenate([s[ok], s[ok]]))
            tail = b.slice(max(0, len(b) - BESIDE))

    rows = points.select("node", "grp", "q").mapInArrow(base.tidy(code), "t int, grp long, code long, node long, q binary")
    parts = max(points.sparkSession.sparkContext.defaultParallelism, int(points.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = rows.repartitionByRange(parts, "t", "grp", "code", "node").sortWithinPartitions("t", "grp", "code", "node")
    return rows.mapInArrow(base.tidy(near), PAIRS)


def nearest(pairs: DataFrame, sizes: DataFrame | None = None) -> DataFrame:
    """The best of each list: K, or the size that ``sizes`` (node, k) gives a point."""
    best = pairs.groupBy("u", "v").agg(F.max("sim").alias("sim"))
    rank = F.row_number().over(Window.partitionBy("u").orderBy(F.desc("sim"), "v"))
    if sizes is None:
        return best.withColumn("r", rank).where(F.col("r") <= K)
    ranked = best.withColumn("r", rank).where(F.col("r") <= K_MOST)
    return ranked.join(sizes.select(F.col("node").alias("u"), "k"), "u", "left").where(F.col("r") <= F.coalesce("k", F.lit(K))).drop("k")


def descend(lists: DataFrame, points: DataFrame, sizes: DataFrame) -> DataFrame:
    """Pairs from joining the neighbours of every point with each other, as far as they
    would improve a list. Of the points that list a centre, its nearest as many as its own
    list holds take part."""
    size = sizes.select(F.col("node").alias("v"), F.col("k"))
    back = lists.withColumn("b", F.row_number().over(Window.partitionBy("v").orderBy(F.desc("sim"), "u")))
    back = back.where(F.col("b") <= K_MOST).join(size, "v", "left").where(F.col("b") <= F.coalesce("k", F.lit(K)))
    around = lists.select(F.col("u").alias("c"), F.col("v").alias("node")).union(back.select(F.col("v").alias("c"), F.col("u").alias("node")))
    around = around.union(points.select(F.col("node").alias("c"), "node")).distinct()
    worst = lists.groupBy(F.col("u").alias("node")).agg(F.min("sim").alias("worst"), F.count(F.lit(1)).alias("n"))
    worst = worst.join(sizes, "node", "left").select("node", F.when(F.col("n") >= F.coalesce("k", F.lit(K)), F.col("worst")).otherwise(F.lit(-2.0)).cast("float").alias("worst"))
    info = base.stage(points.select("node", "q").join(worst, "node", "left"), "nn-info")
    rows = around.join(info, "node").select("c", "node", "worst", "q").repartition("c").sortWithinPartitions("c")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        us, vs, ss, held = [], [], [], 0
        for _, members in by_key(batches, 1):
            node = np.array([m[0] for m in members])
            worst = np.array([-2.0 if m[1] is None else m[1] for m in members], np.float32)
            x = matrix([m[2] for m in members])
            s = x @ x.T
            np.fill_diagonal(s, -3)
            i, j = np.nonzero(s > worst[:, None] + 1e-6)
            us.append(node[i])
            vs.append(node[j])
            ss.append(s[i, j])
            held += len(i)
            if held > 200_000:
                yield _met(us, vs, ss)
                us, vs, ss, held = [], [], [], 0
        if held:
            yield _met(us, vs, ss)

    return rows.mapInArrow(base.tidy(run), PAIRS)


def _met(us: list, vs: list, ss: list) -> pa.RecordBatch:
    """The pairs met, each once."""
    u, v, s = np.concatenate(us), np.concatenate(vs), np.concatenate(ss)
    order = np.lexsort((v, u))
    u, v, s = u[order], v[order], s[order]
    first = np.concatenate([[True], (u[1:] != u[:-1]) | (v[1:] != v[:-1])])
    return pairs_batch(u[first], v[first], s[first])


def exact_links(pairs: DataFrame, points: DataFrame, threshold: float) -> DataFrame:
    """(u, v), u < v: the pairs whose cosine in double precision reaches the threshold."""
    near = pairs.where(F.col("sim") >= threshold - 0.01).select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
    x = points.select("node", "x")
    rows = near.join(x.select(F.col("node").alias("u"), F.col("x").alias("a")), "u").join(x.select(F.col("node").alias("v"), F.col("x").alias("b")), "v").select("u", "v", "a", "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            u, v = b.column(0).to_numpy(), b.column(1).to_numpy()
            a, c = b.column(2).to_pylist(), b.column(3).to_pylist()
            ok = np.array([np.frombuffer(p).dot(np.frombuffer(q)) >= threshold for p, q in zip(a, c)], bool)
            yield pa.RecordBatch.from_arrays([pa.array(u[ok]), pa.array(v[ok])], ["u", "v"])

    return rows.mapInArrow(base.tidy(run), "u long, v long")


def audit(links: DataFrame, points: DataFrame, threshold: float) -> tuple[int, int]:
    """(links, links found) of the AUDITED points with the smallest hashes, which are compared
    with all points of their label by brute force."""
    chosen = points.orderBy(F.xxhash64("node", F.lit(5)), "node").limit(AUDITED).select("node", "grp", "x").collect()
    by_grp: dict[int, tuple] = {}
    for g in {r["grp"] for r in chosen}:
        own = [r for r in chosen if r["grp"] == g]
        by_grp[g] = (np.array([r["node"] for r in own]), matrix([bytes(r["x"]) for r in own], np.float64))
    sent = points.sparkSession.sparkContext.broadcast(by_grp)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            node, grp, raw = b.column(0).to_numpy(), b.column(1).to_numpy(), b.column(2)
            for g, (ids, x) in sent.value.items():
                at = np.flatnonzero(grp == g)
                if len(at):
                    s = matrix(raw.take(pa.array(at)).to_pylist(), np.float64) @ x.T
                    i, j = np.nonzero(s >= threshold)
                    u, v = node[at[i]], ids[j]
                    ok = u != v
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(u, v)[ok]), pa.array(np.maximum(u, v)[ok])], ["u", "v"])

    true = points.select("node", "grp", "x").mapInArrow(base.tidy(run), "u long, v long").distinct()
    r = true.join(links.withColumn("found", F.lit(1)), ["u", "v"], "left").agg(F.count(F.lit(1)).alias("n"), F.count("found").alias("found")).first()
    return r["n"], r["found"]


def graph(points: DataFrame, threshold: float, recall: float) -> DataFrame:
    """(u, v): the edges of the neighbour graph that reach the threshold. The descent ends when a
    round changes little and no list has grown; the audit asks for other projections and more
    rounds, SEEDS times in all."""
    n = points.count()
    sizes = base.stage(points.select("node", F.lit(K).alias("k")), "nn-sizes")
    lists, links = None, None
    for seed in range(SEEDS):
        more = beside(points, seed)
        lists = base.stage(nearest(more if lists is None else lists.select("u", "v", "sim").union(more), sizes), "nn-lists")
        for _ in range(ROUNDS):
            met = base.stage(descend(lists, points, sizes), "nn-met")
            fresh = met.join(lists.select("u", "v"), ["u", "v"], "left_anti").count()
            lists = base.stage(nearest(lists.select("u", "v", "sim").union(met), sizes), "nn-lists")
            full = lists.where(F.col("sim") >= threshold).groupBy(F.col("u").alias("node")).agg(F.count(F.lit(1)).alias("n"))
            longer = (F.col("n") >= F.col("k")) & (F.col("k") < K_MOST)
            grown = sizes.join(full, "node", "left").select("node", F.when(longer, F.col("k") * 2).otherwise(F.col("k")).alias("k"), F.coalesce(longer, F.lit(False)).alias("longer"))
            sizes = base.stage(grown, "nn-sizes")
            if fresh < 0.01 * n * K and sizes.where("longer").isEmpty():
                break
            sizes = sizes.drop("longer")
        sizes = sizes.select("node", "k")
        links = base.stage(exact_links(lists, points, threshold), "nn-links")
        true, found = audit(links, points, threshold)
        if found >= recall * true:
            break
    return links


def dealt(rows: DataFrame) -> DataFrame:
    """Rows (grp, node, weight, x) for every pair of blocks of a group: grp, i, j, first (of the
    i-th block), node, weight, x, pairs of blocks together. A row goes to as many pairs as its
    group has blocks."""
    rows = rows.withColumn("room", F.greatest(F.lit(1), F.lit(BLOCK_BYTES) / F.octet_length("x")))
    size = rows.groupBy("grp").agg(F.ceil(F.count(F.lit(1)) / F.min("room")).cast("int").alias("blocks"))
    rows = rows.join(size, "grp").withColumn("own", F.pmod(F.xxhash64("node", F.lit(3)), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    keys = ["grp", "i", "j"]
    rows = rows.select("grp", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), (F.col("own") <= F.col("other")).alias("first"), "node", "weight", "x")
    return rows.repartition(*keys).sortWithinPartitions(*keys)


def in_pairs(rows: DataFrame, work: Callable, schema: str) -> DataFrame:
    """``work(a, b, same)`` on the (node, weight, x) of every pair of blocks; it gives columns."""
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, i, j), some in by_key(batches, 3):
            a = [r[1:] for r in some if r[0]]
            b = a if i == j else [r[1:] for r in some if not r[0]]
            if a and b:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in work(a, b, i == j)], names)

    return rows.mapInArrow(base.tidy(run), schema)


LINKED = "u long, v long, linked long"  # linked 0: a link; over 0: the weight of the others linked with u


def counted(threshold: float) -> Callable:
    def work(a: list[tuple], b: list[tuple], same: bool) -> tuple:
        node, n, links = compare(a, b, same, threshold)
        u, v = np.array(links, np.int64).reshape(-1, 2).T
        return np.concatenate([node, u]), np.concatenate([node, v]), np.concatenate([n, np.zeros(len(links), np.int64)])

    return work


def compare(a: list[tuple], b: list[tuple], same: bool, threshold: float) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int]]]:
    """Of two blocks of (node, weight, x), or one with itself: the points that have links, the
    weight each is linked with, and at most a link less than points that connect them."""
    x, y = matrix([r[2] for r in a], np.float64), matrix([r[2] for r in b], np.float64)
    node = np.array([r[0] for r in a] + ([] if same else [r[0] for r in b]), np.int64)
    wa, wb = np.array([r[1] for r in a], np.int64), np.array([r[1] for r in b], np.int64)
    shift = 0 if same else len(a)
    n, root, links = np.zeros(len(node), np.int64), np.arange(len(node)), []
    x4, y4 = x.astype(np.float32), y.astype(np.float32)
    slack = (x.shape[1] + 8) * 1.2e-7  # more than single precision can be wrong by
    step = max(1, STRIP // len(b))
    for lo in range(0, len(a), step):
        s = x4[lo : lo + step] @ y4.T
        r, c = np.nonzero(s >= threshold - slack)
        unsure = np.flatnonzero(s[r, c] < threshold + slack)
        ok = np.ones(len(r), bool)
        for k in range(0, len(unsure), 4096):
            at = unsure[k : k + 4096]
            ok[at] = np.einsum("ij,ij->i", x[lo + r[at]], y[c[at]]) >= threshold
        r = r + lo
        ok &= (r != c) | (not same)
        r, c = r[ok], c[ok]
        n[: len(a)] += np.bincount(r, wb[c], len(a)).astype(np.int64)
        if not same:
            n[shift:] += np.bincount(c, wa[r], len(b)).astype(np.int64)
        cut = np.flatnonzero(np.concatenate([[True], r[1:] != r[:-1], [True]])) if len(r) else []
        for p, q in zip(cut, cut[1:]):
            i, js = int(r[p]), c[p:q] + shift
            apart = js[root[js] != root[i]]
            if len(apart):
                parts, first = np.unique(root[apart], return_index=True)
                links += [(int(node[i]), int(node[j])) for j in apart[first]]
                root[np.isin(root, parts)] = root[i]
    held = np.flatnonzero(n)
    return node[held], n[held], links


def near_groups(threshold: float) -> Callable:
    """Of two blocks of groups (first point, radius, its vector): (u, v, sure), the pairs that may hold a link;
    sure: both are single points and link."""
    angle = float(np.arccos(threshold))

    def work(a: list[tuple], b: list[tuple], same: bool) -> tuple:
        x, y = matrix([r[2] for r in a], np.float64), matrix([r[2] for r in b], np.float64)
        ra, rb = np.array([r[1] for r in a]), np.array([r[1] for r in b])
        x4, y4 = x.astype(np.float32), y.astype(np.float32)
        slack = (x.shape[1] + 8) * 1.2e-7
        # two blocks may have no near pair at all
        us, vs, sure = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, bool)]
        step = max(1, STRIP // len(b))
        for lo in range(0, len(a), step):
            s, wide = x4[lo : lo + step] @ y4.T, ra[lo : lo + step].max() + rb.max()
            # first by the widest radii, then by each pair's own
            r, c = np.nonzero(s >= np.cos(min(angle + wide + SLACK, np.pi)) - slack)
            for k in range(0, len(r), STRIP):
                p, q = r[k : k + STRIP], c[k : k + STRIP]
                reach = ra[lo + p] + rb[q]
                ok = s[p, q] >= np.cos(np.minimum(angle + reach + SLACK, np.pi)) - slack
                if same:
                    ok &= lo + p < q
                p, q, reach = lo + p[ok], q[ok], reach[ok]
                one = np.flatnonzero(reach == 0)
                good = np.ones(len(p), bool)
                for m in range(0, len(one), 4096):
                    at = one[m : m + 4096]
                    good[at] = np.einsum("ij,ij->i", x[p[at]], y[q[at]]) >= threshold
                us.append(p[good])
                vs.append(q[good])
                sure.append(reach[good] == 0)
        u, v = np.concatenate(us), np.concatenate(vs)
        na, nb = np.array([r[0] for r in a], np.int64), np.array([r[0] for r in b], np.int64)
        return na[u], nb[v], np.concatenate(sure)

    return work


def groups_of(points: DataFrame, links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(members: node, root, grp, weight, x; groups: grp, node (the root), weight (its radius, the
    greatest angle from the root's vector), size, x)."""
    roots = components(links)
    members = base.stage(points.select("node", "grp", "weight", "x").join(roots, "node"), "nn-members")
    first = points.select(F.col("node").alias("root"), F.col("x").alias("y"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, y = b.column(1).to_pylist(), b.column(2).to_pylist()
            s = np.array([np.frombuffer(p).dot(np.frombuffer(q)) for p, q in zip(x, y)], np.float64)
            # a little more than the angle, however it is rounded
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.arccos(np.clip(s, -1, 1)) + SLACK)], ["root", "angle"])

    angles = members.select("root", "x").join(first, "root").mapInArrow(base.tidy(run), "root long, angle double")
    radius = angles.groupBy(F.col("root").alias("node")).agg(F.max("angle").alias("radius"), F.count(F.lit(1)).alias("size"))
    alone = points.join(roots.select("node"), "node", "left_anti").select("node", F.lit(0.0).alias("radius"), F.lit(1).cast("long").alias("size"))
    every = points.select("grp", "node", "x").join(radius.unionByName(alone), "node")
    return members, base.stage(every.select("grp", "node", F.col("radius").alias("weight"), "size", "x"), "nn-groups")


def between(points: DataFrame, members: DataFrame, pairs: DataFrame, sizes: DataFrame, threshold: float) -> DataFrame:
    """The links between the groups of every pair: the larger one's blocks against blocks of all
    its partners' members."""
    a, b = (sizes.select(F.col("node").alias(c), F.col("size").alias(f"{c}_size")) for c in ("u", "v"))
    both = pairs.join(a, "u").join(b, "v")
    larger = (F.col("u_size") > F.col("v_size")) | ((F.col("u_size") == F.col("v_size")) & (F.col("u") < F.col("v")))
    both = both.select(F.when(larger, F.col("u")).otherwise(F.col("v")).alias("big"), F.when(larger, F.col("v")).otherwise(F.col("u")).alias("root")).distinct()
    both = base.stage(both, "nn-partners")
    # single points are groups that no member row tells
    every = members.select("node", "root", "weight", "x").unionByName(points.join(members.select("node"), "node", "left_anti").select("node", F.col("node").alias("root"), "weight", "x"))
    room = F.greatest(F.lit(1), F.lit(BLOCK_BYTES) / F.octet_length("x"))
    left = every.join(both.select(F.col("big").alias("root")).distinct(), "root").select(F.col("root").alias("big"), "node", "weight", "x", room.alias("room"))
    right = every.join(both, "root").select("big", "node", "weight", "x", room.alias("room"))
    blocks = lambda rows, name: rows.groupBy("big").agg(F.ceil(F.count(F.lit(1)) / F.min("room")).cast("int").alias(name))
    count = base.stage(blocks(left, "na").join(blocks(right, "nb"), "big"), "nn-blocks")
    own = lambda n: F.pmod(F.xxhash64("node", F.lit(3)), F.col(n)).cast("int")
    dealt_to = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = left.join(count, "big").withColumn("i", own("na")).withColumn("j", dealt_to("nb")).withColumn("first", F.lit(True))
    right = right.join(count, "big").withColumn("j", own("nb")).withColumn("i", dealt_to("na")).withColumn("first", F.lit(False))
    names = ["big", "i", "j", "first", "node", "weight", "x"]
    rows = left.select(names).unionByName(right.select(names)).repartition(*names[:3]).sortWithinPartitions(*names[:3])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = counted(threshold)
        for _, some in by_key(batches, 3):
            a, b = [r[1:] for r in some if r[0]], [r[1:] for r in some if not r[0]]
            if a and b:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in work(a, b, False)], ["u", "v", "linked"])

    return rows.mapInArrow(base.tidy(run), LINKED)


def all_links(points: DataFrame, threshold: float, recall: float) -> tuple[DataFrame, DataFrame]:
    """(node, linked): the weight of the others linked with each point that has a link; and
    (u, v): links that connect the points just as all links do."""
    edges = graph(points, threshold, recall)
    members, groups = groups_of(points, edges)
    inside = members.select(F.col("root").alias("grp"), "node", "weight", "x")
    inside = base.stage(in_pairs(dealt(inside), counted(threshold), LINKED), "nn-inside")
    near = base.stage(in_pairs(dealt(groups), near_groups(threshold), "u long, v long, sure boolean"), "nn-near")
    pairs, sure = near.where("not sure").select("u", "v"), near.where("sure").select("u", "v")
    across = base.stage(between(points, members, pairs, groups.select("node", "size"), threshold), "nn-across")
    weight = points.select(F.col("node").alias("v"), F.col("weight").alias("linked"))
    single = sure.unionByName(sure.select(F.col("v").alias("u"), F.col("u").alias("v"))).join(weight, "v").select("u", "linked")
    found = inside.unionByName(across)
    counts = found.where("linked > 0").select("u", "linked").unionByName(single).groupBy(F.col("u").alias("node")).agg(F.sum("linked").alias("linked"))
    links = edges.select("u", "v").unionByName(found.where("linked = 0").select("u", "v")).unionByName(sure)
    return base.stage(counts, "nn-counts"), base.stage(links.distinct(), "nn-all-links")


def near_duplicates(df: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label", threshold: float = 0.93, recall: float = 0.95) -> DataFrame:
    """vec_id, n_links (other vectors linked directly), component_id (smallest vec_id
    reachable), kept (vec_id = component_id) of every vector.

    Vectors are compared within a label only. Null labels, null, empty or zero vectors and
    such with null or non-finite components link with nothing; vectors of unequal length are
    not compared; equal vectors and repeated rows are all linked with each other; an empty
    table gives no rows."""
    rows = base.stage(vectors(df, vec_id, embedding, label), "nn-rows")
    counts, links = all_links(base.stage(points_of(rows), "nn-points"), threshold, recall)
    roots = components(links)
    own = rows.where("node is not null").groupBy("node").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("weight"))
    own = own.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")).join(counts, "node", "left")
    own = base.stage(own, "nn-own")
    named = own.join(own.groupBy("root").agg(F.min("least").alias("component_id")), "root")
    named = base.stage(named.select("node", "component_id", (F.coalesce("linked", F.lit(0)) + F.col("weight") - 1).alias("n_links")), "nn-named")
    out = rows.join(named, "node", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
