"""Periodic runs of words, found in a grammar.

Re-Pair replaces repeated pairs of neighbouring symbols of a document by new symbols, until no
pair repeats: a grammar whose last sequence stands for the whole text. A run lies inside the
lowest symbol that holds it and crosses the boundary between that symbol's two parts. So the
runs across each symbol's boundary are computed once, at one of its places, and moved to all
other places of the symbol; the last sequence is closed by a balanced tree of pairs, whose
boundaries are treated alike. Overlapping intervals of one period are merged.

Documents of a batch are worked on together, as arrays. In a round each document replaces its
most frequent pair and all others that do not touch a more frequent one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.llm import base, scan

#: Words that a run has at least. Of a run, at least half as many neighbouring words (6) equal those one period on.
LEAST = 12
#: Possible (boundary, period) pairs looked at in one go.
CHUNK = 1 << 20


@dataclass
class Grammar:
    """Symbols that Re-Pair made in a sequence of words, and what is left of the sequence.

    rule, at: symbol and first word of every place where a symbol was made. first, middle,
    last: per symbol, its first place, the boundary of its parts there, and its end.
    rest: the first words of the symbols in the last sequences, document by document."""

    rule: np.ndarray
    at: np.ndarray
    first: np.ndarray
    middle: np.ndarray
    last: np.ndarray
    rest: np.ndarray


def repair(ids: np.ndarray, doc: np.ndarray) -> Grammar:
    """Re-Pair over all documents at once; ``ids`` of different documents differ."""
    n = len(ids)
    sym, pos, end = ids.astype(np.int64), np.arange(n), np.arange(1, n + 1)  # end: word after the symbol
    of = doc
    live = np.ones(n, bool)  # pairs (by their left symbol) that may repeat
    fresh, rules = int(ids.max(initial=-1)) + 1, 0
    rule, at, bounds, rest = [], [], [], []
    while len(sym) > 1:
        live[-1] = False
        live[:-1] &= of[1:] == of[:-1]
        cand = np.flatnonzero(live)
        key = (sym[cand] << 32) | sym[cand + 1]
        # in a stretch of one symbol, every second pair
        again = np.zeros(len(cand), bool)
        again[1:] = (key[1:] == key[:-1]) & (cand[1:] == cand[:-1] + 1)
        if again.any():
            began = np.maximum.accumulate(np.where(again, 0, np.arange(len(cand))))
            even = (np.arange(len(cand)) - began) % 2 == 0
            odd, cand, key = cand[~even], cand[even], key[even]
        else:
            odd = cand[:0]
        order = np.argsort(key, kind="stable")
        head = np.ones(len(key), bool)
        head[1:] = key[order][1:] != key[order][:-1]
        begin = np.flatnonzero(head)
        count = np.diff(np.append(begin, len(key)))
        group = np.empty(len(key), np.int64)
        group[order] = np.cumsum(head) - 1
        often = count[group] > 1
        live[:] = False
        live[cand[often]] = True
        live[odd] = True  # they may pair otherwise once their neighbours are replaced
        # more frequent pairs first, then those that come first
        first = cand[order[begin]]
        rank = np.empty(len(count), np.int64)
        rank[np.lexsort((-first, count))] = np.arange(1, len(count) + 1)
        force = np.zeros(len(sym) + 1, np.int64)
        force[cand[often]] = rank[group[often]]
        taken = np.zeros(len(sym) + 1, bool)
        for _ in range(3):  # a pair is taken where both its neighbours are weaker
            win = force[:-1] > 0
            win[1:] &= force[:-2] < force[1:-1]
            win &= force[1:] < force[:-1]
            won = np.flatnonzero(win)
            if not len(won):
                break
            taken[won] = True
            force[won] = 0
            force[won + 1] = 0
            force[won[won > 0] - 1] = 0
        here = taken[cand]
        uses = np.bincount(group[here], minlength=len(count))
        here &= uses[group] > 1
        chosen, kinds = cand[here], group[here]
        if not len(chosen):
            break
        # new symbols, numbered by their first place
        made, where, number = np.unique(kinds, return_index=True, return_inverse=True)
        bounds.append((pos[chosen[where]], pos[chosen[where] + 1], end[chosen[where] + 1]))
        rule.append(rules + number)
        at.append(pos[chosen])
        sym[chosen] = fresh + number
        end[chosen] = end[chosen + 1]
        fresh, rules = fresh + len(made), rules + len(made)
        live[chosen] = True
        live[chosen[chosen > 0] - 1] = True
        stay = np.ones(len(sym), bool)
        stay[chosen + 1] = False
        # documents without a pair that may repeat are done
        busy = np.zeros(int(of[-1]) + 1, bool)
        busy[of[np.flatnonzero(live)]] = True
        done = stay & ~busy[of]
        rest.append(pos[done])
        stay &= ~done
        sym, pos, end, of, live = sym[stay], pos[stay], end[stay], of[stay], live[stay]
    rest.append(pos)
    join = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
    bound = [join([b[i] for b in bounds]) for i in range(3)]
    return Grammar(join(rule), join(at), *bound, np.sort(join(rest)))


class Extension:
    """How far two places of a sequence agree, to the right and to the left: the names of all
    stretches of 1, 2, 4 ... words, equal names for equal words, by doubling."""

    def __init__(self, ids: np.ndarray, doc: np.ndarray):
        longest = int(np.bincount(doc).max())
        self.names, size = [ids], 1
        while 2 * size <= longest:
            last = self.names[-1]
            m = len(ids) - 2 * size + 1
            key = (last[:m].astype(np.int64) << 32) | last[size : size + m]
            name = np.unique(key, return_inverse=True)[1].astype(np.int64)
            over = doc[:m] != doc[2 * size - 1 :]  # stretches over two documents equal nothing
            name[over] = len(ids) + np.flatnonzero(over)
            self.names.append(name)
            size *= 2

    def right(self, i: np.ndarray, j: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Words from i on that equal those from j on (i < j), at most ``most``."""
        got = np.zeros(len(i), np.int64)
        for k in range(len(self.names) - 1, -1, -1):
            name = self.names[k]
            a, b = i + got, j + got
            fits = (got + (1 << k) <= most) & (b < len(name))
            same = np.zeros(len(i), bool)
            same[fits] = name[a[fits]] == name[b[fits]]
            got[same] += 1 << k
        return got

    def left(self, i: np.ndarray, j: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Words before i that equal those before j (i < j), at most ``most``."""
        got = np.zeros(len(i), np.int64)
        for k in range(len(self.names) - 1, -1, -1):
            name = self.names[k]
            fits = got + (1 << k) <= most
            a, b = i - got - (1 << k), j - got - (1 << k)
            fits &= b < len(name)
            same = np.zeros(len(i), bool)
            same[fits] = name[a[fits]] == name[b[fits]]
            got[same] += 1 << k
        return got


def agreeing(ids: np.ndarray, left: np.ndarray, middle: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(node, i, j): equal words one possible period apart, for every node [left, right) and
    its boundary. A run across the boundary holds a period's words on one side of it: then the
    word behind the boundary equals one before it, or the word before it one behind. Six
    neighbouring words have to agree in any run."""
    n, half = len(ids), (right - left) // 2
    order = np.argsort(ids, kind="stable")
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    key = ids[order] * n + order
    behind, ahead = ids[middle] * n, ids[middle - 1] * n
    lo = np.concatenate([np.searchsorted(key, behind + np.maximum(left, middle - half)), place[middle - 1] + 1])
    hi = np.concatenate([place[middle], np.searchsorted(key, ahead + np.minimum(right, middle + half))])
    many, m = np.maximum(hi - lo, 0), len(middle)
    upto = np.cumsum(many)
    found, begin = [], 0
    while begin < 2 * m:
        stop = max(begin + 1, int(np.searchsorted(upto, (upto[begin - 1] if begin else 0) + CHUNK, "right")))
        own = np.repeat(np.arange(begin, stop), many[begin:stop])
        at = np.arange(len(own)) - np.repeat(upto[begin:stop] - many[begin:stop] - (upto[begin] - many[begin]), many[begin:stop])
        other, node = order[lo[own] + at], own % m
        earlier = own < m
        i = np.where(earlier, other, middle[node] - 1)
        j = np.where(earlier, middle[node], other)
        agree = np.ones(len(i), np.int64)
        for step in (1, -1):
            rows = np.arange(len(i))
            for k in range(1, LEAST // 2):
                a, b = i[rows] + step * k, j[rows] + step * k
                inside = (b < right[node[rows]]) & (a >= left[node[rows]])
                inside[inside] = ids[a[inside]] == ids[b[inside]]
                rows = rows[inside]
                agree[rows] += 1
        keep = agree >= LEAST // 2
        found.append((node[keep], i[keep], j[keep]))
        begin = stop
    return tuple(np.concatenate([f[k] for f in found]) if found else np.zeros(0, np.int64) for k in range(3))


def runs_of(ids: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(doc, start, stop, period) of all runs, places counted over the whole sequence, by
    document, start and period. Equal words of a document have equal ``ids``, words of
    different documents have not; ``doc`` rises."""
    none = tuple(np.zeros(0, np.int64) for _ in range(4))
    if len(ids) < LEAST:
        return none
    g = repair(ids, doc)
    # the balanced tree over each document's last sequence: the j-th symbol's boundary closes 2**t symbols on either side
    of = doc[g.rest]
    begin = np.flatnonzero(np.diff(of, prepend=-1))
    size = np.diff(np.append(begin, len(of)))
    first, size = np.repeat(begin, size), np.repeat(size, size)
    j = np.arange(len(of)) - first
    span = j & -j
    inner = j > 0
    starts = np.append(g.rest, len(ids))
    left = starts[(first + j - span)[inner]]
    right = starts[(first + np.minimum(j + span, size))[inner]]
    rules = len(g.first)
    left, middle, right = np.concatenate([g.first, left]), np.concatenate([g.middle, g.rest[inner]]), np.concatenate([g.last, right])
    wide = np.flatnonzero(right - left >= LEAST)
    node, i, k = agreeing(ids, left[wide], middle[wide], right[wide])
    if not len(node):
        return none
    node = wide[node]
    # extended exactly, in the documents that are concerned
    here = np.isin(doc, doc[i])
    moved = np.cumsum(here) - 1
    reach = Extension(np.unique(ids[here], return_inverse=True)[1].astype(np.int64), doc[here])
    start = i - reach.left(moved[i], moved[k], i - left[node])
    stop = k + reach.right(moved[i], moved[k], right[node] - k)
    period = k - i
    keep = stop - start >= np.maximum(LEAST, 2 * period)
    found = np.unique(np.stack([node[keep], start[keep], stop[keep], period[keep]]), axis=1)
    if not found.shape[1]:
        return none
    # a rule's runs at all places of the rule
    node, start, stop, period = found
    inside = node < rules
    by_rule = np.argsort(g.rule, kind="stable")
    places = np.bincount(g.rule, minlength=rules)
    offset = np.cumsum(places) - places
    many = places[node[inside]]
    own = np.repeat(np.flatnonzero(inside), many)
    at = g.at[by_rule[np.repeat(offset[node[inside]], many) + np.arange(len(own)) - np.repeat(np.cumsum(many) - many, many)]]
    shift = at - g.first[node[own]]
    start = np.concatenate([start[~inside], start[own] + shift])
    stop = np.concatenate([stop[~inside], stop[own] + shift])
    period = np.concatenate([period[~inside], period[own]])
    # intervals of one period that share all but a gap of less than nothing become one
    of = doc[start]
    order = np.lexsort((start, period, of))
    of, start, stop, period = of[order], start[order], stop[order], period[order]
    group = np.cumsum(np.concatenate([[0], (of[1:] != of[:-1]) | (period[1:] != period[:-1])]))
    base_of = group * (len(ids) + 1)
    reached = np.maximum.accumulate(stop - period + base_of)
    head = np.ones(len(start), bool)
    head[1:] = start[1:] + base_of[1:] > reached[:-1]
    tail = np.append(head[1:], True)
    of, start, period, stop = of[head], start[head], period[head], (reached - base_of)[tail] + period[tail]
    # of several periods of one interval the smallest
    order = np.lexsort((period, stop, start, of))
    of, start, stop, period = of[order], start[order], stop[order], period[order]
    least = np.ones(len(start), bool)
    least[1:] = (of[1:] != of[:-1]) | (start[1:] != start[:-1]) | (stop[1:] != stop[:-1])
    of, start, stop, period = of[least], start[least], stop[least], period[least]
    order = np.lexsort((period, start, of))
    return of[order], start[order], stop[order], period[order]


def detect(docs: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of every document: the runs as (start, length,
    period) in words, by start and period, and the words, joined by one blank, without those
    that a run holds after its first period.

    A run is a stretch of neighbouring words with smallest period q, at least 12 and 2 * q
    words long, that no neighbouring word continues. Words are runs of bytes that are not ASCII
    white space, compared exactly as they are. Null, empty and blank texts have no words, no
    runs and collapse to the empty text; repeated rows and null ids are worked on one by one;
    an empty table gives no rows. One document is worked on as a whole, in one task."""
    rows = docs.select("doc_id", F.col(text).cast("string").alias("text"))
    kind = dict(rows.dtypes)["doc_id"]
    run_type = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, col in base.passes(batch.column(1)):
                data, off = scan.flat(col)
                w = scan.words(data, off)
                ids = np.unique(scan.mix(w.hashes() + w.doc.astype(scan.U) * scan.STEP), return_inverse=True)[1].astype(np.int64)
                doc, start, stop, period = runs_of(ids, w.doc)
                first = np.concatenate([[0], np.cumsum(w.counts)])
                begin = np.searchsorted(doc, np.arange(w.n + 1))
                raw, collapsed = data.tobytes(), []
                for d in range(w.n):
                    words = raw[off[d] : off[d + 1]].split()
                    if begin[d] < begin[d + 1]:
                        gone = np.zeros(len(words) + 1, np.int64)
                        own = slice(begin[d], begin[d + 1])
                        np.add.at(gone, start[own] + period[own] - first[d], 1)
                        np.add.at(gone, stop[own] - first[d], -1)
                        words = [words[x] for x in np.flatnonzero(np.cumsum(gone)[:-1] == 0)]
                    collapsed.append(b" ".join(words))
                parts = [pa.array(x) for x in (start - first[doc], stop - start, period)]
                runs = pa.ListArray.from_arrays(pa.array(begin, pa.int32()), pa.StructArray.from_arrays(parts, fields=list(run_type)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, len(col)), pa.array(w.counts.astype(np.int64)), runs, pa.array(collapsed, pa.binary()).cast(pa.string())],
                    ["doc_id", "n_words", "runs", "collapsed"],
                )

    schema = f"doc_id {kind}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    return rows.mapInArrow(base.tidy(run), schema)
