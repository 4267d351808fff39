"""E3 with large dictionaries: a trie of words instead of a join of all n-grams.

The names of a dictionary become a trie: a node for every distinct prefix of words. It is sent to the
executors as sorted arrays, in shards of a bounded number of names, dealt out by their first word;
a dictionary of more names takes a pass over the texts for each shard. In a batch of texts
all places walk down the trie together, a word at a time, and only those that are still on the
way to a name go on. Nothing but matches leaves a task, so neither a frequent first word nor a frequent name
meets in one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.operators.entities import truncate_chars

#: Names of a dictionary that one pass over the texts looks for.
SHARD_NAMES = 1_000_000


@dataclass
class Trie:
    """words: the distinct words of all names. step: sorted (node * len(words) + word), child: the
    node it leads to; node 0 is the root. labels: of each node, those of the names that end there."""

    words: pa.Array
    step: np.ndarray
    child: np.ndarray
    labels: dict[int, list[str]]
    ends: np.ndarray
    depth: int


def trie(names: list[tuple[str, str]]) -> Trie:
    """Of (name, label), the words of a name parted by one blank."""
    ids: dict[str, int] = {}
    split = [([ids.setdefault(w, len(ids)) for w in name.split(" ")], label) for name, label in names]
    steps: dict[int, int] = {}
    labels: dict[int, list[str]] = {}
    for own, label in split:
        node = 0
        for w in own:
            node = steps.setdefault(node * len(ids) + w, len(steps) + 1)
        labels.setdefault(node, []).append(label)
    key = np.fromiter(steps.keys(), np.int64, len(steps))
    order = np.argsort(key)
    ends = np.zeros(len(steps) + 1, bool)
    ends[list(labels)] = True
    return Trie(pa.array(ids, pa.string()), key[order], np.fromiter(steps.values(), np.int64, len(steps))[order], labels, ends, max((len(own) for own, _ in split), default=0))


def walk(t: Trie, words: pa.Array, row: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(places, nodes, words) of the names found in a sequence of lower-case words, which ``row``
    parts into texts."""
    word = pc.fill_null(pc.index_in(words, value_set=t.words), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    at, node = np.flatnonzero(word >= 0), 0
    for depth in range(1, t.depth + 1):
        last = at + depth - 1
        key = node * len(t.words) + word[last]
        i = np.minimum(np.searchsorted(t.step, key), len(t.step) - 1)
        on = t.step[i] == key
        at, node = at[on], t.child[i[on]]
        end = np.flatnonzero(t.ends[node])
        if len(end):
            yield at[end], node[end], depth
        more = at + depth < len(word)
        at, node = at[more], node[more]
        more = (row[at] == row[at + depth]) & (word[at + depth] >= 0)
        at, node = at[more], node[more]
        if not len(at):
            return


def extract_gazetteer(df: DataFrame, gazetteer: DataFrame, text_col: str = "text", key: str = "doc_id", max_chars: int | None = None,
                      shard_names: int = SHARD_NAMES) -> DataFrame:
    """The rows of ``entities.extract_gazetteer`` (key, name, raw_label, pos: the place of the
    first word, from 1), for dictionaries of any size. Names that are not words of ASCII letters and
    digits parted by blanks match nothing; a null text has no words."""
    gz = gazetteer.select(F.lower(F.regexp_replace(F.trim("name"), " +", " ")).alias("k"), "raw_label").distinct()
    gz = gz.where(F.col("k").rlike("^[a-z0-9]+( [a-z0-9]+)*$"))
    shards = max(1, -(-gz.count() // shard_names))
    kind = dict(df.dtypes)[key]
    words = df.select(key, F.regexp_extract_all(truncate_chars(text_col, max_chars), F.lit("[A-Za-z0-9]+"), 0).alias("words"))
    out = None
    for shard in range(shards):
        mine = gz.where(F.pmod(F.xxhash64(F.split("k", " ")[0]), F.lit(shards)) == shard)
        sent = df.sparkSession.sparkContext.broadcast(trie([(r["k"], r["raw_label"]) for r in mine.collect()]))  # about shard_names rows

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            t = sent.value
            for b in batches:
                lists = b.column(1)
                flat = lists.flatten()
                if not len(flat) or not len(t.step):
                    continue
                size = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
                row, begin = np.repeat(np.arange(len(size)), size), np.cumsum(size) - size
                for at, node, depth in walk(t, pc.ascii_lower(flat), row):
                    many = [t.labels[n] for n in node.tolist()]
                    where = np.repeat(at, [len(x) for x in many])
                    parts = [flat.take(pa.array(where + k)) for k in range(depth)]
                    name = pc.binary_join_element_wise(*parts, " ") if depth > 1 else parts[0]
                    pos = where - begin[row[where]] + 1
                    yield pa.RecordBatch.from_arrays(
                        [b.column(0).take(pa.array(row[where])), name, pa.array([x for own in many for x in own], pa.string()), pa.array(pos.astype(np.int32))],
                        [key, "name", "raw_label", "pos"],
                    )

        found = words.mapInArrow(run, f"`{key}` {kind}, name string, raw_label string, pos int")
        out = found if out is None else out.unionAll(found)
    return out
