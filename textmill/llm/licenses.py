"""License scans.

Templates are cut into word k-grams and winnowed: of every window of neighbouring k-grams the
smallest hash is a fingerprint, so any shared run of WINDOW + GRAM - 1 words shares one. The
fingerprints of all templates form an inverted index; a text's fingerprints in it name
candidates (template and place). A banded alignment of the template with the words around
gives the matched words, the coverage of the template and the matched spans: the band lies
around the diagonals (place in the text less place in the template) of the chained
fingerprints. The words around leave room for as many inserted words as twice the length of the
template. Words that tell a licence from its neighbours (a version, "Affero", "Lesser") have to
match, and of templates found over one another the best is reported.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.llm import base, scan

GRAM, WINDOW = 3, 3
ROOM = 16  # inserted words that even a short template may have on either side of a fingerprint
BAND = 16  # diagonals on either side of the chained ones
MATCH, SKIP = 20, 1  # what a matched word gains and a word inserted between matched ones costs

# The usual notices of these licences.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 "
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed "
        "on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License "
        "for the specific language governing permissions and limitations under the License."
    ),
    "MIT": "Released under the MIT License",
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
        "distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
        "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR "
        "PURPOSE ARE DISCLAIMED."
    ),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
        "distribution. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
        "promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY "
        "THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, "
        "THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED."
    ),
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2",
    "GPL-2.0-notice": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any "
        "later version."
    ),
    "LGPL-2.1-notice": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) "
        "any later version."
    ),
    "LGPL-3.0-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) "
        "any later version."
    ),
    "AGPL-3.0-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) "
        "any later version."
    ),
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "GPL-3.0-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version."
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    ),
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0",
    "CC-BY-SA-3.0": "Licensed under CC BY-SA 3.0",
    "CC-BY-3.0": "This work is licensed under a Creative Commons Attribution 3.0 Unported License",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}

#: Words that make another licence of a notice: in a template they must match, and they must not
#: stand between two of its matched words.
DECIDING = ("affero", "lesser", "library", "nc", "sa", "nd", "noncommercial", "sharealike", "noderivatives", "noderivs")

WORD_BYTE = np.zeros(256, bool)
for _a, _b in (("0", "9"), ("A", "Z"), ("a", "z")):
    WORD_BYTE[ord(_a) : ord(_b) + 1] = True
WORD_BYTE[0x80:] = True


def runs_of(col: pa.Array) -> tuple[scan.Runs, np.ndarray, np.ndarray]:
    """Words of letters and digits, their hashes in lower case, and where each text begins."""
    data, off = scan.flat(col)
    data = scan.LOWER[data]
    runs = scan.Runs(data, off, WORD_BYTE[data])
    return runs, runs.hashes(), off


def winnow(grams: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Places of the fingerprints: the last smallest hash of every WINDOW neighbouring k-grams
    of a text, or of all of them if there are fewer."""
    n = len(grams)
    if not n:
        return np.zeros(0, np.int64)
    best = np.arange(n)  # of the window that ends here, as far as it lies in the text
    for k in range(1, WINDOW):
        at = np.arange(k, n)
        at = at[doc[at] == doc[at - k]]
        better = grams[at - k] < grams[best[at]]
        best[at[better]] = at[better] - k
    begin = np.searchsorted(doc, doc, "left")
    last = np.searchsorted(doc, doc, "right") - 1
    whole = (np.arange(n) - begin >= WINDOW - 1) | (np.arange(n) == last)
    return np.unique(best[whole])


@dataclass
class Index:
    names: list[str]
    words: list[list[int]]
    grams: np.ndarray  # sorted fingerprints
    template: np.ndarray
    place: np.ndarray
    must: list[list[int]]  # places of a template's deciding words: its version, and DECIDING
    never: np.ndarray  # hashes of DECIDING


def index(templates: dict[str, str]) -> Index:
    names = sorted(templates)
    runs, h, _ = runs_of(pa.array([templates[x] for x in names], pa.string()))
    grams, at = scan.windows(h, runs.doc, GRAM)
    doc = runs.doc[at]
    begin = np.concatenate([[0], np.cumsum(runs.counts)])
    pick = winnow(grams, doc)
    order = pick[np.argsort(grams[pick], kind="stable")]
    words = [h[begin[i] : begin[i + 1]].tolist() for i in range(len(names))]
    never = runs_of(pa.array(DECIDING, pa.string()))[1]
    must = []
    for own, text in zip(words, (templates[x] for x in names)):
        plain = re.findall(r"[0-9A-Za-z\x80-\U0010ffff]+", text)  # the words of WORD_BYTE
        version = [k for k, x in enumerate(plain) if x.isdigit()][:1]  # the first number is that of the version
        must.append(sorted({*version, *(k for k, x in enumerate(own) if x in never)}))
    return Index(names, words, grams[order], doc[order], at[order] - begin[doc[order]], must, never)


def align(template: list[int], words: np.ndarray, low: int | None = None, high: int | None = None) -> list[tuple[int, int]]:
    """(place in template, place in words) of equal words in order, so that matches less
    inserted words score most; the earliest such alignment. Only places on the diagonals
    ``low`` to ``high`` (place in words less place in template) are looked at."""
    n = len(words)
    low, high = -len(template) if low is None else low, n if high is None else high
    # row i: best of the first i template words that ends at or before word j, for j from lo[i] on
    clip = lambda j: min(max(j, 0), n)
    lo, rows = [clip(low)], [np.zeros(clip(high) - clip(low) + 1, np.int64)]
    for i, t in enumerate(template, 1):
        a, z, prev, first = clip(i + low), clip(i + high), rows[-1], lo[-1]
        at = np.arange(a, z + 1)
        here = np.minimum(at - first, len(prev) - 1)
        row = np.maximum(prev[here] - (at - first - here) * SKIP, 0)
        hit = np.flatnonzero(words[max(a - 1, first) : min(z, first + len(prev))] == np.uint64(t)) + max(a - 1, first)
        row[hit + 1 - a] = np.maximum(row[hit + 1 - a], prev[hit - first] + MATCH)
        rows.append(np.maximum(np.maximum.accumulate(row + at * SKIP) - at * SKIP, 0))
        lo.append(a)
    out, i = [], len(template)
    j = int(rows[-1].argmax()) + lo[-1]
    while i and rows[i][j - lo[i]] > 0:
        value, prev, first = rows[i][j - lo[i]], rows[i - 1], lo[i - 1]
        before = min(j, first + len(prev) - 1)
        if value == prev[before - first] - (j - before) * SKIP:
            i, j = i - 1, before
        elif 0 <= j - 1 - first < len(prev) and words[j - 1] == template[i - 1] and value == prev[j - 1 - first] + MATCH:
            i, j = i - 1, j - 1
            out.append((i, j))
        else:
            j -= 1
    return out[::-1]


def occurrences(template: list[int], words: np.ndarray, hits: list[tuple[int, int]], least: float) -> list[list[tuple[int, int]]]:
    """The alignments (see ``align``) with the part ``least`` of the template, one after the
    other and none over another. hits: (place in words, place in template) of fingerprints."""
    room, need = max(ROOM, 2 * len(template)), least * len(template)

    def within(lo: int, hi: int) -> list[tuple[int, int]]:
        if hi - lo < need:
            return []
        # the diagonals of the fingerprints in this stretch; what lies before an occurrence may have
        # lost its fingerprint to it, and is aligned in full
        chain = [w - i - lo for w, i in hits[bisect_left(at, lo) : bisect_left(at, hi)]]
        band = (min(chain) - BAND, max(chain) + BAND) if chain else (None, None)
        pairs = [(i, w + lo) for i, w in align(template, words[lo:hi], *band)]
        return pairs if len(pairs) >= need else []

    out, taken, tried = [], 0, None
    at = [w for w, _ in hits]
    for k, (w, i) in enumerate(hits):
        span = max(taken, w - i - room), w - i + len(template) + room
        if w < taken or span == tried:
            continue
        tried = span
        if not (pairs := within(*span)):
            continue
        own, end = [], pairs[0][1]
        while rest := within(span[0], end):  # what lies before it
            own.append(rest)
            end = rest[0][1]
        out += own[::-1]
        begin, last = pairs[0][1], pairs[-1][1]
        later = k + 1 < len(at) and begin > w and at[bisect_left(at, begin, k + 1) :][:1]
        if later and later[0] <= last:
            taken = begin  # found again from its own fingerprint, with all of its room
        else:
            out.append(pairs)
            taken = last + 1
    return out


def decided(ix: Index, t: int, words: np.ndarray, pairs: list[tuple[int, int]]) -> bool:
    """Whether an alignment has all deciding words of its template, and none of another
    licence in a gap of a word or two."""
    if not set(ix.must[t]) <= {i for i, _ in pairs}:
        return False
    gaps = [range(w + 1, v) for (i, w), (k, v) in zip(pairs, pairs[1:]) if k == i + 1 and 1 < v - w <= 3]
    return not any(np.isin(words[gap.start : gap.stop], ix.never).any() for gap in gaps)


def best_of(found: list[tuple]) -> list[tuple]:
    """Of occurrences (template, pairs, coverage) that lie over one another for the greater part of one,
    those with the most matched words, then the greatest coverage, then the first template."""
    kept: list[tuple] = []
    for x in sorted(found, key=lambda x: (-len(x[1]), -x[2], x[0], x[1][0][1])):
        a, b = x[1][0][1], x[1][-1][1]
        if all(2 * (min(b, y[1][-1][1]) - max(a, y[1][0][1]) + 1) <= b - a + 1 for y in kept):
            kept.append(x)
    return sorted(kept, key=lambda x: (x[0], x[1][0][1]))


def matches(ix: Index, col: pa.Array, least: float) -> list[tuple]:
    """(text, template, matched, coverage, [first and end byte of each matched span]) of a column."""
    runs, h, off = runs_of(col)
    grams, at = scan.windows(h, runs.doc, GRAM)
    pick = winnow(grams, runs.doc[at])
    lo, hi = np.searchsorted(ix.grams, grams[pick], "left"), np.searchsorted(ix.grams, grams[pick], "right")
    begin = np.concatenate([[0], np.cumsum(runs.counts)])
    found: dict[tuple[int, int], list[int]] = {}
    for k in np.flatnonzero(hi > lo):
        first = at[pick[k]]
        doc = int(runs.doc[first])
        for m in range(lo[k], hi[k]):
            found.setdefault((doc, int(ix.template[m])), []).append((int(first - begin[doc]), int(ix.place[m])))
    out = []
    by_doc: dict[int, list[tuple]] = {}
    for (doc, t), hits in sorted(found.items()):
        words = h[begin[doc] : begin[doc + 1]]
        for pairs in occurrences(ix.words[t], words, sorted(hits), least):
            if decided(ix, t, words, pairs):
                by_doc.setdefault(doc, []).append((t, pairs, len(pairs) / len(ix.words[t])))
    for doc, own in by_doc.items():
        a = begin[doc]
        for t, pairs, coverage in best_of(own):
            spans = []
            for _, w in pairs:
                s, e = int(runs.start[a + w] - off[doc]), int(runs.start[a + w] + runs.length[a + w] - off[doc])
                if spans and spans[-1][2] == w - 1:
                    spans[-1][1:] = [e, w]
                else:
                    spans.append([s, e, w])
            out.append((doc, t, len(pairs), coverage, [(s, e) for s, e, _ in spans]))
    return out


def scan_licenses(docs: DataFrame, templates: dict[str, str] | None = None, least: float = 0.8) -> DataFrame:
    """One row for every occurrence of a template, the best one where several lie over one another: doc_id, license, matched (words), coverage
    (of the template), start and end (characters, of the whole occurrence) and spans (start
    and end of each stretch of matched words).

    An occurrence is reported from a coverage of ``least`` on. Null and empty texts have
    none; repeated rows give repeated rows; an empty table or no templates give none. The
    index is as large as the templates, which are a parameter, and is all that is sent out.
    """
    sent = docs.sparkSession.sparkContext.broadcast(index(TEMPLATES if templates is None else templates))
    rows = docs.select("doc_id", F.col("text").alias("__text"))
    span = "struct<start:bigint,end:bigint>"
    schema = rows.select("doc_id").schema
    kind = schema.fields[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix = sent.value
        for b in batches:
            for lo, col in base.passes(b.column(1)):
                found = matches(ix, col, least) if ix.names else []
                if not found:
                    continue
                out = []
                for doc, t, matched, coverage, spans in found:
                    raw = col[doc].as_py().encode()
                    chars = [(len(raw[:s].decode()), len(raw[:e].decode())) for s, e in spans]
                    out.append((ix.names[t], matched, coverage, chars[0][0], chars[-1][1], [{"start": s, "end": e} for s, e in chars]))
                name, matched, coverage, start, end, spans = zip(*out)
                yield pa.RecordBatch.from_arrays(
                    [
                        b.column(0).take(pa.array([lo + f[0] for f in found], pa.int64())), pa.array(name), pa.array(matched, pa.int64()), pa.array(coverage, pa.float64()),
                        pa.array(start, pa.int64()), pa.array(end, pa.int64()), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                    ],
                    ["doc_id", "license", "matched", "coverage", "start", "end", "spans"],
                )

    return rows.mapInArrow(base.tidy(run), f"doc_id {kind}, license string, matched bigint, coverage double, start bigint, end bigint, spans array<{span}>")
