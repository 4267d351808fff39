"""Vectorised scanning against plain Python."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from textmill.llm import grades, langid, licenses, lines, pack, scan, tokens, toxicity

WORD = re.compile("[^\x20\x09-\x0d]+")


def low(s):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), s)


def texts(seed=0, n=60):
    r = random.Random(seed)
    vocabulary = ["a", "B", "é", "Ünï", "x,y", "#$", "w" * 40, "你好", "\x0b", "a|b"]
    made = [r.choice([" ", "\n", "  ", "\t", ""]).join(r.choice(vocabulary) for _ in range(r.randint(0, 30))) for _ in range(n)]
    return made + ["", None, " ", "\n\n", "one\n one\none\n", "a b c a b c\n\n \na b c", "x " * 400]


def test_shingle_sets_match_plain_sets_and_ignore_batching():
    col = texts()
    s, begin = scan.shingle_sets(pa.array(col, pa.string()))
    for i, t in enumerate(col):
        w = WORD.findall(low(t or ""))
        exp = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
        own = s[begin[i] : begin[i + 1]]
        assert len(own) == len(exp)
        alone, _ = scan.shingle_sets(pa.array([t], pa.string()))
        assert (alone == own).all()
    assert len(scan.shingle_sets(pa.array([], pa.string()))[0]) == 0


def test_equal_sets_have_equal_hashes_only():
    a, _ = scan.shingle_sets(pa.array(["a b c d e f"]))
    b, _ = scan.shingle_sets(pa.array(["A  B\nc d E f"]))
    c, _ = scan.shingle_sets(pa.array(["a b c d e g"]))
    assert (a == b).all() and set(a.tolist()) & set(c.tolist()) and set(a.tolist()) != set(c.tolist())


def test_line_profile_matches_plain_python():
    col = texts(1)
    x = lines.lines_of(pa.array(col, pa.string()))
    for i, t in enumerate(col):
        t = t or ""
        w = WORD.findall(t)
        win, cov = Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2)), set()
        for k in range(len(w) - 2):
            if win[tuple(w[k : k + 3])] > 1:
                cov |= {k, k + 1, k + 2}
        own = [y for y in t.split("\n") if WORD.search(y)]
        exp = (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(own) - len(set(own)), len(cov), len(own))
        assert tuple(int(x[c][i]) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")) == exp


def test_normalised_lines_ignore_case_and_white_space():
    x = lines.lines_of(pa.array(["Hello  World \nhello\tworld", "hello worlds"]))
    assert x["line"][0] == x["line"][1] != x["line"][2]


def test_fingerprints_tell_texts_apart():
    x = lines.lines_of(pa.array(["a", "b", "a", "", None]))["fingerprint"]
    assert x[0] == x[2] != x[1] and x[3] == x[4] == 0


@pytest.fixture(scope="module")
def byte_bpe():
    P = pytest.importorskip("public_tokenizers")
    return P.path("byte_bpe_50k.json")


ODD = [
    "a  b  c\n\n d<|endoftext|> x " * 40, "你好" * 900, "a\x1cb \x1c c" * 200, " " * 1000 + "x", "don't  \n we'll 'S" * 99,
    "é" * 700 + " é " * 30, "a b c " * 200, "trailing   ", "\n", "", "b　c d", "a\xa0 b " * 50, "<|endoftext|>",
]


def test_token_counts_equal_the_library(byte_bpe):
    c = tokens.Counter(byte_bpe, 10_000, 64)
    assert c.counts(ODD) == c.encoded(ODD)
    assert c.counts([None, ""]) == [0, 0]


@pytest.mark.parametrize("chunk,overlap", [(50, 5), (64, 1), (300, 40)])
def test_spliced_chunks_equal_the_whole_text(byte_bpe, chunk, overlap):
    c = tokens.Counter(byte_bpe, chunk, overlap)
    long = [t for t in ODD if t]
    got = [tokens.splice(c.tok, t, chunk, overlap) for t in long]
    assert [n for n, _ in got] == c.encoded(long)
    if overlap <= 5:
        assert any(widened for _, widened in got)  # texts without a blank need the whole rest


def test_memo_may_overflow(byte_bpe, monkeypatch):
    monkeypatch.setattr(tokens, "MEMO", 3)
    monkeypatch.setattr(tokens, "STAY", 2)
    c = tokens.Counter(byte_bpe, 10_000, 64)
    some = ["alpha beta gamma", "delta beta eps", "alpha beta gamma zeta"]
    assert [n for t in some for n in c.counts([t])] == c.encoded(some)


def test_word_ids_equal_the_library():
    P = pytest.importorskip("public_tokenizers")
    w = pack.WordIds(P.path("word_bpe_49k.json"))
    some = [*ODD, "Straße ÉCOLE ΣΑΣ İ <|endoftext|>x<|startoftext|> a", " ́a ́ é café", "It's they'll 12 3.4"]
    exp = [np.array(e.ids, "<u4").tobytes() for e in w.tok.encode_batch(some, add_special_tokens=False)]
    assert list(w.encode(some)) == exp and list(w.encode([None])) == [b""]


def brute_bins(items, cap):
    """The fewest bins by search, for small instances."""
    items = sorted(items, reverse=True)
    best = [len(items)]

    def go(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(items):
            best[0] = len(rooms)
            return
        for r in {r: k for k, r in enumerate(rooms) if r >= items[i]}.values():
            go(i + 1, rooms[:r] + [rooms[r] - items[i]] + rooms[r + 1 :])
        go(i + 1, rooms + [cap - items[i]])

    go(0, [])
    return best[0]


def test_dominance_keeps_an_optimum():
    """What the reduction fixes, with the best packing of the rest, is as good as the best of all."""
    fixed_some = 0
    for seed in range(150):
        r = random.Random(seed)
        cap = r.choice([12, 20, 30])
        items = [r.randint(max(1, cap // 6), cap) for _ in range(r.randint(0, 9))]
        fixed, rest = pack.reduce_instance(dict(Counter(items)), cap)
        n = sum(k for _, k in fixed)
        fixed_some += n
        assert n + brute_bins([x for x, k in rest.items() for _ in range(k)], cap) == brute_bins(items, cap)
    assert fixed_some > 100


def test_every_piece_is_packed_once_and_fits():
    for seed in range(200):
        r = random.Random(seed)
        cap = r.choice([10, 20, 50])
        counts = Counter(r.randint(1, cap) for _ in range(r.randint(0, 40)))
        runs = pack.solve(dict(counts), cap)
        seen = Counter()
        for items, times in runs:
            assert times > 0 and sum(items) <= cap
            for x in items:
                seen[x] += times
        assert seen == counts
        t = pack.slots(runs)
        assert len(t["length"]) == sum(len(i) for i, _ in runs)


def test_winnowed_index_finds_what_a_plain_scan_finds():
    r = random.Random(5)
    ix = licenses.index(licenses.TEMPLATES)
    noise = lambda n: " ".join("".join(r.choice("abcdef") for _ in range(r.randint(2, 7))) for _ in range(n))
    col, exp = [], []
    for name in sorted(licenses.TEMPLATES):
        for before, after in ((0, 0), (3, 9), (200, 0)):
            col.append(f"{noise(before)} {licenses.TEMPLATES[name].upper()} {noise(after)}")
            exp.append(name)
    found = licenses.matches(ix, pa.array([*col, None, "", noise(500)]), 0.8)
    names = {}
    for doc, t, matched, coverage, spans in found:
        names.setdefault(doc, []).append(ix.names[t])
        assert 0.8 <= coverage <= 1 and spans
    assert [e in names[i] for i, e in enumerate(exp)] == [True] * len(exp)
    assert set(names) == set(range(len(col)))


def test_alignment_reports_edits_and_spans():
    ix = licenses.index({"x": "one two three four five six seven eight nine ten"})
    text = "é zero One, two three four EXTRA five six seven eight nine ten. end"
    ((doc, _, matched, coverage, spans),) = licenses.matches(ix, pa.array([text]), 0.8)
    assert (doc, matched, coverage) == (0, 10, 1.0)
    raw = text.encode()
    assert [raw[s:e].decode() for s, e in spans] == ["One, two three four", "five six seven eight nine ten"]
    assert licenses.matches(ix, pa.array(["one two three four five"]), 0.8) == []
    twice = "one two three four five six seven eight nine ten " * 2
    assert len(licenses.matches(ix, pa.array([twice]), 0.8)) == 2


def test_a_notice_with_many_inserted_words_is_one_occurrence():
    words = licenses.TEMPLATES["Apache-2.0-header"].split()
    ix = licenses.index({"x": " ".join(words)})
    for n in (9, 30, 80):
        for cut in (0.25, 0.5, 0.75):
            k = int(cut * len(words))
            text = " ".join(["before", *words[:k], *(f"extra{i}" for i in range(n)), *words[k:], "after"])
            ((_, _, _, coverage, spans),) = licenses.matches(ix, pa.array([text]), 0.8)
            assert coverage == 1.0 and len(spans) == 2
    halves = " ".join([*words[: len(words) // 2], *(f"extra{i}" for i in range(1000)), *words[len(words) // 2 :]])
    assert licenses.matches(ix, pa.array([halves]), 0.8) == []


def test_close_repeats_are_occurrences_of_their_own():
    for name in ("MIT", "Apache-2.0", "CC-BY-NC-4.0", "CC-BY-SA-4.0", "MIT-text"):
        line = licenses.TEMPLATES[name]
        ix = licenses.index({name: line})
        for between in ("\n", "\n# ", "\nand once more:\n"):
            text = between.join([line] * 50)
            found = licenses.matches(ix, pa.array([text]), 0.8)
            assert [x[3] for x in found] == [1.0] * 50
            step = len(line) + len(between)
            assert [x[4][0][0] // step for x in found] == list(range(50))
            assert all(x[4][-1][1] - x[4][0][0] <= len(line) for x in found)
        part = re.sub(r"\W*\w+\W*$", "", line)  # the last word is missing
        assert len(licenses.matches(ix, pa.array([f"{part}\n{line}\n{part}"]), 0.8)) == 3


def plain_scan(templates, text, least):
    """The templates that the rules find in a text, by a full alignment at every word."""
    ix = licenses.index(templates)
    _, h, _ = licenses.runs_of(pa.array([text]))
    found = []
    for t, template in enumerate(ix.words):
        best = None
        for lo in range(len(h)):
            pairs = [(i, w + lo) for i, w in licenses.align(template, h[lo : lo + 3 * len(template) + 16])]
            if len(pairs) >= least * len(template) and licenses.decided(ix, t, h, pairs) and (best is None or len(pairs) > len(best)):
                best = pairs
        if best:
            found.append((t, best, len(best) / len(template)))
    return sorted(ix.names[t] for t, _, _ in licenses.best_of(found))


def test_names_equal_those_of_a_plain_scan():
    r = random.Random(15)
    noise = lambda n: " ".join("".join(r.choice("abcdef") for _ in range(r.randint(2, 7))) for _ in range(n))
    names = ["Apache-2.0", "MIT", "ISC", "GPL-3.0", "GPL-2.0", "GPL-3.0-notice", "AGPL-3.0-notice", "CC-BY-SA-4.0", "CC-BY-SA-3.0", "Unlicense"]
    templates = {k: licenses.TEMPLATES[k] for k in names}
    ix = licenses.index(templates)
    for _ in range(40):
        name = r.choice(names)
        words = templates[name].split()
        for _ in range(r.randint(0, 3)):  # words left out, changed or put in between
            k = r.randrange(len(words))
            words[k : k + r.randint(0, 1)] = [noise(1)] * r.randint(0, 2)
        text = f"{noise(r.randint(0, 20))} {' '.join(words)} {noise(r.randint(0, 20))}"
        found = licenses.matches(ix, pa.array([text]), 0.8)
        want = plain_scan(templates, text, 0.8)
        # a template without three whole words in a row that are a fingerprint is no candidate
        assert sorted(ix.names[t] for _, t, *_ in found) in (want, []) and (found or not want or len(words) < 16), text


@pytest.mark.parametrize("text,want", [
    (licenses.TEMPLATES["BSD-3-Clause"], ["BSD-3-Clause"]),
    (licenses.TEMPLATES["BSD-2-Clause"], ["BSD-2-Clause"]),
    (licenses.TEMPLATES["AGPL-3.0-notice"], ["AGPL-3.0-notice"]),
    (licenses.TEMPLATES["LGPL-2.1-notice"], ["LGPL-2.1-notice"]),
    (licenses.TEMPLATES["LGPL-3.0-notice"], ["LGPL-3.0-notice"]),
    (licenses.TEMPLATES["GPL-2.0-notice"], ["GPL-2.0-notice"]),
    (licenses.TEMPLATES["GPL-3.0-notice"], ["GPL-3.0-notice"]),
    ("Licensed under CC BY-SA 3.0", ["CC-BY-SA-3.0"]),
    ("Licensed under CC BY-SA 2.5", []),
    ("Licensed under CC BY-NC-SA 4.0", []),
    ("Licensed under the Apache License, Version 1.1", []),
    ("This work is licensed under the GNU General Public License, version 1", []),
    ("This work is licensed under the GNU Affero General Public License, version 3", []),
    (licenses.TEMPLATES["BSD-3-Clause"].replace("source and", "source , 1. 2. and"), ["BSD-3-Clause"]),
])
def test_neighbouring_licences_are_told_apart(text, want):
    ix = licenses.index(licenses.TEMPLATES)
    for around in ("{}", "some words before\n{}\nand after it"):
        assert [ix.names[t] for _, t, *_ in licenses.matches(ix, pa.array([around.format(text)]), 0.8)] == want


def test_the_band_gives_what_the_whole_rectangle_gives():
    r = random.Random(16)
    for _ in range(200):
        template = [r.randrange(9) for _ in range(r.randint(1, 14))]
        words = np.array([r.randrange(9) for _ in range(r.randint(0, 30))], np.uint64)
        whole = licenses.align(template, words)
        if whole:
            d = [w - i for i, w in whole]
            band = licenses.align(template, words, min(d) - 3, max(d) + 3)
            assert len(band) == len(whole) and all(words[w] == template[i] for i, w in band)


def test_models_without_training_rows():
    m = langid.fit_texts([], [])
    assert [list(x) for x in langid.predict_column(m, pa.array(["abc", None], pa.string()))] == [["und", "und"], [0.0, 0.0], [True, True]]
    t = toxicity.fit_texts([], [])
    assert len(toxicity.score_column(t, pa.array(["abc", None], pa.string()))) == 2
    g = grades.fit_texts([], [])
    assert [list(x) for x in grades.grade_column(g, pa.array(["abc"]), 1)] == [[0.0], [0.0]]
    one = langid.fit_texts(["abc def"], ["en"])
    assert list(langid.predict_column(one, pa.array(["abc"]))[0]) == ["en"]


class Encoded:
    """A tokenizer that counts the characters it is given."""

    def __init__(self, tok):
        self.tok, self.n = tok, 0

    def encode_batch(self, texts, **k):
        self.n += sum(map(len, texts))
        return self.tok.encode_batch(texts, **k)

    def encode_batch_fast(self, texts, **k):
        self.n += sum(map(len, texts))
        return self.tok.encode_batch_fast(texts, **k)


def huge(kind):
    r = random.Random(8)
    if kind == "line ends":
        return "\n".join(r.choice(["word", "other", "a", "d'or", "it's", "3.5"]) for _ in range(60_000))
    if kind == "chinese":
        return "".join(r.choice("的一是不了人我在有他这为之大来以个中上们") + ("。" if r.random() < 0.05 else "，" if r.random() < 0.05 else "") for _ in range(120_000))
    if kind == "one run":
        return "ab" * 100_000
    if kind == "one run, then words":
        return "x" * 90_000 + " and then some words" * 5_000 + "y" * 70_000 + "\nend"
    if kind == "encoded":
        return "".join(r.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(200_000))
    if kind == "blanks":
        return "a" + " " * 150_000 + "b\t\n" * 20_000
    return "<|endoftext|>" * 12_000 + "'s 't" * 10_000


@pytest.mark.parametrize("kind", ["line ends", "chinese", "one run", "one run, then words", "encoded", "blanks", "special"])
def test_huge_texts_are_encoded_in_linear_work(byte_bpe, kind):
    c, text = tokens.Counter(byte_bpe, 32_768, 256), huge(kind)
    tok = Encoded(c.tok)
    assert tokens.splice(tok, text, 32_768, 256)[0] == len(c.tok.encode(text, add_special_tokens=False))
    assert tok.n <= 3 * len(text)


def test_proven_boundaries_hold_in_any_text(byte_bpe):
    c, r = tokens.Counter(byte_bpe, 100, 10), random.Random(12)
    parts = ["a", "B", "é", "7", "42", " ", "  ", "\n", "\t", "'", "'s", "'t", ".", ",", "!", "<", "|", ">", "<|endoftext|>", "的", "。", "かな", "한", "\u00a0", "\x85", "\x1c", "ß", "－", "\u0301", "😀", "-", "_", "re"]
    for _ in range(600):
        text = "".join(r.choice(parts) for _ in range(r.randint(2, 40)))
        whole = c.tok.encode(text, add_special_tokens=False).ids
        for b in tokens.stable(text, 0, len(text)):
            assert c.tok.encode(text[:b], add_special_tokens=False).ids + c.tok.encode(text[b:], add_special_tokens=False).ids == whole, (text, b)
