"""Spelling variants against a comparison of all pairs, in one cell and in many, and the counts against a plain loop."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from layerlint.llm import spelling

WORDS = "word string, n bigint, near string, form int"


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
    return a[i + (len(a) == len(b)) :] == b[i + 1 :]


def brute(counts, ratio=5):
    """All columns per word, from a comparison with every other word."""
    forms, out = {}, {}
    for w, n in counts.items():
        near = sorted((-m, x) for x, m in counts.items() if one_edit(w, x))
        form = near[0] if near and -near[0][0] >= ratio * n else None
        forms[w] = form and form[1]
        out[w] = (forms[w], None, n, len(near), form and -form[0])
    for w in counts:
        root = w
        while forms[root]:
            root = forms[root]
        out[w] = (out[w][0], root, *out[w][2:])
    return out


def family(seed, size, letters="abéç", longest=7):
    rng, out = random.Random(seed), {}
    while len(out) < size:
        out["".join(rng.choice(letters) for _ in range(rng.randint(1, longest)))] = 5 ** rng.randint(0, 6) + rng.randint(0, 3)
    return out


def check(spark, counts, ratio=5):
    words = spark.createDataFrame([(w, n, "x", 1) for w, n in counts.items()] + [(None, 3, "x", 1)], WORDS)
    rows = spelling.variants(words, ratio)
    assert rows.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert {r["word"]: tuple(r[1:]) for r in rows.collect()} == brute(counts, ratio)


@pytest.mark.parametrize("cell", [10_000, 40, 3])
def test_all_pairs_in_cells_of_any_size(spark, monkeypatch, cell):
    monkeypatch.setattr(spelling, "CELL", cell)
    monkeypatch.setattr(spelling, "BLOCK", 16)
    check(spark, family(1, 300))
    check(spark, family(2, 200, "xyé", 6), ratio=2)


def test_one_crowded_leaf(spark, monkeypatch):
    monkeypatch.setattr(spelling, "CELL", 8)  # words of one letter group make a leaf of many slices
    rng = random.Random(5)
    check(spark, {"".join(rng.choice("cd") for _ in range(9)): rng.randint(1, 40) for _ in range(300)})


def test_long_and_short_words(spark):
    long = "".join("abc"[i % 3] * (1 + i % 7) for i in range(300))
    words = {w: 5 * 30**i + 1 for i, w in enumerate([long, long + "z", long[:500] + long[501:], "a", "b", "é", "ab", "zzz"])}
    check(spark, words | {"a" * k: 2 * k for k in (61, 62, 63, 64, 65)} | {"a" * 63 + "b": 1, "a" * 62 + "b": 4000})
    none = spark.createDataFrame([], WORDS)
    assert spelling.variants(none).count() == 0


def test_ties_and_chains(spark):
    check(spark, {"abcdef": 5, "abcdeg": 25, "abcdeh": 25, "abcdegi": 125, "abcdegij": 625, "bbcdef": 24, "qqqqqq": 5, "qqqqqr": 24})


def test_vectors_bound_differences():
    rng = random.Random(3)
    for _ in range(300):
        a = "".join(rng.choice("abcdeéêçxyzà") for _ in range(rng.randint(1, 9)))
        i = rng.randrange(len(a))
        for b in (a[:i] + a[i + 1 :], a[:i] + "é" + a[i:], a[:i] + "x" + a[i + 1 :]):
            d = np.diff(spelling.Words([a, b]).counts, axis=0)[0]
            assert d[d > 0].sum() <= 1 and -d[d < 0].sum() <= 1


def count(rows, typos):
    out = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{key}:{word}".encode())
            out[word[: h % len(word)] + word[h % len(word) + 1 :] if key is not None and h % typos == 0 else word] += 1
    return {w: n for w, n in out.items() if len(w) >= 6 and n >= 5}


def test_counts(spark):
    rows = [(i, ("Éclair ÉCLAIR eclairs naïvely Naïvely 12abcdefg×÷ Āabcdef " * 3) if i % 5 else None) for i in range(60)] + [(None, "without key without"), (9, ""), (9, ""), (None, None)] * 3
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id bigint, text string, word string, n int")
    got = {r["word"]: r["n"] for r in spelling.count_words(docs, "[A-Za-zÀ-ÿ]+", 6, 5, typos=7).collect()}
    assert got == count(rows, 7) and len(got) > 8
    assert spelling.count_words(docs.limit(0), "[a-z]+", 6, 5).count() == 0


def test_query_on_given_documents(spark):
    from layerlint.llm.queries import op12_frequency_trie

    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    got = {r["word"]: tuple(r[1:]) for r in op12_frequency_trie(spark, "/root/testdata/sf0.001").collect()}
    want = brute(count(rows, 199))
    assert got == want and sum(w[3] > 0 for w in want.values()) > 20
