"""Periodic runs against a plain search of every start and period, on ordinary, repetitive and odd texts."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from layerlint.llm import periodic

DOCS = "doc_id bigint, text string, runs int, n_words string"


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute(w, least=6, repeats=4):
    """Every streak of words equal to the one q before, for every q, kept if q is its smallest period."""
    w = np.array([hash(x) for x in w], dtype=np.int64)
    out = set()
    for q in range(1, len(w) // repeats + 1):
        step = np.flatnonzero(np.diff((w[q:] == w[:-q]).astype(int), prepend=0, append=0))
        for i, j in zip(step[::2].tolist(), step[1::2].tolist()):
            start, end = i, j + q
            if end - start >= max(least, repeats * q) and not any((w[start + d : end] == w[start : end - d]).all() for d in range(1, q)):
                out.add((start, end - start, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(w, runs):
    gone = {i for start, length, q in runs for i in range(start + q, start + length)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def repetitive(seed, letters, blocks, longest):
    rng, out = random.Random(seed), []
    for _ in range(blocks):
        base = [rng.choice(letters) for _ in range(rng.randint(1, longest))]
        out += base * rng.randint(1, 7)
        out = out[: len(out) - rng.randint(0, 3)] if rng.random() < 0.5 else out
    return " ".join(out)


def check(spark, texts, **options):
    rows = [(i, t, 1, "x") for i, t in enumerate(texts)]
    found = periodic.find_runs(spark.createDataFrame(rows, DOCS), **options)
    assert sorted(found.columns) == ["collapsed", "doc_id", "n_words", "runs", "text"]
    for r in found.collect():
        w = words_of(r["text"])
        want = brute(w, **options)
        assert [tuple(x) for x in r["runs"]] == want, r["text"]
        assert r["collapsed"] == collapsed(w, want) and r["n_words"] == len(w)


@pytest.mark.parametrize("letters", ["a", "ab", "abc", "abcde"])
def test_repetitive_texts(spark, letters):
    check(spark, [repetitive(s, letters, s % 7, (3, 8, 30)[s % 3]) for s in range(60)])


def test_other_bounds(spark):
    check(spark, [repetitive(s, "ab", 4, 9) for s in range(40)], least=4, repeats=3)
    check(spark, [repetitive(s, "abc", 4, 5) for s in range(40)], least=12, repeats=5)
    with pytest.raises(ValueError):
        periodic.find_runs(spark.createDataFrame([], DOCS), repeats=2)


def test_nested_runs_and_neighbours(spark):
    fibonacci = ["a", "b"]
    for _ in range(10):
        fibonacci.append(fibonacci[-1] + fibonacci[-2])
    morse = "".join("ab"[bin(i).count("1") % 2] for i in range(512))
    check(spark, [" ".join("aaaaaab" * 5), " ".join("xaaaaaaax"), " ".join("abab" * 4 + "cdcdcdcd" + "a" * 9), " ".join(fibonacci[-1]), " ".join(morse), "é É é É é É é É é é"])


def test_odd_rows(spark):
    texts = [None, "", " \n\t", "one", "a a a a a", "a a a a a a", "\x0ba\x0ca a a\ta a\r", "A a A a A a A a", "a a a a"]
    check(spark, texts + texts[:4])
    docs = spark.createDataFrame([(None, "b " * 7, 1, "x"), (None, None, 1, "x")], DOCS)
    got = sorted(tuple(r) for r in periodic.digests(periodic.find_runs(docs)).collect())
    empty = hashlib.sha256(b"").hexdigest()
    assert got[0][1:7] == (0, None, None, None, None, empty) or got[1][1:7] == (0, None, None, None, None, empty)
    assert periodic.find_runs(docs.limit(0)).count() == 0


def test_very_long_text_of_one_word(spark):
    long = "a " * 300_000 + "b " + "c d " * 50_000
    row = periodic.find_runs(spark.createDataFrame([(1, long, 1, "x")], DOCS)).first()
    assert [tuple(x) for x in row["runs"]] == [(0, 300_000, 1), (300_001, 100_000, 2)] and row["collapsed"] == "a b c d"


def test_query_on_given_documents(spark):
    from layerlint.llm.queries import op13_diagonal_runs

    given = {r["doc_id"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    got = {r["doc_id"]: r for r in op13_diagonal_runs(spark, "/root/testdata/sf0.001").collect()}
    assert len(got) == len(given)
    some = 0
    for key, text in given.items():
        w = words_of(text)
        h = zlib.crc32(str(key).encode())
        g, n = h // 10, len(w)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
        runs = brute(w)
        some += bool(runs)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
        row = got[key]
        assert (row["n_runs"], row["start"], row["length"], row["period"]) == (len(runs), *best)
        assert row["exponent_milli"] == (1000 * best[1] // best[2] if runs else None)
        assert row["runs_sha256"] == hashlib.sha256("".join(f"{a},{b},{c}\n" for a, b, c in runs).encode()).hexdigest()
        assert row["collapsed_sha256"] == hashlib.sha256(collapsed(w, runs).encode()).hexdigest()
    assert some > 10
