"""Packing: tokens against the tokenizer on whole texts, sequences against a check of every place, counts against bounds."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from layerlint.llm import packing
from layerlint.llm.words import PIECE

WORDS = public_tokenizers.path("word_bpe_49k.json")
DOCS = "doc_id bigint, text string, length int, sequence_id string, key int"
SF = "/root/testdata/sf0.001"


def best_fit(lengths, room):
    """Sequences of plain best fit, longest first."""
    gaps = []
    for x in sorted(lengths, reverse=True):
        fit = [(g, i) for i, g in enumerate(gaps) if g >= x]
        if fit:
            gaps[min(fit)[1]] -= x
        else:
            gaps.append(room - x)
    return len(gaps)


def table(spark, texts):
    return spark.createDataFrame([(i, t, 1, "x", 2) for i, t in enumerate(texts)], DOCS)


def check(rows, texts, room):
    """Every piece of every text is there once, and each sequence is filled from 0 without a gap."""
    tokenizer = Tokenizer.from_file(WORDS)
    want = defaultdict(int)
    for key, text in texts:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        for i, at in enumerate(range(0, len(ids), room)):
            part = np.array(ids[at : at + room], "<u4").tobytes()
            want[key, i, at, len(part) // 4, zlib.crc32(part)] += 1
    places = defaultdict(list)
    for r in rows:
        want[tuple(r[:5])] -= 1
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    assert not any(want.values())
    for parts in places.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= room
    return len(places)


@pytest.mark.parametrize("room", [10, 64, 257])
def test_patterns_use_every_piece(room):
    rng = np.random.default_rng(room)
    for lengths in (rng.integers(1, room + 1, 500), rng.integers(1, max(2, room // 9), 800), rng.integers(room // 3, room + 1, 300), np.full(7, room), np.full(50, 1), rng.integers(1, room + 1, 1), np.zeros(0, int)):
        counts = np.bincount(lengths, minlength=room + 1)
        used = np.zeros(room + 1, int)
        total = 0
        for times, uses in packing.patterns(counts, room):
            assert times > 0 and sum(k * n for k, n in uses.items()) <= room
            total += times
            for k, n in uses.items():
                used[k] += times * n
        assert (used == counts).all()
        assert total <= best_fit(lengths.tolist(), room) * 1.02 + 1 and total >= -(-lengths.sum() // room)


def test_exact_complements_are_found():
    # each first length has exactly one way to be completed: by one, by two, by three
    counts = np.bincount([60, 40, 55, 30, 15, 52, 25, 13, 10], minlength=101)
    assert sorted((t, sum(k * n for k, n in u.items())) for t, u in packing.patterns(counts, 100)) == [(1, 100)] * 3


def test_sums_of_two_equal_lengths_need_two():
    index = packing.Complements(np.bincount([20], minlength=101), 100)
    assert index.pair(40) == () and index.exact(40) == ()
    index = packing.Complements(np.bincount([20, 20, 20], minlength=101), 100)
    assert index.pair(40) == (20, 20) and index.exact(60) == (20, 20, 20)


def test_odd_rows_and_pieces(spark):
    texts = [None, "", " \n", "one", "One  two\tthree", "a<|endoftext|>b <|startoftext|>", "é É ñ 日本 😀 'S don't", "x " * 63, "x " * 64, "x " * 65, "x " * 1000, "y" * 5000, "a b c\x1cd\x85e é ́z", "one", "one"]
    docs = table(spark, texts).union(spark.createDataFrame([(None, "one two", 1, "x", 2)] * 3 + [(3, "one", 1, "x", 2)], DOCS))
    rows = packing.pack_documents(docs, WORDS, room=64)
    assert rows.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    check(rows.collect(), [*enumerate(texts), *[(None, "one two")] * 3, (3, "one")], 64)
    assert packing.pack_documents(docs.limit(0), WORDS).count() == 0


def test_words_of_letters_and_closing_signs(monkeypatch):
    monkeypatch.setattr(packing, "KNOWN", 3)
    tokenizer, encoder = Tokenizer.from_file(WORDS), packing.Encoder(WORDS)
    words = "Été ÉTÉ. straße?! ÀÖØÞß ×÷ a×b, don't. It's ?! a.b. I\u0307x e\u0301, É\u0301. ÿ; <|EndOfText|> <|endoftext|>. A<|endoftext|>b. \u212a\u212b, İI, 7up. ĳ. ﬁ, \u00b5m \u00aa. x\u00a0y, ’s. naïve\u200d!".split(" ")
    texts = [*words, " ".join(words), "\t\n".join(reversed(words)), "x" * 200]
    for text in texts:
        got = b"".join(ids for _, ids in encoder.encode([text.encode()]))
        assert np.frombuffer(got, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


def test_long_text_in_parts(spark):
    texts = [" ".join(f"w{i % 977} Foo, bar" for i in range(40_000)), "z"]  # longer than a part
    assert len(texts[0]) > PIECE
    check(packing.pack_documents(table(spark, texts), WORDS).collect(), list(enumerate(texts)), packing.ROOM)


def test_many_copies_of_one_row(spark):
    docs = spark.createDataFrame([(7, "same text here", 1, "x", 2)] * 3000, DOCS)
    rows = packing.pack_documents(docs, WORDS, room=100).collect()
    assert check(rows, [(7, "same text here")] * 3000, 100) == 120


def test_sequences_hold_the_ids(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    placed = packing.pack_documents(docs, WORDS, room=512, with_ids=True)
    tokenizer = Tokenizer.from_file(WORDS)
    texts = {r["doc_id"]: [*tokenizer.encode(r["text"], add_special_tokens=False).ids, 1] for r in docs.collect()}
    for r in packing.sequences(placed).collect():
        ids = np.frombuffer(bytes(r["ids"]), "<u4").tolist()
        for p in r["parts"]:
            at = 512 * p["piece"]
            assert ids[p["offset"] : p["offset"] + p["length"]] == texts[p["key"]][at : at + 512]


def test_query_on_given_documents(spark):
    from layerlint.llm.queries import op11_exact_complements

    texts = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    rows = op11_exact_complements(spark, SF).collect()
    assert check(rows, texts, packing.ROOM) <= -(-sum(r["length"] for r in rows) // packing.ROOM) + 1
