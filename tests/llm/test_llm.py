"""The training-data operators against brute force on small fixtures, with nulls, empties, ties, repeats and empty tables."""

import base64
import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from layerlint.llm import decontamination, jaccard, langid, linededup, mixing, quality, secrets, sharding, toxicity, warc
from layerlint.llm.graph import components
from layerlint.session import new_folder

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, n bigint, node string, size string"


@pytest.fixture(scope="module")
def given(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def table(spark, texts, first=0):
    rows = [(first + i, t, "en", "s", len(t or ""), 1, "x", "y") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def odd(spark, given):
    """Odd rows among ordinary ones: nulls, empty and white texts, one long text, repeats, null columns, clashing names."""
    texts = [r["text"] for r in given.orderBy("doc_id").limit(40).collect()]
    rows = [(i, t, "en", f"src{i % 3}", len(t), 1, "x", "y") for i, t in enumerate(texts)]
    rows += [(100, None, None, None, None, None, None, None), (101, "", "en", "a", 0, 1, "", ""), (102, " \n\t", "en", "a", 3, 1, "", ""), (103, "one two", "en", "a", 7, 1, "", "")]
    rows += [(104, "one  TWO", "en", "a", 8, 1, "", ""), (105, " ".join(f"w{i % 977}" for i in range(60_000)), "en", "a", 1, 1, "", ""), (None, texts[3], "fr", "a", 1, 1, "", ""), (None, "é 12 日本", None, None, 1, 1, "", "")]
    rows += [(7, texts[7], "en", "src1", 1, 1, "x", "y"), (7, texts[8], "en", "src1", 1, 1, "x", "y"), (106, "123 456", "de", "a", 7, 1, "", "")]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


# 1


def test_warc_round_trip(spark):
    rows = [(1, "u", "abcWARC/1.1\r\nx\r\n\r\nWARC/1.1\r\n\r\n"), (2, None, None), (3, "u", ""), (None, "z", "\r\n"), (None, "z", "abc"), (4, "a b", "é" * 30_000), (5, "q", "x\r\n\r\n\r\n"), (4, "a b", "é" * 30_000), (6, "c", "abcd"), (7, "d", "abcd")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = sorted((tuple(r) for r in warc.archive_round_trip(pages, new_folder(spark, "warc-test"), chunk=1000).collect()), key=str)
    best = {}
    for key, _, html in rows:
        if key is not None:
            best[html or ""] = max(best.get(html or "", -1), key)
    want = []
    for key, _, html in rows:
        payload, to = (html or "").encode(), best.get(html or "")
        revisit = to is not None and to != key
        want.append((key, len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode(), "revisit" if revisit else "response", to if revisit else None))
    assert [g[:5] for g in got] == sorted(want, key=str)
    assert all(g[6] for g in got) and max(g[5] for g in got) == 60
    assert warc.archive_round_trip(pages.limit(0), new_folder(spark, "warc-test")).count() == 0


def test_warc_least_revisit_and_running_digests(spark):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcdef" * 50), (4, "u", "abcdef" * 50)], "page_id bigint, url string, html string")
    path = new_folder(spark, "warc-test")
    got = {r["page_id"]: r["record_type"] for r in warc.archive_round_trip(pages, path, chunk=100, least_revisit=10).collect()}
    assert got == {1: "response", 2: "response", 3: "revisit", 4: "response"}
    chunks = warc.read_chunks(spark, path)
    running = warc.running_digests(chunks.filter("segmented")).orderBy("chunk_no").collect()
    assert [r["size_so_far"] for r in running] == [100, 200, 300]
    assert running[1]["digest_so_far"] == base64.b32encode(hashlib.sha1(("abcdef" * 50)[:200].encode()).digest()).decode()
    assert not warc.running_digests(chunks.filter("segmented and chunk_no <> 2")).agg({"in_order": "min"}).first()[0]


# 2


def spans_of(text):
    word = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token", "api")).replace("[aA][pP][iI]", "[aA][pP][iI]_?[kK][eE][yY]")
    found = [(m.start(), 0, m.end()) for m in re.finditer(rf"""(?:{word})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text) if len(m[1]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    return sorted(found + [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24])


def test_secrets_base_spans(spark, odd, none):
    texts = ["secret:token:abcdefgh", "API_KEY = 'x9x9x9x9' 😀 Token=\"abc\" passwd:hunter22", "AKIA" + "Z" * 15, "😀AKIA" + "Z9" * 9 + " " + "ab12" * 7, "kpassword=aaaaaaa"]
    docs = odd.unionByName(table(spark, texts, 500))
    for r in docs.select("doc_id", "text").join(secrets.find_secrets(docs.filter("doc_id >= 100")), "doc_id").collect():
        want = ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in spans_of(r["text"] or ""))
        assert r["base_sha256"] == hashlib.sha256(want.encode()).hexdigest()
        assert [x for x in r["spans"].split(",") if x and not x.startswith("random")] == [x for x in want.split(",") if x]
    assert secrets.find_secrets(odd).count() == odd.count() and secrets.find_secrets(none).count() == 0


def test_secret_battery_tells_random_from_written(spark):
    rng = np.random.default_rng(1)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    random = ["".join(letters[i] for i in rng.integers(0, 64, 44)) for _ in range(300)]
    written = [("ThisIsAnOrdinaryName" * 3)[:40] + f"v{i % 7}" for i in range(300)]
    docs = table(spark, [f"see {t} here" for t in random + written])
    found = {r["doc_id"]: r["n_random"] for r in secrets.find_secrets(docs).collect()}
    hit = [found[i] for i in range(300)]
    assert sum(hit) > 200 and sum(found[i] for i in range(300, 600)) <= 0.1 * sum(hit)


# 3


def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute_components(rows):
    """Union of linked rows of (key, text)."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    ids = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            ids[find(i)] = min(ids.get(find(i), key), key)
    return [(key, len(s), ids.get(find(i))) for i, ((key, _), s) in enumerate(zip(rows, sets))]


def test_jaccard_components(spark, odd, none):
    rng = np.random.default_rng(5)
    base = [f"b{i}" for i in range(150)]
    passage = " ".join(f"p{i}" for i in range(60))
    near = [" ".join(f"x{rng.integers(10**9)}" if rng.random() < 0.03 else w for w in base) for _ in range(60)]
    texts = near + [" ".join(base)] * 5 + [f"{passage} " + " ".join(f"y{rng.integers(10**9)}" for _ in range(rng.integers(3, 40))) for _ in range(60)]
    docs = odd.unionByName(table(spark, texts, 1000))
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    got = [(r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard.near_duplicates(docs).collect()]
    assert sorted(got, key=str) == sorted(brute_components(rows), key=str)
    assert jaccard.near_duplicates(none).count() == 0


def test_jaccard_short_texts_in_groups(spark):
    rng = np.random.default_rng(6)
    texts = []
    for i in range(250):
        words = [f"q{i}v{j}" for j in range(rng.integers(7, 14))]
        texts += [" ".join(words + [f"q{i}u{j}" for j in range(k)]) for k in range(4)]
        texts += [" ".join([f"q{i}t"] + words)] * (i % 2)
    docs = table(spark, [texts[i] for i in rng.permutation(len(texts))])
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    got = [(r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard.near_duplicates(docs).collect()]
    assert sorted(got) == sorted(brute_components(rows))


def test_jaccard_large_loose_group(spark):
    """Near copies of one text around the threshold: many fall out of the first groups, some link to few members or to none."""
    rng = np.random.default_rng(5)
    base, texts = [f"b{i}" for i in range(160)], []
    for i in range(240):
        words = list(base)
        for at in rng.choice(160, int(rng.integers(0, 9)), replace=False):
            words[at] = f"x{rng.integers(0, 40)}"
        texts.append(" ".join(words))
    got = [(r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard.near_duplicates(table(spark, texts)).collect()]
    assert sorted(got) == sorted(brute_components(list(enumerate(texts))))
    assert 1 < len({c for _, _, c in got}) < 200


def test_jaccard_rounds_take_new_links_only(spark, monkeypatch):
    """A round joins what its own links join, by the names of the groups by then: no link of an earlier round comes again."""
    rng = np.random.default_rng(5)
    base, texts = [f"b{i}" for i in range(160)], []
    for _ in range(240):
        words = list(base)
        for at in rng.choice(160, int(rng.integers(0, 9)), replace=False):
            words[at] = f"x{rng.integers(0, 40)}"
        texts.append(" ".join(words))
    calls = []

    def spy(links, name):
        calls.append({tuple(sorted(r)) for r in links.select("a", "b").collect()})
        return components(links, name)

    monkeypatch.setattr(jaccard, "components", spy)
    got = [(r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard.near_duplicates(table(spark, texts)).collect()]
    assert sorted(got) == sorted(brute_components(list(enumerate(texts))))
    rounds = calls[1:]  # the first call makes the groups
    assert len(rounds) > 1 and sum(map(len, rounds)) == len(set().union(*rounds))


def test_graph_components_of_a_star_stores_two_rounds(spark, monkeypatch):
    from layerlint.llm import graph
    from layerlint.session import written

    stored = []
    monkeypatch.setattr(graph, "written", lambda rows, name: stored.append(name) or written(rows, name))
    links = written(spark.createDataFrame([(7, i) for i in range(1, 40)] + [(3, 7), (7, 7)], "a bigint, b bigint"), "star")
    found = {r["node"]: r["component"] for r in components(links, "labels").collect()}
    assert found == {i: 1 for i in range(1, 40)} and len(stored) <= 2


def test_graph_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 101), (102, 101), (200, 200)]
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert all(found[i] == 0 for i in range(41)) and found[102] == 100 and found[200] == 200


# 4


def test_decontamination(spark, odd, none):
    rng = np.random.default_rng(2)
    items = [" ".join(f"i{k}w{rng.integers(50)}" for _ in range(n)) for k, n in enumerate((4, 7, 20, 33, 60))] + [None, "", " "]
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    noise = lambda n: " ".join(f"n{rng.integers(400)}" for _ in range(n))
    edited = items[4].split()
    edited[30] = "changed"
    texts = [f"{noise(37)} {t.upper()} {noise(11)}" for t in items[:5]] + [items[3], f"{noise(50)} {' '.join(edited)}", noise(300), " ".join(items[4].split()[:20])]
    got = {(r["doc_id"], r["item_id"]): r for r in decontamination.find_passages(odd.unionByName(table(spark, texts, 1000)), benchmark).collect()}
    assert set(got) == {(1000 + i, i) for i in range(5)} | {(1005, 3), (1006, 4)}
    assert got[1002, 2]["start_word"] == 37 and got[1002, 2]["n_words"] == 20 and got[1002, 2]["similarity"] == pytest.approx(1)
    assert decontamination.find_passages(none, benchmark).count() == 0 and decontamination.find_passages(odd, benchmark.limit(0)).count() == 0


def test_decontamination_does_not_depend_on_slices(spark, monkeypatch):
    """Items share a template and some repeat; documents hold them with edited words."""
    rng = np.random.default_rng(9)
    template = [f"t{i}" for i in range(12)]
    items = [template + [f"i{k}w{j}" for j in range(rng.integers(8, 20))] for k in range(24)]
    benchmark = spark.createDataFrame(list(enumerate([" ".join(x) for x in items] + [" ".join(items[0]), None, ""])), "item_id bigint, text string")
    texts = []
    for x in items:
        for _ in range(4):
            changed = [f"z{rng.integers(10**6)}" if rng.random() < 0.06 else w for w in x]
            texts.append(" ".join([f"n{rng.integers(400)}" for _ in range(9)] + changed))
    docs = table(spark, texts)
    found = []
    for most in (1024, 5, 1):
        monkeypatch.setattr(decontamination, "BATCH_ITEMS", most)
        found.append(sorted((r["doc_id"], r["item_id"], round(r["similarity"], 9)) for r in decontamination.find_passages(docs, benchmark).collect()))
    assert found[0] and found[0] == found[1] == found[2]


def test_decontamination_of_text_ids(spark):
    item = " ".join(f"w{i}" for i in range(30))
    benchmark = spark.createDataFrame([("a-1", item), (None, item + " x")], "item_id string, text string")
    assert {tuple(r) for r in decontamination.find_passages(table(spark, [item]), benchmark).select("doc_id", "item_id").collect()} == {(0, "a-1"), (0, None)}


def test_fingerprints():
    rng = np.random.default_rng(5)
    features = rng.integers(0, 2**63, 20_000).astype(np.uint64) * np.uint64(2)
    wanted = [(np.sort(rng.integers(0, 20_000 - n, 50)), n) for n in (1, 2, 9, 128, 9000)] + [(np.array([], np.int64), 3)]
    for (starts, n), got in zip(wanted, decontamination.fingerprints(features, wanted)):
        for s, p in zip(starts.tolist(), got.tolist()):
            ones = np.unpackbits(features[s : s + n].view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0)
            assert p == int(np.packbits(2 * ones > n).view(np.uint64)[0])
    assert decontamination.fingerprints(features[:0], [(np.array([], np.int64), 4)])[0].size == 0


def test_decontamination_recall_of_edited_items():
    """All windows of an item's length at similarity 0.75 or more by brute force; the search finds nine of ten pairs at least."""
    rng = np.random.default_rng(21)
    texts = [[f"i{k}w{rng.integers(300)}" for _ in range(n)] for k, n in enumerate(rng.integers(6, 160, 60).tolist())]
    items = decontamination.Items(list(range(60)), [" ".join(x).encode() for x in texts])
    docs = []
    for x in texts:
        for edits in (0, 1, 1, 2, 3, 4):
            own = list(x)
            for _ in range(edits):
                at, kind = int(rng.integers(len(own))), rng.integers(3)
                own[at : at + 1] = [[f"z{rng.integers(10**6)}"], [], [own[at], "more"]][kind]
            docs.append(" ".join([f"n{rng.integers(400)}" for _ in range(rng.integers(0, 40))] + own + [f"n{rng.integers(400)}" for _ in range(rng.integers(0, 40))]))
    words, counts = decontamination.word_hashes([d.encode() for d in docs])
    edges = np.concatenate([[0], np.cumsum(counts)])
    want = set()
    for d in range(len(docs)):
        own, item = words[edges[d] : edges[d + 1]], d // 6
        size = len(items.words[item])
        # windows over an edge of the text are compared too
        if any(items.similarity(item, own[max(s, 0) : s + size]) >= 0.75 - 1e-11 for s in range(1 - size, len(own))):
            want.add((d, item))
    got = {(t, item) for t, item, *_ in items.search(words, counts)}
    assert got <= want and len(want) > 120 and len(got) >= 0.9 * len(want), (len(got), len(want))


def test_hamming_search_finds_all_within_radius():
    rng = np.random.default_rng(3)
    listed = rng.integers(0, 2**63, 200).astype(np.uint64)
    queries = listed[rng.integers(0, 200, 500)]
    for i in range(500):
        for bit in rng.choice(64, rng.integers(0, 16), replace=False):
            queries[i] ^= np.uint64(1) << np.uint64(bit)
    index = decontamination.ClassIndex.build(8, listed, np.zeros(200), np.zeros(200))
    q, e, _ = index.search(queries)
    assert set(zip(q.tolist(), e.tolist())) == {(i, j) for i in range(500) for j in range(200) if int(queries[i] ^ listed[j]).bit_count() <= decontamination.RADIUS}


# 5


def test_quality_counts(spark, odd, none):
    junk = ["\n".join(["a b c d"] * 30), "x y z " * 200, " ".join(f"k{i % 90}" for i in range(900))]
    docs = odd.unionByName(table(spark, junk, 1000))
    text = {(r["doc_id"], r["n_chars"]): r["text"] or "" for r in docs.collect()}
    for r in quality.judge(docs, keep=("doc_id", "n_chars")).collect():
        s = text[r["doc_id"], r["n_chars"]]
        w = re.findall(r"[^\x20\x09-\x0D]+", s)
        windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
        seen = Counter(windows)
        again = {k for i, x in enumerate(windows) if seen[x] > 1 for k in (i, i + 1, i + 2)}
        lines = [x for x in s.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        if r["doc_id"] is not None and (r["doc_id"], r["n_chars"]) != (7, 1):
            assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (
                len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", s)), len(lines) - len(set(lines)), len(again))
            assert r["base_failed"] == (len(w) < 50 or 100 * len(again) > 50 * len(w))
        assert not (r["base_failed"] and r["kept"])
    assert quality.judge(none).count() == 0


def test_divergence(spark):
    p = spark.createDataFrame([([1, 0], [0, 5]), ([2, 2], [1, 1]), ([0, 0], [1, 1])], "p array<int>, q array<int>")
    got = [r[0] for r in p.select(quality.jensen_shannon(p["p"], p["q"])).collect()]
    assert got[0] == pytest.approx(1) and got[1] == pytest.approx(0) and got[2] is None


# 6


def test_patience_and_line_dedup(spark, none):
    assert linededup.patience([1, 2, 3, 9], [7, 1, 2, 3]) == [(0, 1, 3)]
    assert linededup.patience([], [1]) == [] and linededup.patience([1, 1], [1, 1]) == [(0, 0, 2)]
    line = lambda k: f"line {k} " + "words " * 12
    rows = [(1, "\n".join(map(line, range(6)))), (2, "\n".join([line(50), line(2), line(3), line(51)])), (3, "\n".join(map(line, range(6)))), (4, "short\n" + line(60)), (5, "short\n" + line(61)), (6, None), (None, line(2)), (7, ""), (2, line(4))]
    got = sorted(((r["doc_id"], r["text"], r["n_deleted"]) for r in linededup.dedup_lines(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()), key=str)
    want = [(1, rows[0][1], 0), (2, f"{line(50)}\n{line(51)}", 2), (3, "", 6), (4, rows[3][1], 0), (5, rows[4][1], 0), (6, None, 0), (None, line(2), 0), (7, "", 0), (2, "", 1)]
    assert got == sorted(want, key=str)
    assert linededup.dedup_lines(none).count() == 0


def test_line_dedup_of_frequent_passages(spark):
    long, halves = "a b " * 25, ["c d " * 10, "e f " * 9]
    texts = [f"own {i}\n{long}\nmore {i}" for i in range(20)] + [f"own {i}\n{halves[0]}\n \n{halves[1]}\nmore {i}" for i in range(20, 40)]
    got = {r["doc_id"]: r for r in linededup.dedup_lines(table(spark, texts)).collect()}
    for i in range(40):
        assert got[i]["text"] == (texts[i] if i in (0, 20) else f"own {i}\nmore {i}"), i


def test_patience_of_repeated_lines():
    assert linededup.patience([8, 1, 2, 9], [5, 1, 2, 6, 1, 2, 7]) == [(1, 1, 2)]
    # lines 1 and 2 follow each other once in the one, where neither is the first
    assert linededup.patience([9, 2, 1, 2, 1], [1, 6, 1, 2, 7, 1, 2, 5], [40, 40, 40, 40, 40, 40, 40, 40], 60)[0] == (2, 2, 2)
    assert linededup.shortest_runs([1, 0, 2, 3, 4], {1: 30, 0: 0, 2: 30, 3: 60}, 60) == [3, 0, 4, 4, 0]
    rng = np.random.default_rng(8)
    for _ in range(2000):
        a, b = (rng.integers(0, 5, rng.integers(0, 14)).tolist() for _ in range(2))
        sizes = [0 if x == 0 else 25 + x for x in b]
        blocks = linededup.patience(a, b, sizes, 60)
        assert all(a[i : i + n] == b[j : j + n] for i, j, n in blocks)
        assert all(x[0] + x[2] <= y[0] and x[1] + x[2] <= y[1] for x, y in zip(blocks, blocks[1:]))


def test_line_dedup_of_repeated_passage(spark):
    passage = "k l " * 10 + "\n" + "m n " * 10
    texts = [f"a\n{passage}\nb", f"x\n{passage}\ny\n{passage}\nz"]
    got = {r["doc_id"]: r["text"] for r in linededup.dedup_lines(table(spark, texts)).collect()}
    assert got == {0: texts[0], 1: f"x\ny\n{passage}\nz"}


def test_line_dedup_partner_by_run(spark):
    """Both lines of a block were first seen in other documents, one each."""
    one, two = "g h " * 10, "i j " * 10
    texts = [f"a\n{one}\nb", f"c\n{two}\nd", f"e\n{one}\n{two}\nf", f"g\n{one}\n{two}\nh"]
    got = {r["doc_id"]: r["text"] for r in linededup.dedup_lines(table(spark, texts)).collect()}
    assert got == {0: texts[0], 1: texts[1], 2: texts[2], 3: "g\nh"}


def test_run_hashes_cover_common_blocks():
    rng = np.random.default_rng(4)
    for _ in range(200):
        sizes = rng.integers(0, 40, 12)
        lines = np.where(sizes == 0, 0, rng.integers(1, 2**62, 12))
        a, b = rng.integers(0, 5), rng.integers(6, 13)
        own, part = linededup.run_hashes(lines, sizes, 60), linededup.run_hashes(lines[a:b], sizes[a:b], 60)
        assert set(part.tolist()) <= set(own.tolist())
        assert len(part) or sizes[a:b].sum() < 60


# 7


def test_mixing_reaches_weights(spark, odd, none):
    docs = spark.createDataFrame([(i, f"text {i}", "en", "a" if i % 4 else "b", 8) for i in range(4000)], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    got = mixing.mix_sources(docs, {"a": 1.0, "b": 3.0})
    n = {r["source"]: r["count"] for r in got.groupBy("source").count().collect()}
    assert n["b"] / (n["a"] + n["b"]) == pytest.approx(0.75, abs=0.03) and got.count() == pytest.approx(4000, rel=0.06)
    counts = [r["count"] for r in got.filter("source = 'b'").groupBy("doc_id").count().collect()]
    assert np.sum(np.square(counts)) / 1000 == pytest.approx(3 + 9, rel=0.1)  # second moment of a Poisson number of mean 3
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, mixing.mix_sources(docs.orderBy("text"), {"a": 1.0, "b": 3.0}).collect()))
    assert mixing.mix_sources(odd).columns == odd.columns + ["copy_no"] and mixing.mix_sources(none).count() == 0
    assert mixing.mix_sources(docs, {"a": 1.0}).filter("source = 'b'").count() == 0


def test_mix_of_a_tiny_source(spark, monkeypatch):
    """Rates far beyond one part: counts near the mean, copies numbered without gaps, equal with blocks of any size."""
    rows = [(1, "x", "tiny"), (1, "x", "tiny"), (2, "", "tiny"), (3, None, "tiny"), (4, "many words " * 400, "big"), (5, "x", "null"), (6, "x", "null")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    rates = {r["source"]: r for r in mixing.repetition_rates(docs, {"tiny": 1.0, "big": 1.0}, total_bytes=1e15).collect()}
    assert rates["tiny"]["parts"] == 2.5e14 / 32 and rates["tiny"]["mean"] == 32 and rates["null"]["rate"] == 0
    got = []
    for block, span in ((4096, 65536), (3, 2), (1, 7)):
        monkeypatch.setattr(mixing, "BLOCK", block)
        monkeypatch.setattr(mixing, "SPAN", span)
        got.append(sorted(map(tuple, mixing.mix_sources(docs, {"tiny": 1.0, "big": 1.0}).select("doc_id", "source", "text", "copy_no").collect()), key=str))
    assert got[0] == got[1] == got[2]
    copies = Counter((d, s, t) for d, s, t, _ in got[0])
    # 4402 bytes; the tiny source has 2 of them, so a mean of 1100.5 copies
    assert all(abs(copies[d, "tiny", t] / w - 1100.5) < 200 for d, t, w in ((1, "x", 2), (2, "", 1), (3, None, 1)))
    assert {c for d, _, _, c in got[0] if d == 2} == set(range(copies[2, "tiny", ""]))



def test_mixing_inverts_large_means_in_parts(spark):
    docs = spark.createDataFrame([(i, "x" if i < 50 else "y" * 100, "en", "s" if i < 50 else "t", 1) for i in range(150)], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    n = {r["source"]: r["count"] for r in mixing.mix_sources(docs).groupBy("source").count().collect()}
    assert n["s"] == pytest.approx(10050 / 2, rel=0.06)


# 8


def test_language(spark, odd, none):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = docs.select("doc_id", "lang").join(langid.identify(docs), "doc_id").toPandas()
    assert (got.held_out == got.doc_id.map(lambda d: zlib.crc32(str(d).encode()) % 4 == 2)).all()
    assert (got[got.held_out].lang == got[got.held_out].lang_pred).mean() > 0.97 and got.score.between(0, 1).all()
    found = langid.identify(odd).toPandas()
    assert len(found) == odd.count() and (found[found.doc_id.isin([100, 101, 102, 106])].lang_pred == "und").all()
    assert langid.identify(none).count() == 0


def test_bloom_filters_return_all_languages():
    grams = np.arange(1, 400, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    of = np.arange(399) % 70
    filters = langid.LanguageFilters.build([f"l{i:02}" for i in range(70)], np.concatenate([grams, grams]), np.concatenate([of, (of + 1) % 70]))
    masks = filters.masks(grams)
    assert all(masks[i, (of[i] + d) % 70 // 64] >> np.uint64((of[i] + d) % 70 % 64) & np.uint64(1) for i in range(399) for d in (0, 1))


# 9


@pytest.mark.parametrize("shards", [1, 7, 40])
def test_shards(spark, shards):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = docs.select("doc_id", "text").join(sharding.shard_documents(docs, shards), "doc_id").toPandas()
    assert (got["size"] == got.text.map(lambda t: len(t.encode()) + 16)).all() and (got.text_crc32 == got.text.map(lambda t: zlib.crc32(t.encode()))).all()
    sums = got.groupby("shard")["size"].sum()
    assert sorted(sums.index) == list(range(shards)) and sums.max() - sums.min() < 2 * got["size"].max()
    assert all(sorted(g.slot) == list(range(len(g))) for _, g in got.groupby("shard"))


def test_shards_of_odd_rows(spark, odd, none, monkeypatch):
    monkeypatch.setattr(sharding, "SLOT_ROWS", 3)
    got = sharding.shard_documents(odd, target_bytes=30_000, keep=["doc_id", "size", "node"]).toPandas()
    assert len(got) == odd.count() and all(sorted(g.slot) == list(range(len(g))) for _, g in got.groupby("shard"))
    assert sharding.shard_documents(none, 40).count() == 0


# 10


def test_nearest_examples_are_exact():
    rng = np.random.default_rng(4)
    texts = [" ".join(f"{'abcdefghij'[rng.integers(10)]}{'klmnop'[rng.integers(6)]}{'qrstuv'[rng.integers(6)]}" for _ in range(rng.integers(1, 60))).encode() for _ in range(500)]
    model = toxicity.build_examples(texts, (np.arange(500) % 5 == 0).astype(int), np.arange(500), 0.2)
    for w, k in list(toxicity.terms(texts))[:60]:
        at, weight = model.vector(w, k)
        ids, sims = model.nearest(at, weight)
        full = weight @ model.weights[at]
        assert np.allclose(np.sort(full)[::-1][:15], sims, atol=1e-5) and np.allclose(full[ids], sims, atol=1e-5)


def test_toxicity(spark, odd, none):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    got = toxicity.score_toxicity(docs, labels).join(labels, "doc_id").toPandas()
    assert (got.held_out == got.doc_id.map(lambda d: zlib.crc32(str(d).encode()) % 5 == 0)).all()
    held = got[got.held_out]
    rank = held.score.rank()
    toxic = held.toxic == 1
    area = (rank[toxic].sum() - toxic.sum() * (toxic.sum() + 1) / 2) / (toxic.sum() * (~toxic).sum())
    assert area > 0.93 and held[~toxic].predicted.mean() < 0.03 and (got.predicted == (got.score >= 0.5)).all()
    found = toxicity.score_toxicity(odd, labels).toPandas()
    assert len(found) == odd.count() and found.score.between(0, 1).all()
    assert toxicity.score_toxicity(none, labels).count() == 0 and toxicity.score_toxicity(odd, labels.limit(0)).count() == odd.count()


def test_toxicity_ranks_small_tables():
    rng = np.random.default_rng(5)
    noise = ["w" + "".join(chr(97 + int(c)) for c in str(i)) for i in range(3000)]
    toxic = rng.random(600) < 0.15
    texts = [" ".join([*rng.choice(noise, 150), *([rng.choice(["scumx", "trashx", "clownx", "moronx"])] if t else [])]).encode() for t in toxic]
    model = toxicity.build_examples(texts[:400], toxic[:400].astype(int), np.arange(400), float(toxic[:400].mean()))
    scores = np.array([model.score(model.nearest(*model.vector(w, k))) for w, k in toxicity.terms(texts[400:])])
    held = toxic[400:]
    assert (scores[held][:, None] > scores[~held]).mean() > 0.95


def test_toxicity_fit_does_not_overshoot():
    # votes that part the labels but for one row in fifty, with rare labels weighed up
    y = (np.arange(400) % 8 == 0).astype(float)
    vote = np.where(np.arange(400) % 50 == 3, 1 - y, y)
    for x in (np.column_stack([np.ones(400), vote, vote * 0.3]), np.column_stack([np.ones(400), y, y * 0.3]), np.column_stack([np.ones(400), y, 1 - y])):
        slope = toxicity.calibrate(x, y, np.where(y == 1, 0.125 / y.mean(), 1.0) * 1.0, np.array([-2.0, 0.0, 0.0]))
        scores = x @ slope
        assert np.isfinite(slope).all() and (slope[1:] >= 0).all() and scores[y == 1].mean() > scores[y == 0].mean() + 1
