"""Spelling variants: words one insertion, deletion or replacement apart, found in a trie of letter counts.

Letters are put into groups, and a word's vector says how many letters of each group it has. One edit adds a letter to one
group, takes one from a group, or does both: the vectors differ by a surplus of at most one and a deficit of at most one. Words
are arranged in a trie with one group's count per step and the length as the last one; a search goes down from the root with
a budget of one surplus and one deficit, spends it where a count is off by one, and ends at leaves whose words are verified.
Of a leaf only words with the same first or the same last half can be one edit away, so these are looked up by hash and then
compared letter by letter.

The trie does not live in one place. Its top is cut where a node holds no more than a bounded number of words: such a node is a
*cell*. The top goes to the tasks that send each word to its own cell and to the cells its budget reaches; each cell's own
part of the trie is built where its words meet. A leaf with more words than a cell may hold is dealt to several slices, all of
which are searched.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import batched, chain, groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from layerlint.llm.words import _cut as parts_of, mix, powers, slices, utf8
from layerlint.session import prepare, written

#: letter groups in the order of the trie; every other letter counts in the last one
GROUPS = ("e", "a", "i", "n", "t", "r", "s", "o", "u", "l", "éêëç", "cd", "mp", "bghv", "fjkqwxyz", "")
CELL = 2048  # words of a cell; with over 4096 times as many words, a 4096th of them, so that the number of cells is bounded
CELLS = 4096
MOST = 62  # counts above are taken as this one: differences never grow by it
BLOCK = 1024  # words searched at a time
HELD = 1 << 17  # words a task counts before it passes them on; only speed depends on it
ROOM = 1 << 20  # letters compared at a time
_BASE = 0xD1342543DE82EF95
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_GROUP_OF = np.full(0x110000, len(GROUPS) - 1, np.uint8)
for _i, _letters in enumerate(GROUPS):
    for _c in _letters:
        _GROUP_OF[ord(_c)] = _i


class Words:
    """Words as one array of letters, with their vectors and hashes of their parts."""

    def __init__(self, words: list[str]):
        self.words = words
        self.sizes = np.array([len(w) for w in words], np.int64)
        self.at = np.concatenate([[0], np.cumsum(self.sizes)])
        self.letters = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        owner = np.repeat(np.arange(len(words)), self.sizes)
        counts = np.bincount(owner * len(GROUPS) + _GROUP_OF[self.letters], minlength=len(words) * len(GROUPS))
        self.counts = np.minimum(counts.reshape(-1, len(GROUPS)), MOST).astype(np.int64)
        self.sums = np.zeros(len(self.letters) + 1, np.uint64)
        np.cumsum(mix(self.letters.astype(np.uint64) + np.uint64(1)) * powers(_BASE, len(self.letters)), out=self.sums[1:])

    def _part(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        return mix((self.sums[high] - self.sums[low]) * powers(_BASE_INVERSE, len(self.letters) + 1)[low])

    def heads(self, which: np.ndarray, size: np.ndarray) -> np.ndarray:
        return self._part(self.at[which], self.at[which] + size)

    def tails(self, which: np.ndarray, size: np.ndarray) -> np.ndarray:
        return self._part(self.at[which + 1] - size, self.at[which + 1])


def one_edit(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """Whether rows of letters (padded with 0) are exactly one insertion, deletion or replacement apart."""
    swap = size_a > size_b
    short, long = np.where(swap[:, None], b, a), np.where(swap[:, None], a, b)
    n = np.minimum(size_a, size_b)
    same = short[:, :-1] == long[:, :-1]
    shifted = short[:, :-1] == long[:, 1:]
    inside = np.arange(same.shape[1]) < n[:, None]
    first = np.argmax(~same | ~inside, axis=1)  # the first letter that differs, or the end
    differ = (~same & inside).sum(axis=1)
    behind = np.arange(same.shape[1]) >= first[:, None]
    return np.where(size_a == size_b, differ == 1, (np.abs(size_a - size_b) == 1) & ~(behind & inside & ~shifted).any(axis=1))


class Trie:
    """Nodes of a trie by step: sorted keys parent * 64 + count; a node's number is its place."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels

    @staticmethod
    def of(counts: np.ndarray) -> tuple[Trie, np.ndarray]:
        """The trie of the rows, and the leaf of each."""
        node, levels = np.zeros(len(counts), np.int64), []
        for d in range(counts.shape[1]):
            keys, node = np.unique(node * 64 + counts[:, d], return_inverse=True)
            levels.append(keys)
        return Trie(levels), node

    def search(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(row, node, surplus left, deficit left) of all leaves within the budget of one each."""
        row, node = np.arange(len(counts)), np.zeros(len(counts), np.int64)
        surplus = deficit = np.ones(len(counts), bool)
        for d, keys in enumerate(self.levels):
            row, node, surplus, deficit = step(keys, row, node, surplus, deficit, counts[row, d])
        return row, node, surplus, deficit


def step(keys: np.ndarray, row: np.ndarray, node: np.ndarray, surplus: np.ndarray, deficit: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, ...]:
    """One step down: to the child with the same count, one more (spends the surplus) or one less (spends the deficit)."""
    out = []
    for delta, free in ((0, None), (1, surplus), (-1, deficit)):
        pick = slice(None) if free is None else free & (count + delta >= 0)
        want = node[pick] * 64 + np.minimum(count[pick] + delta, MOST + 1)
        at = np.minimum(np.searchsorted(keys, want), len(keys) - 1)
        hit = keys[at] == want
        out.append((row[pick][hit], at[hit], surplus[pick][hit] & (delta != 1), deficit[pick][hit] & (delta != -1)))
    return tuple(np.concatenate(x) for x in zip(*out))


class Cell:
    """The words that one task searches, in a trie of their vectors and lengths."""

    def __init__(self, words: list[str], counts: list[int]):
        self.words, self.n = Words(words), np.array(counts, np.int64)
        self.trie, node = Trie.of(self.words.counts)
        # a leaf is a vector and a length
        self.leaves, leaf = np.unique(np.stack([node, self.words.sizes], axis=1), axis=0, return_inverse=True)
        leaf = leaf.ravel()
        self.by_node = np.searchsorted(self.leaves[:, 0], np.arange(len(self.trie.levels[-1]) + 1))
        every, sizes = np.arange(len(words)), self.words.sizes
        even = every[(sizes % 2 == 0) & (sizes > 0)]
        self.tables = []
        for part in (Words.heads, Words.tails):
            # a query is at most one letter shorter, so halves of two sizes are wanted
            who = np.concatenate([every, even])
            half = np.concatenate([sizes // 2, sizes[even] // 2 - 1])
            key = self._key(leaf[who], half, part(self.words, who, half))
            order = np.argsort(key, kind="stable")
            self.tables.append((part, key[order], who[order]))

    @staticmethod
    def _key(leaf: np.ndarray, half: np.ndarray, part: np.ndarray) -> np.ndarray:
        return mix(part ^ mix(leaf.astype(np.uint64) * np.uint64(1 << 32) + half.astype(np.uint64)))

    def near(self, words: list[str]) -> Iterator[tuple[int, int]]:
        """(query, word of the cell) for all exactly one edit apart."""
        asked = Words(words)
        row, node, surplus, deficit = self.trie.search(asked.counts)
        low, high = self.by_node[node], self.by_node[node + 1]
        many = high - low
        at = np.repeat(low - np.cumsum(many) + many, many) + np.arange(many.sum())
        row = np.repeat(row, many)
        fits = np.abs(self.leaves[at, 1] - asked.sizes[row]) <= 1
        row, leaf = row[fits], at[fits]
        half = np.minimum(asked.sizes[row], self.leaves[leaf, 1]) // 2
        found = []
        for part, keys, who in self.tables:
            key = self._key(leaf, half, part(asked, row, half))
            first, last = np.searchsorted(keys, key, side="left"), np.searchsorted(keys, key, side="right")
            many = last - first
            entry = np.repeat(first - np.cumsum(many) + many, many) + np.arange(many.sum())
            found.append(np.repeat(row, many) * len(self.n) + who[entry])
        pairs = np.unique(np.concatenate(found))
        query, word = pairs // len(self.n), pairs % len(self.n)
        width = np.maximum(asked.sizes[query], self.words.sizes[word]) + 1
        order = np.argsort(width, kind="stable")
        query, word, width = query[order], word[order], width[order]
        while len(query):  # rows of about equal length, as many as fit
            many = max(1, int(np.searchsorted(width * np.arange(1, len(width) + 1), ROOM, side="right")))
            many = min(many, len(query))
            letters = [_padded(x, i[:many], int(width[many - 1])) for x, i in ((asked, query), (self.words, word))]
            yes = one_edit(*letters, asked.sizes[query[:many]], self.words.sizes[word[:many]])
            yield from zip(query[:many][yes].tolist(), word[:many][yes].tolist())
            query, word, width = query[many:], word[many:], width[many:]


def _padded(words: Words, which: np.ndarray, width: int) -> np.ndarray:
    out = np.zeros((len(which), width), np.uint32)
    size = words.sizes[which]
    inside = np.arange(width) < size[:, None]
    out[inside] = words.letters[np.repeat(words.at[which] - np.cumsum(size) + size, size) + np.arange(size.sum())]
    return out


def count_words(docs: DataFrame, pattern: str, least_length: int, least_count: int, key: str = "doc_id", text: str = "text", typos: int = 0) -> DataFrame:
    """word and n of the words that ``pattern`` finds in the whole texts, A-Z lower-cased, long and frequent enough.

    The pattern must not match white space. Null and empty texts have no words; every row counts, repeated ones too.
    With ``typos``, a word loses a letter in documents where CRC-32 of "key:word" is divisible by it: a fixture for tests.
    """
    prepare(docs.sparkSession)
    finder = re.compile(pattern)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in slices(batches, "text"):
            for own, raw in zip(batch.column("key").to_pylist(), utf8(batch.column("text"))):
                for part in parts_of((raw or b"").lower()):
                    if typos and own is not None:
                        for word, n in Counter(finder.findall(part.decode())).items():
                            h = zlib.crc32(f"{own}:{word}".encode())
                            held[word if h % typos else word[: h % len(word)] + word[h % len(word) + 1 :]] += n
                    else:
                        held.update(finder.findall(part.decode()))
                    if len(held) > HELD:
                        yield table(held)
                        held = Counter()
        yield table(held)

    def table(held: Counter) -> pa.RecordBatch:
        kept = {w: n for w, n in held.items() if len(w) >= least_length}
        return pa.RecordBatch.from_arrays([pa.array(kept.keys(), pa.string()), pa.array(kept.values(), pa.int64())], names=["word", "n"])

    rows = docs.select(F.col(key).cast("string").alias("key"), F.col(text).alias("text")).mapInArrow(run, "word string, n bigint")
    return rows.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


def _with_vectors(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A column vector: one character per group, chr(48 + count)."""
    for batch in slices(batches, "word", 1 << 20):
        counts = Words(batch.column("word").to_pylist()).counts
        text = (counts + 48).astype(np.uint32).tobytes().decode("utf-32-le")
        g = len(GROUPS)
        vectors = pa.array([text[i : i + g] for i in range(0, len(text), g)], pa.string())
        yield pa.RecordBatch.from_arrays([*batch.columns, vectors], names=[*batch.schema.names, "vector"])


def top_of(words: DataFrame, most: int) -> dict[str, int]:
    """Nodes at which the trie of ``words`` (with a column vector) is cut: {first counts of a vector: words}.

    Nodes of more than ``most`` words are opened, group by group; what comes to the driver is the children of opened nodes, so
    at most (words / most) * number of groups * ``MOST`` numbers.
    """
    cells: dict[str, int] = {}
    total = words.count()
    if total <= most:
        return {"": total}
    opened = [""]
    for d in range(1, len(GROUPS) + 1):
        node = F.substring("vector", 1, d)
        parents = words.sparkSession.createDataFrame([(x,) for x in opened], "parent string") if d > 1 else None
        rows = words.withColumn("parent", F.substring("vector", 1, d - 1))
        rows = rows.join(parents, "parent", "left_semi") if d > 1 else rows
        opened = []
        for prefix, n in rows.groupBy(node.alias("node")).agg(F.count(F.lit(1))).collect():
            if n > most and d < len(GROUPS):
                opened.append(prefix)
            else:
                cells[prefix] = n
        if not opened:
            break
    return cells


class Top:
    """The top of the trie, for sending words to cells."""

    def __init__(self, cells: dict[str, int], most: int):
        self.names = sorted(cells)
        self.slices = np.array([-(-cells[c] // most) for c in self.names], np.int64)
        deepest = max(map(len, self.names))
        nodes = {"": 0}
        self.levels, self.cell = [], [np.array([0 if "" in cells else -1])]
        place = {c: i for i, c in enumerate(self.names)}
        for d in range(1, deepest + 1):
            prefixes = {c[:d] for c in self.names if len(c) >= d}
            keys = sorted((nodes[p[:-1]] * 64 + ord(p[-1]) - 48, p) for p in prefixes)
            nodes = {p: i for i, (_, p) in enumerate(keys)}
            self.levels.append(np.array([k for k, _ in keys], np.int64))
            self.cell.append(np.array([place.get(p, -1) for _, p in keys], np.int64))

    def reach(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, cell, whether it is the row's own) of all cells within the budget."""
        row, node = np.arange(len(counts)), np.zeros(len(counts), np.int64)
        surplus = deficit = np.ones(len(counts), bool)
        out = []
        for d in range(len(self.cell)):
            if d:
                row, node, surplus, deficit = step(self.levels[d - 1], row, node, surplus, deficit, counts[row, d - 1])
            cell = self.cell[d][node]
            end = cell >= 0
            out.append((row[end], cell[end], (surplus & deficit)[end]))
            row, node, surplus, deficit = row[~end], node[~end], surplus[~end], deficit[~end]
        return tuple(np.concatenate(x) for x in zip(*out))


def near_words(words: DataFrame) -> DataFrame:
    """(word, near, near_n) for every ordered pair of words of the stored table (word, n) exactly one edit apart.

    Words must be different from each other. Equal, empty and single-letter words are no problem; a null word is left out.
    """
    spark = prepare(words.sparkSession)
    rows = words.filter("word is not null").select("word", "n")
    listed = written(rows.mapInArrow(_with_vectors, "word string, n bigint, vector string"), "spelling-vectors")
    most = max(CELL, -(-listed.count() // CELLS))
    shared = spark.sparkContext.broadcast(Top(top_of(listed, most), most))

    def send(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top = shared.value
        for batch in slices(batches, "word", 1 << 17):
            data = Words(batch.column("word").to_pylist())
            row, cell, own = top.reach(data.counts)
            hashes = data.heads(np.arange(len(data.words)), data.sizes)
            # a word is kept in one slice of its cell and searched in all slices of all cells it reaches
            many = top.slices[cell]
            part = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            row, cell, own, many = (np.repeat(x, many) for x in (row, cell, own, many))
            kept = own & (hashes[row] % many.astype(np.uint64) == part.astype(np.uint64))
            for at in range(0, len(row), 1 << 15):
                cut = slice(at, at + (1 << 15))
                taken = batch.select(["word", "n"]).take(pa.array(row[cut]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cell[cut], pa.int64()), pa.array(part[cut], pa.int64()), pa.array(~kept[cut]), *taken.columns], names=["cell", "part", "guest", "word", "n"],
                )

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows by cell and slice, its own words first; these are searched too, guests are only searched."""
        rows = (r for batch in batches for r in zip(*(x.to_pylist() for x in batch.columns)))
        for _, group in groupby(rows, key=lambda r: r[:2]):
            own, first = [], []
            for r in group:
                if r[2]:
                    first = [r]
                    break
                own.append((r[3], r[4]))
            if not own:  # a slice that got none
                continue
            cell = Cell(*map(list, zip(*own)))
            for block in batched(chain((w for w, _ in own), (r[3] for r in chain(first, group))), BLOCK):
                found = [(block[q], *own[w]) for q, w in cell.near(list(block))]
                if found:
                    word, near, n = zip(*found)
                    yield pa.RecordBatch.from_arrays([pa.array(word, pa.string()), pa.array(near, pa.string()), pa.array(n, pa.int64())], names=["word", "near", "near_n"])

    sent = listed.mapInArrow(send, "cell bigint, part bigint, guest boolean, word string, n bigint")
    together = sent.repartition("cell", "part").sortWithinPartitions("cell", "part", "guest")
    return together.mapInArrow(search, "word string, near string, near_n bigint")


def variants(words: DataFrame, ratio: int = 5) -> DataFrame:
    """word, form, root, n, n_near and form_n of the stored table (word, n).

    The form is the near word of largest n (ties: the smallest word), if that is ``ratio`` (2 or more) times the word's n at
    least. The root is what forms lead to, the word itself if it has none. As n grows by the ratio each time, chains are short.
    """
    best = near_words(words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), "near")).alias("best"))
    rows = words.filter("word is not null").select("word", "n").join(best, "word", "left")
    rows = rows.withColumn("form", F.when(-F.col("best.minus") >= ratio * F.col("n"), F.col("best.near")))
    rows = written(rows.select("word", "form", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"), F.when(F.col("form").isNotNull(), -F.col("best.minus")).alias("form_n")), "spelling-forms")
    links = rows.filter("form is not null").select("word", F.col("form").alias("root"))
    while True:  # every word jumps to the root of its root, so the number of rounds is the logarithm of the longest chain
        further = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        links = written(links.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        if links.filter("moved").isEmpty():
            break
        links = links.drop("moved")
    return rows.join(links.select("word", "root"), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
