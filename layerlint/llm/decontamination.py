"""Benchmark passages in documents: SimHash of item-sized windows, multi-index Hamming search, exact weighted comparison.

Window lengths are classes of item lengths. An item of m words belongs to the largest class of at most three quarters of m (or
its whole length if it is short) and is listed by the fingerprint of each of its windows of that length. Documents are
fingerprinted every quarter class, which is less than the windows an item has, so one window of any verbatim copy equals a
listed one. Fingerprints are 64 sums of signs of word pairs. Four tables by 16-bit block list every block value within two
bits of a listed one: two fingerprints at most ``RADIUS`` = 4 * 2 + 3 bits apart agree within two bits in one block, so all are
found. Each hit aligns the item with the text, and the multisets of their shingles are compared exactly, weighted by rarity
among items.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from layerlint.llm.words import mix, shingle_sets, slices, utf8, window_hashes, word_hashes
from layerlint.session import prepare, written

RADIUS = 11
WIDTH = 5
BATCH_ITEMS = 1024  # items searched in one pass over the documents
BATCH_WORDS = 1 << 18
ROWS = 8192  # words whose signs are summed at a time
SIDE = 128  # of these, words in a row of the sums
_FLIPS = np.array([0, *[1 << i for i in range(16)], *[(1 << i) | (1 << j) for i, j in combinations(range(16), 2)]], dtype=np.uint32)


def classes(longest: int) -> list[int]:
    """Window lengths: 1 to 5, then about 1.4 times as long each."""
    out = [1, 2, 3, 4, 5]
    while out[-1] < longest:
        out.append(max(out[-1] + 1, math.ceil(out[-1] * 1.4)))
    return out


def class_of(words: int, sizes: list[int]) -> int:
    most = max(int(0.75 * words), min(words, 5))
    return max(s for s in sizes if s <= most)


def stride(length: int) -> int:
    return max(1, length // 4)


def pairs_of(words: np.ndarray) -> np.ndarray:
    """Features: neighbouring words; a single word stands for itself."""
    return mix(words[:-1] * np.uint64(3) + words[1:]) if len(words) > 1 else words


def cumulated(features: np.ndarray) -> np.ndarray:
    """How many of the first n features have each of the 64 bits set, for n = 0, 1, ...

    Sums run inside blocks of ``SIDE`` features, all blocks at a time, and then over the blocks.
    """
    blocks = -(-len(features) // SIDE)
    whole = np.zeros(blocks * SIDE, np.uint64)
    whole[: len(features)] = features
    sums = np.zeros((blocks * SIDE + 1, 64), np.int32)
    inside = sums[1:].reshape(blocks, SIDE, 64)
    inside[...] = np.unpackbits(whole.view(np.uint8).reshape(-1, 8), axis=1).reshape(blocks, SIDE, 64)
    for i in range(1, SIDE):
        inside[:, i] += inside[:, i - 1]
    inside[1:] += np.cumsum(inside[:-1, -1], axis=0, dtype=np.int32)[:, None]
    return sums


def fingerprints(features: np.ndarray, wanted: list[tuple[np.ndarray, int]]) -> list[np.ndarray]:
    """For each (starts in ascending order, length): SimHash of ``length`` features from each start. Ties of a bit are zero.

    The features are cumulated once, a stretch at a time, for all lengths.
    """
    out = [np.empty(len(starts), np.uint64) for starts, _ in wanted]
    longest = max((length for _, length in wanted), default=1)
    rows = max(ROWS, longest)
    for base in range(0, len(features), rows):
        parts = [np.searchsorted(starts, [base, base + rows]) for starts, _ in wanted]
        if all(low == high for low, high in parts):
            continue
        sums = cumulated(features[base : base + rows + longest])
        for (starts, length), (low, high), prints in zip(wanted, parts, out):
            own = starts[low:high] - base
            ones = sums[own + length] - sums[own]
            prints[low:high] = np.packbits(2 * ones > length, axis=1).view(np.uint64).ravel()
    return out


@dataclass
class ClassIndex:
    """Listed windows of one length: fingerprints, their items and offsets, and a table per block."""

    length: int
    prints: np.ndarray
    items: np.ndarray
    offsets: np.ndarray
    tables: list[tuple[np.ndarray, np.ndarray]]

    @staticmethod
    def build(length: int, prints: np.ndarray, items: np.ndarray, offsets: np.ndarray) -> ClassIndex:
        tables = []
        for b in range(4):
            near = ((prints >> np.uint64(16 * b)) & np.uint64(0xFFFF)).astype(np.uint32)[:, None] ^ _FLIPS
            order = np.argsort(near.ravel(), kind="stable")
            first = np.searchsorted(near.ravel()[order], np.arange(65537))
            tables.append((first.astype(np.int64), (order // len(_FLIPS)).astype(np.int32)))
        return ClassIndex(length, prints, items, offsets, tables)

    def search(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All (query, listed window, distance) within the radius, some more than once."""
        out = []
        for b, (first, listed) in enumerate(self.tables):
            block = ((prints >> np.uint64(16 * b)) & np.uint64(0xFFFF)).astype(np.int64)
            low = first[block]
            sizes = first[block + 1] - low
            query = np.repeat(np.arange(len(prints)), sizes)
            entry = listed[np.repeat(low - np.cumsum(sizes) + sizes, sizes) + np.arange(len(query))]
            distance = np.bitwise_count(prints[query] ^ self.prints[entry])
            near = distance <= RADIUS
            out.append((query[near], entry[near], distance[near]))
        return tuple(np.concatenate(x) for x in zip(*out))


class Items:
    """Benchmark items ready for search.

    ``seen`` has the number of items that hold a shingle and ``total`` that of items with words, both over the whole benchmark
    of which these items are a part; without them the items are all.
    """

    def __init__(self, ids: list[int | None], texts: list[bytes | None], width: int = WIDTH, percent: int = 75, seen: dict[int, int] | None = None, total: int | None = None):
        words, counts = word_hashes(texts)
        self.width, self.percent = width, percent
        self.ids, self.words, at = [], [], 0
        for i, n in zip(ids, counts.tolist()):
            if n:
                self.ids.append(i)
                self.words.append(words[at : at + n])
            at += n
        self.shingles = [Counter(window_hashes(w, width).tolist()) for w in self.words]
        seen = Counter(s for x in self.shingles for s in x) if seen is None else seen
        total = len(self.ids) if total is None else total
        self.rarity = {s: math.log(1 + total / k) for s, k in seen.items()}
        self.foreign = math.log(1 + total)
        self.mass = [sum(self.rarity[s] * k for s, k in x.items()) for x in self.shingles]
        sizes = classes(max(map(len, self.words), default=1))
        by: dict[int, list] = {}
        for i, w in enumerate(self.words):
            length = class_of(len(w), sizes)
            features = pairs_of(w) if length > 1 else w
            n = len(w) - length + 1
            by.setdefault(length, []).append((fingerprints(features, [(np.arange(n), max(length - 1, 1))])[0], np.full(n, i), np.arange(n)))
        self.indexes = [ClassIndex.build(length, *(np.concatenate(x) for x in zip(*parts))) for length, parts in sorted(by.items())]

    def similarity(self, item: int, window: np.ndarray) -> float:
        """Weighted Jaccard similarity of the multisets of shingles."""
        own, common, other = self.shingles[item], 0.0, 0.0
        for s, k in Counter(window_hashes(window, self.width).tolist()).items():
            w = self.rarity.get(s, self.foreign)
            other += w * k
            common += w * min(k, own.get(s, 0))
        return common / (self.mass[item] + other - common) if common else 0.0

    def search(self, words: np.ndarray, counts: np.ndarray) -> Iterator[tuple[int, int, float, int, int, int]]:
        """(text, item, similarity, start, words, distance) of texts that follow each other, the best per text and item."""
        edges = np.concatenate([[0], np.cumsum(counts)])
        pairs = pairs_of(words) if len(words) > 1 else words
        windows = []
        for index in self.indexes:
            n = np.maximum(counts - index.length + 1, 0)
            step = stride(index.length)
            per = (n + step - 1) // step
            text = np.repeat(np.arange(len(counts)), per)
            windows.append((index, text, edges[text] + step * (np.arange(len(text)) - np.repeat(np.cumsum(per) - per, per))))
        # a word alone stands for itself, so windows of one word have features of their own
        single, several = [w for w in windows if w[0].length == 1], [w for w in windows if w[0].length > 1]
        prints = fingerprints(words, [(starts, 1) for _, _, starts in single]) + fingerprints(pairs, [(starts, index.length - 1) for index, _, starts in several])
        hits = [np.empty((4, 0), np.int64)]
        for (index, text, starts), own in zip(single + several, prints):
            query, entry, distance = index.search(own)
            hits.append(np.stack([text[query], index.items[entry], starts[query] - index.offsets[entry], distance.astype(np.int64)]))
        hits = np.concatenate(hits, axis=1)
        hits = hits[:, np.lexsort(hits[::-1])]
        # the nearest hit of each text, item and alignment
        first = np.ones(hits.shape[1], bool)
        first[1:] = (hits[:3, 1:] != hits[:3, :-1]).any(axis=0)
        best: dict[tuple[int, int], tuple] = {}
        for t, item, start, d in hits[:, first].T.tolist():
            size = len(self.words[item])
            low, high = max(start, int(edges[t])), min(start + size, int(edges[t + 1]))
            sim = self.similarity(item, words[low:high])
            if 100 * sim >= self.percent - 1e-9 and sim > best.get((t, item), (0.0,))[0]:
                best[t, item] = (sim, low - int(edges[t]), high - low, d)
        for (t, item), found in best.items():
            yield t, item, *found


def _shingles(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(mark, shingle) of the distinct shingles of each item."""
    for batch in slices(batches, "text", 1 << 19):
        for i, own in enumerate(shingle_sets(batch.column("text").to_pylist(), WIDTH)):
            for at in range(0, len(own), 1 << 16):
                part = own[at : at + (1 << 16)].view(np.int64)
                yield pa.RecordBatch.from_arrays([batch.column("mark").take(pa.array(np.full(len(part), i))), pa.array(part)], names=["mark", "shingle"])


def counted_items(benchmark: DataFrame) -> DataFrame:
    """item_id, text, and for texts with words the shingles and how many items of the whole benchmark hold each."""
    listed = benchmark.filter("text is not null").select("item_id", F.col("text").cast("binary").alias("text")).withColumn("mark", F.sha2("text", 256))
    each = written(listed.select("mark", "text").mapInArrow(_shingles, "mark string, shingle bigint"), "benchmark-shingles")
    counts = each.groupBy("shingle").agg(F.count(F.lit(1)).alias("df"))
    per = each.distinct().join(counts, "shingle").groupBy("mark").agg(F.collect_list(F.struct("shingle", "df")).alias("x"))
    return written(listed.join(per, "mark", "left").select("item_id", "text", F.col("x.shingle").alias("shingles"), F.col("x.df").alias("df")), "benchmark-items")


def item_batches(benchmark: DataFrame) -> Iterator[Items]:
    """The benchmark in slices of bounded size, each fit for one pass: at most ``BATCH_ITEMS`` items and ``BATCH_WORDS`` words or one item."""
    items = counted_items(benchmark)
    total = items.filter("shingles is not null").count()
    ids, texts, seen, room = [], [], {}, BATCH_WORDS
    for row in items.orderBy("item_id", "text").toLocalIterator():
        size = len(row["text"]) // 4
        if ids and (len(ids) == BATCH_ITEMS or room < size):
            yield Items(ids, texts, seen=seen, total=total)
            ids, texts, seen, room = [], [], {}, BATCH_WORDS
        ids.append(row["item_id"])
        texts.append(bytes(row["text"]))
        seen.update(zip((s % (1 << 64) for s in row["shingles"] or []), row["df"] or []))
        room -= size
    if ids:
        yield Items(ids, texts, seen=seen, total=total)


def find_passages(docs: DataFrame, benchmark: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per row of ``docs`` and item it holds: ``keep``, item_id, similarity, start_word, n_words, distance.

    An item is held if a window of its length has a weighted shingle similarity of 0.75 or more; the best window is given.
    item_id has the type it has in ``benchmark``. Words are lower-cased. Empty and null texts and items hold nothing; repeated rows are searched each, repeated items give a
    row each. Items come to the driver in slices of bounded size and each slice is one pass over the documents, so a benchmark
    of any size can be used. The similarity's weights are counted over the whole benchmark, so they do not depend on the slices.
    """
    spark = prepare(docs.sparkSession)
    rows = docs.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], F.col("text").alias("text"))
    kept = [f"k{i}" for i in range(len(keep))]
    schema = ", ".join([f"{k} {rows.schema[k].dataType.simpleString()}" for k in kept] + [f"item_id {benchmark.schema['item_id'].dataType.simpleString()}, similarity double, start_word bigint, n_words bigint, distance int"])

    id_type = to_arrow_type(benchmark.schema["item_id"].dataType)

    def passes(shared):
        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            items = shared.value
            for batch in slices(batches, "text", 1 << 19):
                words, counts = word_hashes(utf8(batch.column("text")))
                found = list(items.search(words, counts))
                if found:
                    t, item, sim, start, n, d = zip(*found)
                    yield pa.RecordBatch.from_arrays(
                        [*[batch.column(c).take(pa.array(t)) for c in kept], pa.array([items.ids[i] for i in item], id_type), pa.array(sim, pa.float64()),
                         pa.array(start, pa.int64()), pa.array(n, pa.int64()), pa.array(d, pa.int32())],
                        names=[*kept, "item_id", "similarity", "start_word", "n_words", "distance"],
                    )

        return run

    out = None
    for items in item_batches(benchmark):
        part = rows.mapInArrow(passes(spark.sparkContext.broadcast(items)), schema)
        out = part if out is None else out.union(part)
    if out is None:
        out = spark.createDataFrame([], schema)
    return out.withColumnsRenamed(dict(zip(kept, keep)))


def without_passages(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows of ``docs`` for which ``find_passages`` has no row, by the same search.

    What a row holds depends on its text alone, so each row is kept or left out where it is read: nothing is joined or shuffled. The
    slices of the benchmark follow each other, and a row that is left out by one is not searched by the next.
    """
    spark = prepare(docs.sparkSession)

    def clean(shared):
        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            items = shared.value
            for batch in slices(batches, "text", 1 << 19):
                words, counts = word_hashes(utf8(batch.column("text")))
                free = np.ones(batch.num_rows, bool)
                free[[t for t, *_ in items.search(words, counts)]] = False
                yield batch.filter(pa.array(free))

        return run

    for items in item_batches(benchmark):
        docs = docs.mapInArrow(clean(spark.sparkContext.broadcast(items)), docs.schema)
    return docs
