"""Line dedup by pairwise alignment of overlapping documents.

Each line points to the first document that has it, so a document is paired with the first holders of its lines: linear in the
lines, however many documents share one. A pair is aligned if it shares a rare line, several lines, or enough text. Besides, a
document is aligned with the first holder of every line and run of lines that is long enough to be deleted, whatever its
frequency. From each line only the shortest such runs that start and end there count: at most two a line, and each line of a
longer common block is in one that lies in the block. Alignment is a patience diff: lines that are unique in both documents and in the same order are anchors, and the stretches between them
are aligned the same way; where no line is unique in both, the k-th occurrence of a run of lines that is long enough, or of a
line, meets the k-th one. Aligned blocks with enough text are deleted from the later document.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from layerlint.llm.words import mix, powers
from layerlint.session import prepare, written

RARE = 8  # documents that a rare line has at most
SEVERAL = 3  # lines of any frequency
ENOUGH = 250  # characters of shared lines of any frequency
LEAST_BLOCK = 60  # characters of a block that is deleted
BLANK = 0  # hash of a line without text
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


def anchors(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Positions of lines unique in both, in the longest common order."""
    in_a, in_b = Counter(a), Counter(b)
    at = {x: i for i, x in enumerate(a) if in_a[x] == 1 and x != BLANK}
    return rising([(at[x], j) for j, x in enumerate(b) if in_b[x] == 1 and x in at])


def repeats(a: list, b: list) -> list[tuple[int, int]]:
    """Positions of the k-th occurrences of what both have, in the longest common order. None stands for nothing."""

    def numbered(values: list) -> Iterator[tuple]:
        seen: Counter = Counter()
        for i, x in enumerate(values):
            if x is not None and x != BLANK:
                seen[x] += 1
                yield i, (x, seen[x])

    at = {x: i for i, x in numbered(a)}
    return rising([(at[x], j) for j, x in numbered(b) if x in at])


def shortest_runs(lines: list[int], sizes: dict[int, int], least: int) -> list[int]:
    """End of the shortest run of ``least`` characters from each line; 0 where there is none, or a line has no size."""
    ends, end, size, till = [], 0, 0, len(lines)
    unsized = [i for i, x in enumerate(lines) if x not in sizes][::-1]
    for i, x in enumerate(lines):
        while unsized and unsized[-1] < i:
            unsized.pop()
        till = unsized[-1] if unsized else len(lines)
        if end < i or till == i:
            end, size = i, 0
        while size < least and end < till:
            size += sizes[lines[end]]
            end += 1
        ends.append(end if size >= least and x != BLANK and till > i else 0)
        if end > i:
            size -= sizes[x]
    return ends


def rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest part of the pairs, given by their second position, in which the first one rises too."""
    tops, piles, back = [], [], []
    for k, (i, _) in enumerate(pairs):
        p = bisect_left(tops, i)
        back.append(piles[p - 1] if p else None)
        if p == len(tops):
            tops.append(i)
            piles.append(k)
        else:
            tops[p], piles[p] = i, k
    out, k = [], piles[-1] if piles else None
    while k is not None:
        out.append(pairs[k])
        k = back[k]
    return out[::-1]


def patience(a: list[int], b: list[int], sizes: list[int] | None = None, least: int = 0) -> list[tuple[int, int, int]]:
    """Aligned blocks (start in a, start in b, lines), in order.

    A stretch without a line unique in both is aligned by occurrences: of runs that have ``least`` characters by the sizes of
    b's lines, if given, and where none is common, of lines.
    """
    matched: list[tuple[int, int]] = []
    known = dict(zip(b, sizes)) if sizes is not None else {}
    ends: list[list[int]] = []

    def runs(side: int, low: int, high: int) -> list[tuple[int, ...] | None]:
        lines = (a, b)[side]
        return [tuple(lines[k : ends[side][k]]) if 0 < ends[side][k] <= high else None for k in range(low, high)]

    waiting = [(0, len(a), 0, len(b))]
    while waiting:
        i, m, j, n = waiting.pop()
        while i < m and j < n and a[i] == b[j]:
            matched.append((i, j))
            i, j = i + 1, j + 1
        while i < m and j < n and a[m - 1] == b[n - 1]:
            m, n = m - 1, n - 1
            matched.append((m, n))
        if i == m or j == n:
            continue
        found = anchors(a[i:m], b[j:n])
        if not found and sizes is not None:
            ends = ends or [shortest_runs(x, known, least) for x in (a, b)]
            free = (0, 0)
            for x, y in repeats(runs(0, i, m), runs(1, j, n)):
                if x >= free[0] and y >= free[1]:
                    size = ends[1][j + y] - j - y
                    found += [(x + k, y + k) for k in range(size)]
                    free = (x + size, y + size)
        found = found or repeats(a[i:m], b[j:n])
        last = (i, j)
        for x, y in found:
            matched.append((i + x, j + y))
            waiting.append((last[0], i + x, last[1], j + y))
            last = (i + x + 1, j + y + 1)
        if found:
            waiting.append((last[0], m, last[1], n))
    matched.sort()
    blocks: list[list[int]] = []
    for i, j in matched:
        if blocks and blocks[-1][0] + blocks[-1][2] == i and blocks[-1][1] + blocks[-1][2] == j:
            blocks[-1][2] += 1
        else:
            blocks.append([i, j, 1])
    return [tuple(x) for x in blocks]


def run_hashes(lines: np.ndarray, sizes: np.ndarray, least: int) -> np.ndarray:
    """Hashes of a document's runs of two lines or more, each the shortest of ``least`` characters that starts or ends at a line."""
    n = len(lines)
    total = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    text = np.flatnonzero(lines != BLANK)
    ends = np.searchsorted(total, total[text] + least, side="left")
    starts = np.searchsorted(total, total[text + 1] - least, side="right") - 1
    low = np.concatenate([text[ends <= n], starts[starts >= 0]])
    high = np.concatenate([ends[ends <= n], text[starts >= 0] + 1])
    several = high - low > 1
    spans = np.unique(low[several] * (n + 1) + high[several])
    low, high = spans // (n + 1), spans % (n + 1)
    # the sum of line k times base ** k over a run, divided by the power of its first line: the same for equal runs
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(lines.view(np.uint64) + np.uint64(1)) * powers(_BASE, n), dtype=np.uint64)])
    return np.unique(mix((sums[high] - sums[low]) * powers(_BASE_INVERSE, n + 1)[low] + (high - low).astype(np.uint64)))


def _runs(least: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines, sizes = batch.column("lines"), batch.column("sizes")
            hashes, edges, text = lines.values.to_numpy(zero_copy_only=False), lines.offsets.to_numpy(), sizes.values.to_numpy(zero_copy_only=False)
            second = sizes.offsets.to_numpy()
            found = [run_hashes(hashes[a:b], text[c:d], least) for a, b, c, d in zip(edges, edges[1:], second, second[1:])]
            row = pa.array(np.repeat(np.arange(len(found)), [len(x) for x in found]))
            runs = np.concatenate(found).view(np.int64) if found else np.zeros(0, np.int64)
            for at in range(0, len(runs), 1 << 16):
                own = row.slice(at, 1 << 16)
                yield pa.RecordBatch.from_arrays([batch.column("key").take(own), batch.column("h").take(own), pa.array(runs[at : at + (1 << 16)])], names=["key", "h", "run"])

    return run


def _align(least: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            gone = []
            for a, b, sizes in zip(batch.column("earlier").to_pylist(), batch.column("lines").to_pylist(), batch.column("sizes").to_pylist()):
                own = []
                for _, j, n in patience(a, b, sizes, least):
                    if sum(sizes[j : j + n]) >= least:
                        own += range(j, j + n)
                gone.append(own)
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("h"), pa.array(gone, pa.list_(pa.int32()))], names=["key", "h", "gone"])

    return run


def dedup_lines(docs: DataFrame, rare: int = RARE, several: int = SEVERAL, enough: int = ENOUGH, least_block: int = LEAST_BLOCK) -> DataFrame:
    """All rows with text (aligned blocks deleted), n_lines, n_deleted, n_partners and doc_id.

    Lines are parted by ``\\n`` and compared whole. The earlier document is the one with the smaller doc_id; rows of the same
    doc_id are not compared with each other, and each loses what its own text shares with earlier ones. A row without id is
    left as it is, a null text stays null. A text all of whose lines go becomes empty. Other columns are ignored; an empty
    table gives no rows.
    """
    prepare(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    given = docs.select("doc_id", "text", F.xxhash64("text").alias("h"))
    lines = F.split("text", "\n", -1)
    blank = lambda x: F.btrim(x, F.lit(" \t\n\x0b\f\r")) == ""
    rows = written(
        given.filter("text is not null and doc_id is not null").select(
            F.col("doc_id").alias("key"), "h", F.transform(lines, lambda x: F.when(blank(x), F.lit(BLANK).cast("bigint")).otherwise(F.xxhash64(x))).alias("lines"),
            F.transform(lines, lambda x: F.when(blank(x), 0).otherwise(F.length(x))).alias("sizes"),
        ), "lines-hashed",
    )
    each = rows.select("key", "h", F.explode(F.array_distinct(F.arrays_zip("lines", "sizes"))).alias("x")).select("key", "h", F.col("x.lines").alias("line"), F.col("x.sizes").alias("size")).filter(F.col("line") != BLANK)
    # distinct documents per line, pre-aggregated in each task
    holders = written(each.groupBy("line").agg(F.min(F.struct("key", "h")).alias("first"), F.count(F.lit(1)).alias("df")).filter("df > 1"), "lines-shared")
    pairs = (
        each.join(holders, "line").filter(F.col("first.key") < F.col("key")).groupBy("key", "h", "first")
        .agg(F.min("df").alias("df"), F.count(F.lit(1)).alias("n"), F.sum("size").alias("size"), F.max("size").alias("longest"))
        .filter((F.col("df") <= rare) | (F.col("n") >= several) | (F.col("size") >= enough) | (F.col("longest") >= least_block))
        .select("key", "h", "first")
    )
    runs = rows.mapInArrow(_runs(least_block), f"key {kind}, h bigint, run bigint")
    run_holders = written(runs.groupBy("run").agg(F.min(F.struct("key", "h")).alias("first"), F.count(F.lit(1)).alias("df")).filter("df > 1").select("run", "first"), "lines-runs")
    by_run = runs.join(run_holders, "run").filter(F.col("first.key") < F.col("key")).select("key", "h", "first")
    pairs = pairs.union(by_run).distinct().select("key", "h", F.col("first.key").alias("first_key"), F.col("first.h").alias("first_h"))
    once = rows.dropDuplicates(["key", "h"])
    earlier = once.select(F.col("key").alias("first_key"), F.col("h").alias("first_h"), F.col("lines").alias("earlier"))
    aligned = pairs.join(once, ["key", "h"]).join(earlier, ["first_key", "first_h"]).select("key", "h", "earlier", "lines", "sizes")
    gone = aligned.mapInArrow(_align(least_block), f"key {kind}, h bigint, gone array<int>")
    # at most lines * partners numbers of one document
    gone = written(
        gone.filter(F.size("gone") > 0).groupBy("key", "h").agg(F.array_distinct(F.flatten(F.collect_list("gone"))).alias("gone"), F.count(F.lit(1)).alias("n_partners"))
        .select(F.col("key").alias("doc_id"), "h", "gone", "n_partners"), "lines-gone",
    )
    joined = given.join(gone, ["doc_id", "h"], "left")
    kept = F.array_join(F.filter(lines, lambda x, i: ~F.array_contains("gone", i)), "\n")
    return joined.select(
        "doc_id", F.when(F.col("gone").isNull(), F.col("text")).otherwise(kept).alias("text"), F.coalesce(F.size(lines), F.lit(0)).cast("bigint").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("bigint").alias("n_deleted"), F.coalesce("n_partners", F.lit(0)).cast("bigint").alias("n_partners"),
    )
