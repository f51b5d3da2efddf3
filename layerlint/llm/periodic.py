"""Repeating stretches of words ("a b a b a b a b"), found by following diagonals of equal words.

A run is a stretch of words with smallest period q (words q apart are equal) that no neighbouring word extends. Seen as a
diagonal, it is a streak of words that equal the word q before them. Words are read in order; each is linked to its nearest
earlier occurrence *together with the words after it*, the link's distance (lag) names a diagonal, and the diagonal's match
length grows by one for each word in step. Where a diagonal ends, its length decides, and the run is given out at once.

Two facts make this exact without following every earlier occurrence of a frequent word:

* A run of at least r periods, r >= 3, has (r - 1) * q matches in a row, so lags from ``low`` on only need words that are
  equal together with the (r - 1) * low - 1 words after them. Lags are taken in levels [low, (r - 1) * low].
* At such a level the nearest earlier occurrence is enough. Let it be p words back, and a farther one q words back. The words
  from the nearer one to the end of the context have periods p and q and are at least p + q long, so their greatest common
  divisor is a period too (Fine and Wilf). Were it less than p there would be a nearer occurrence, so p divides q: the stretch
  on diagonal q has the smaller period p, and q is not the period of a run.

So there is one link per word and level, the number of levels grows with the logarithm of a text's length, and a text of one
word repeated a million times costs no more than any other text of that length.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from layerlint.llm.words import mix, powers, slices
from layerlint.session import prepare

LEAST_WORDS = 6
REPEATS = 4
SPACE = r"[\x20\x09-\x0D]+"
_BASE = 0xD1342543DE82EF95
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """All words of the texts one after the other, a number per word (equal words, equal numbers), and where each text begins."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.string()), ""))
    flat, at = lists.flatten(), np.asarray(lists.offsets)
    full = pc.greater(pc.binary_length(flat), 0)  # white space at either end leaves empty words
    words = flat.filter(full)
    edges = np.concatenate([[0], np.cumsum(full.to_numpy(zero_copy_only=False))])[at - at[0]]
    return words, words.dictionary_encode().indices.to_numpy().astype(np.int64), edges


def _repeated(codes: np.ndarray, edges: np.ndarray, width: int) -> np.ndarray:
    """Texts that may hold some ``width`` words in a row twice; no other text holds a run. By hashes, so some too many."""
    n = len(codes) - width + 1
    if n < 2:
        return np.zeros(0, np.int64)
    text = np.repeat(np.arange(len(edges) - 1), np.diff(edges))
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(mix((codes + 1).astype(np.uint64)) * powers(_BASE, len(codes)), out=sums[1:])
    grams = mix((sums[width:] - sums[:n]) * powers(_BASE_INVERSE, len(codes) + 1)[:n] ^ mix(text[:n].astype(np.uint64) + np.uint64(1)))
    grams = grams[text[:n] == text[width - 1 :]]
    owner = text[:n][text[:n] == text[width - 1 :]]
    order = np.argsort(grams)
    same = grams[order][1:] == grams[order][:-1]
    return np.unique(owner[order[1:][same]])


def _paired(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A number per pair; equal pairs, equal numbers."""
    return np.unique(left * (np.int64(right.max()) + 1) + right, return_inverse=True)[1].astype(np.int64)


def _widened(classes: np.ndarray, width: int, to: int) -> np.ndarray:
    """Classes of ``to`` words in a row, from those of ``width`` words in a row."""
    while width < to and len(classes):
        step = min(width, to - width)
        classes, width = _paired(classes[:-step], classes[step:]) if len(classes) > step else classes[:0], width + step
    return classes


def links(codes: np.ndarray, begins: np.ndarray, longest: int, least: int = LEAST_WORDS, repeats: int = REPEATS) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per level: number of words in a context, positions with an earlier occurrence at a lag of that level, and their lags.

    ``begins`` has the first position of the text that a word belongs to; a text ends with a word found nowhere else, so no
    context reaches into the next one. ``longest`` is the number of words of the longest text.
    """
    # a lag q needs max(least - q, (repeats - 1) * q) words in step
    context = min(max(least - q, (repeats - 1) * q) for q in range(1, max(least, 2)))
    classes, width, low = codes, 1, 1
    while low * repeats <= longest:
        classes, width = _widened(classes, width, context), context
        if not len(classes):
            return
        order = np.argsort(classes, kind="stable")
        lag = np.zeros(len(classes), np.int64)
        same = classes[order][1:] == classes[order][:-1]
        lag[order[1:][same]] = (order[1:] - order[:-1])[same]
        at = np.flatnonzero((lag >= low) & (lag <= context) & (np.arange(len(classes)) - lag >= begins[: len(classes)]))
        yield context, at, lag[at]
        low, context = context + 1, (repeats - 1) * (context + 1)


def runs_of(codes: np.ndarray, edges: np.ndarray, least: int = LEAST_WORDS, repeats: int = REPEATS) -> Iterator[tuple[int, int, int]]:
    """(first word, words, period) of every run, counted over all texts together, in the order in which they end at a level."""
    ends = edges[1:] + np.arange(len(edges) - 1)
    fenced = np.insert(codes, edges[1:], codes.max(initial=0) + 1 + np.arange(len(edges) - 1))  # a word of its own after each text
    starts = edges[:-1] + np.arange(len(edges) - 1)
    begins = np.repeat(starts, ends - starts + 1)
    back = np.repeat(np.arange(len(edges) - 1), ends - starts + 1)
    for context, at, lags in links(fenced, begins, int(np.diff(edges).max(initial=0)), least, repeats):
        first = last = lag = -1  # the active diagonal: one link per word and level, so a new one ends the one before
        for i, q in zip(at.tolist() + [-1], lags.tolist() + [-1]):
            if q == lag and i == last + 1:
                last = i
                continue
            length = last - first + context + lag
            if lag > 0 and length >= max(least, repeats * lag):
                yield first - lag - int(back[first]), length, lag
            first = last = i
            lag = q


def _found(texts: pa.Array, least: int, repeats: int, collapse: bool) -> tuple[np.ndarray, list, list]:
    words, codes, edges = words_of(texts)
    runs: list[list] = [[] for _ in range(len(texts))]
    some = _repeated(codes, edges, min(max(least - q, (repeats - 1) * q) for q in range(1, max(least, 2))))
    dropped = np.zeros(len(codes) + 1, np.int64)
    if len(some):
        spans = [codes[edges[t] : edges[t + 1]] for t in some]
        own = np.concatenate([[0], np.cumsum([len(x) for x in spans])])
        for start, length, period in runs_of(np.concatenate(spans), own, least, repeats):
            k = int(np.searchsorted(own, start, side="right")) - 1
            runs[some[k]].append((start - int(own[k]), length, period))
            shift = int(edges[some[k]] - own[k])
            dropped[start + shift + period] += 1
            dropped[start + shift + length] -= 1
    texts_out = []
    if collapse:
        keep = pa.array(np.cumsum(dropped)[:-1] == 0)
        kept = words.filter(keep)
        sizes = np.concatenate([[0], np.cumsum(keep.to_numpy(zero_copy_only=False))])[edges]
        texts_out = pc.binary_join(pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), kept), " ")
    return np.diff(edges), [[dict(start=a, length=b, period=c) for a, b, c in sorted(x, key=lambda r: (r[0], r[2]))] for x in runs], texts_out


def find_runs(docs: DataFrame, text: str = "text", least: int = LEAST_WORDS, repeats: int = REPEATS) -> DataFrame:
    """All columns of ``docs`` and: n_words, runs (start, length, period; by start, then period) and collapsed.

    Words are what stands between spaces and the characters 0x09-0x0D, compared byte by byte. ``collapsed`` has the words, one
    space between them, that no run holds after its first period. A run has ``least`` words and ``repeats`` periods at least,
    3 or more. Null, empty and white texts have no words, no run and an empty ``collapsed``. Every row is judged by its text
    alone, so repeated rows give equal rows; whole texts are read, in batches of bounded bytes. Columns of ``docs`` that have
    a name of a new one give way to it.
    """
    if repeats < 3:
        raise ValueError("repeats must be 3 at least")
    prepare(docs.sparkSession)
    new = {"n_words": "bigint", "runs": RUNS, "collapsed": "string"}
    keep = [c for c in docs.columns if c not in new]
    rows = docs.select(*keep, F.col(text).alias("__text"))
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]]
    runs_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "__text"):
            n, runs, collapsed = _found(batch.column("__text"), least, repeats, True)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(n, pa.int64()), pa.array(runs, runs_type), collapsed.cast(pa.string())], names=[*keep, *new],
            )

    return rows.mapInArrow(run, ", ".join([*kinds, *[f"{k} {v}" for k, v in new.items()]]))


def planted(text: Column, key: Column) -> Column:
    """The contract's fixture: of every tenth document by CRC-32 of its id, the words from some word on repeat a period."""
    h = F.crc32(key.cast("string"))
    g = F.floor(h / 10)
    inside = F.btrim(text, F.lit(" \t\n\x0b\f\r"))
    words = F.split(inside, SPACE)
    n = F.greatest(F.size(words), F.lit(1))
    a = (g % n).cast("int")
    p = (F.lit(1) + F.floor((n - a) / (3 + g % 8))).cast("int")
    cycles = F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int"))
    moved = F.slice(F.concat(F.slice(words, F.lit(1), a), F.flatten(cycles)), F.lit(1), n)
    return F.when((h % 10 == 0) & (inside != ""), F.array_join(moved, " ")).otherwise(text)


def digests(found: DataFrame) -> DataFrame:
    """The result of ``find_runs`` as one row of numbers and digests per document."""
    best = F.reduce("runs", F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>"), lambda b, r: F.when(b.isNull() | (r["length"] > b["length"]), r).otherwise(b))
    listed = F.array_join(F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))), "")
    rows = found.withColumn("__best", best)
    return rows.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), *[F.col(f"__best.{c}").alias(c) for c in ("start", "length", "period")],
        F.floor(1000 * F.col("__best.length") / F.col("__best.period")).cast("bigint").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
