"""Language of a text by bit-sliced Bloom filters of character n-grams.

All languages share one table of cells; a cell has a bit per language. An n-gram sets its language's bit in the cells that its
hashes name, and a query takes the AND of those cells: the set of all languages that have the n-gram, in one look. Counts of
bits per language, less what false positives add, decide.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from layerlint.llm.words import mix, slices
from layerlint.session import prepare, written

GRAM = 4
FIT_ROWS = 1500  # sampled documents per language, about
PROFILE = 20_000  # most frequent n-grams per language
CELLS = 1 << 20
HASHES = 3
SHARE = 0.1  # of an n-gram's largest relative frequency that a language needs to have it
UNKNOWN = "und"
_letters: list[np.ndarray] = []


def letter_table() -> np.ndarray:
    """Which code points are letters."""
    if not _letters:
        _letters.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000))
    return _letters[0]


def gram_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all n-grams, the n-grams per text and the letters per text. Runs of other characters are one space."""
    lowered = [(t or "").lower() for t in texts]
    codes = np.frombuffer(("\n" + "\n".join(lowered) + "\n").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    ends = np.cumsum(np.array([len(t) + 1 for t in lowered], dtype=np.int64))  # position of the separator after each text
    letter = letter_table()[codes]
    # one space between runs of letters, and one around each text
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    keep[np.concatenate([[0], ends])] = True
    kept = np.where(letter, codes, 32)[keep].astype(np.uint64)
    at = np.cumsum(keep)
    edges = at[np.concatenate([[0], ends])] - 1  # of separators among the kept characters
    lettered = np.diff(np.cumsum(letter)[np.concatenate([[0], ends])])
    n = len(kept) - GRAM + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64), lettered
    h = np.zeros(n, np.uint64)
    for k in range(GRAM):
        h = h * np.uint64(0x110001) + kept[k : k + n]
    # n-grams inside a text and its two spaces; a text too short for one has its characters as one
    inside = np.zeros(n, bool)
    counts = np.maximum(edges[1:] - edges[:-1] + 1 - GRAM + 1, 0)
    marks = np.zeros(n + 1, np.int64)
    have = counts > 0
    np.add.at(marks, edges[:-1][have], 1)
    np.add.at(marks, edges[:-1][have] + counts[have], -1)
    inside = np.cumsum(marks[:-1]) > 0
    return mix(h[inside]), counts.astype(np.int64), lettered


@dataclass
class LanguageFilters:
    languages: list[str]
    cells: np.ndarray  # (CELLS, words of 64 languages)
    fill: np.ndarray  # share of set bits per language

    @staticmethod
    def build(languages: list[str], grams: np.ndarray, of: np.ndarray) -> LanguageFilters:
        cells = np.zeros((CELLS, (len(languages) + 63) // 64), np.uint64)
        for j in range(HASHES):
            np.bitwise_or.at(cells, (_place(grams, j), of // 64), np.uint64(1) << (of % 64).astype(np.uint64))
        fill = np.array([np.count_nonzero(cells[:, i // 64] >> np.uint64(i % 64) & np.uint64(1)) / CELLS for i in range(len(languages))])
        return LanguageFilters(languages, cells, fill)

    def masks(self, grams: np.ndarray) -> np.ndarray:
        """The languages of each n-gram."""
        out = self.cells[_place(grams, 0)]
        for j in range(1, HASHES):
            out &= self.cells[_place(grams, j)]
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        grams, counts, letters = gram_hashes(texts)
        if not self.languages:
            return [UNKNOWN] * len(texts), [0.0] * len(texts)
        masks = self.masks(grams)
        edges = np.concatenate([[0], np.cumsum(counts)])
        wrong = self.fill**HASHES  # chance that a foreign n-gram seems to be the language's
        hits = np.empty((len(self.languages), len(texts)))
        for i in range(len(self.languages)):
            bits = (masks[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)
            sums = np.concatenate([[0], np.cumsum(bits, dtype=np.int64)])
            found = sums[edges[1:]] - sums[edges[:-1]]
            hits[i] = np.maximum((found - counts * wrong[i]) / max(1 - wrong[i], 1e-9), 0)
        best = hits.argmax(axis=0)
        score = np.where(counts > 0, hits.max(axis=0) / np.maximum(counts, 1), 0.0).clip(0, 1)
        return (
            [self.languages[b] if n else UNKNOWN for b, n in zip(best.tolist(), letters.tolist())],
            np.where(letters > 0, score, 0.0).tolist(),
        )


def _place(grams: np.ndarray, j: int) -> np.ndarray:
    return ((grams >> np.uint64(20 * j)) % np.uint64(CELLS)).astype(np.int64)


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        langs = np.array(batch.column("lang").to_pylist(), dtype=object)
        texts = batch.column("text").to_pylist()
        for lang in sorted(set(langs)):
            grams, n = np.unique(gram_hashes([t for t, x in zip(texts, langs) if x == lang])[0], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(grams), pa.string()), pa.array(grams.view(np.int64)), pa.array(n.astype(np.int64))], names=["lang", "gram", "n"])


def learn_filters(labelled: DataFrame, fit_rows: int = FIT_ROWS, profile: int = PROFILE) -> LanguageFilters:
    """Filters from rows (key, text, lang). About ``fit_rows`` texts per language, picked by a hash of their key, are read whole."""
    labelled = labelled.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return LanguageFilters([], np.zeros((CELLS, 1), np.uint64), np.zeros(0))
    rate = F.element_at(F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, min(1.0, fit_rows / n))]), F.col("lang"))
    sample = labelled.filter(F.pmod(F.xxhash64("key"), F.lit(1 << 20)) < rate * (1 << 20)).select("lang", "text")
    counts = sample.mapInArrow(_count, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    common = counts.withColumn("at", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))).filter(F.col("at") <= profile)
    share = common.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy("lang")))
    kept = share.withColumn("most", F.max("share").over(Window.partitionBy("gram"))).filter((F.col("share") >= SHARE * F.col("most")) & (F.col("n") > 1))
    rows = kept.select("lang", "gram").toPandas()  # at most languages * profile rows
    languages = sorted(sizes)
    return LanguageFilters.build(languages, rows["gram"].to_numpy(np.int64).view(np.uint64), rows["lang"].map({x: i for i, x in enumerate(languages)}).to_numpy(np.int64))


def predict_languages(docs: DataFrame, filters: LanguageFilters, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, lang_pred and score (the share of a text's n-grams that the language has) per row.

    A text that is null or has no letter is ``und`` with score 0. Ties go to the first language in order; repeated rows are
    predicted each.
    """
    shared = docs.sparkSession.sparkContext.broadcast(filters)  # CELLS * languages / 64 words of 8 bytes
    rows = docs.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], F.col(text).alias("text"))
    kept = [f"k{i}" for i in range(len(keep))]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in slices(batches, "text", 1 << 20):
            langs, scores = model.predict(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=[*kept, "lang_pred", "score"])

    schema = ", ".join([f"{k} {rows.schema[k].dataType.simpleString()}" for k in kept] + ["lang_pred string", "score double"])
    return rows.mapInArrow(run, schema).select(*[F.col(k).alias(c) for k, c in zip(kept, keep)], "lang_pred", "score")


def held_out(key: str = "doc_id", parts: int = 4, part: int = 2) -> Column:
    """Whether a CRC of the key as text leaves the remainder ``part``; false for a null key."""
    return F.coalesce(F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(parts)) == part, F.lit(False))


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score per document; learned only from rows with a key that are not held out."""
    prepare(docs.sparkSession)
    learned = docs.filter(~held_out() & F.col("doc_id").isNotNull()).select(F.col("doc_id").alias("key"), "text", "lang")
    found = predict_languages(docs, learn_filters(learned))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
