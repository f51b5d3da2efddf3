"""Toxicity from the nearest labelled examples by exact TF-IDF cosine.

The examples are a bounded sample of labelled texts over a bounded vocabulary of telling words. They lie in blocks; the index
keeps, per word and block, the largest weight in the block. For a text, the sum of its weights times these maxima bounds every
cosine in a block, so blocks are scored from the highest bound down and the rest is left once no bound beats the k-th best
cosine: the k nearest are exact. Their distance-weighted votes become a probability by a logistic fit on the examples
themselves, each scored without itself.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from layerlint.llm.langid import held_out
from layerlint.llm.words import slices, utf8, word_hashes
from layerlint.session import prepare, written

EXAMPLES = 2500  # of each label, about
WORDS = 2048  # of the vocabulary
NEAREST = 15
BLOCK = 64
STEP = 8  # blocks scored at a time

_FOLD = bytes(c if chr(c).isalpha() or c > 127 else 32 for c in range(256))


def terms(texts: Iterable[bytes | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Distinct words of each text, as hashes, and their counts. Anything but letters parts words."""
    words, counts = word_hashes([(t or b"").translate(_FOLD) for t in texts])
    at = 0
    for n in counts.tolist():
        yield np.unique(words[at : at + n], return_counts=True)
        at += n


@dataclass
class Examples:
    """A block-max index: rows are words, columns are examples in blocks of ``BLOCK``."""

    words: np.ndarray  # sorted hashes
    idf: np.ndarray
    weights: np.ndarray  # (words, examples) of unit vectors
    most: np.ndarray  # (words, blocks)
    labels: np.ndarray
    keys: np.ndarray
    prior: float
    slope: np.ndarray  # of the logistic calibration: intercept, vote, similarity

    def vector(self, words: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the vocabulary and weights of a text; the unit length counts vocabulary words only."""
        at = np.searchsorted(self.words, words)
        at[at == len(self.words)] = 0
        known = self.words[at] == words if len(self.words) else np.zeros(len(words), bool)
        at, w = at[known], (1 + np.log(counts[known])) * self.idf[at[known]]
        size = np.sqrt((w * w).sum())
        return at, (w / size if size else w).astype(np.float32)

    def nearest(self, at: np.ndarray, w: np.ndarray, k: int = NEAREST, without: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """The k examples of the largest cosine above zero, and the cosines. Ties go to the earlier example."""
        if not len(at):
            return np.zeros(0, np.int64), np.zeros(0, np.float32)
        bounds = w @ self.most[at]
        order = np.argsort(-bounds, kind="stable")
        ids, sims, floor = np.zeros(0, np.int64), np.zeros(0, np.float32), 0.0
        for i in range(0, len(order), STEP):
            blocks = order[i : i + STEP]
            blocks = blocks[bounds[blocks] + 1e-5 >= floor] if len(ids) >= k else blocks[bounds[blocks] > 0]
            if not len(blocks):
                break
            found = (blocks[:, None] * BLOCK + np.arange(BLOCK)).ravel()
            found = found[(found < len(self.labels)) & (found != without)]
            ids = np.concatenate([ids, found])
            sims = np.concatenate([sims, w @ self.weights[at[:, None], found]])
            best = np.lexsort((ids, -sims))[:k]
            ids, sims = ids[best], sims[best]
            floor = sims[-1] if len(ids) >= k else 0.0
        return ids[sims > 0], sims[sims > 0]

    def features(self, ids: np.ndarray, sims: np.ndarray) -> tuple[float, float]:
        """Share of the votes for toxic, where an example votes by its closeness, and the largest cosine for toxic."""
        if not len(ids):
            return 0.0, 0.0
        votes = sims.astype(np.float64) / (1.0001 - np.minimum(sims, 1.0))
        toxic = self.labels[ids] == 1
        return float(votes[toxic].sum() / votes.sum()), float(sims[toxic].max(initial=0))

    def score(self, found: tuple[np.ndarray, np.ndarray]) -> float:
        if not len(self.labels):
            return self.prior
        vote, closest = self.features(*found)
        return float(1 / (1 + np.exp(-np.clip(self.slope @ np.array([1.0, vote, closest]), -30, 30))))


def calibrate(x: np.ndarray, y: np.ndarray, weight: np.ndarray, start: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Weighted logistic fit whose slopes are not below zero: a text closer to toxic examples never scores lower.

    Newton steps are halved until the penalised loss falls; full steps overshoot where the columns part the labels almost.
    """

    def loss(slope: np.ndarray) -> float:
        at = x @ slope
        return float((weight * (np.logaddexp(0, at) - y * at)).sum() + ridge / 2 * slope @ slope)

    free = np.ones(len(start), bool)
    while True:
        slope = np.where(free, start, 0.0)
        for _ in range(100):
            p = 1 / (1 + np.exp(-np.clip(x @ slope, -30, 30)))
            grad = (x.T @ (weight * (y - p)) - ridge * slope)[free]
            step = np.zeros(len(slope))
            step[free] = np.linalg.solve((x[:, free] * (weight * p * (1 - p) + 1e-9)[:, None]).T @ x[:, free] + ridge * np.eye(free.sum()), grad)
            before = loss(slope)
            while np.abs(step).max() >= 1e-8 and loss(slope + step) > before:
                step = step / 2
            if np.abs(step).max() < 1e-8:
                break
            slope = slope + step
        wrong = free & (slope < 0) & (np.arange(len(slope)) > 0)
        if not wrong.any():
            return slope
        free[np.argmin(np.where(wrong, slope, 0.0))] = False


def build_examples(texts: list[bytes | None], labels: np.ndarray, keys: np.ndarray, prior: float, size: int = WORDS) -> Examples:
    """The index of the given examples. Words of the vocabulary are those whose presence tells most about the label, beyond chance."""
    found = list(terms(texts))
    n, toxic = len(found), labels == 1
    words, inverse = np.unique(np.concatenate([w for w, _ in found] or [np.zeros(0, np.uint64)]), return_inverse=True)
    rows = np.repeat(np.arange(n), [len(w) for w, _ in found]) if n else np.zeros(0, np.int64)
    df = np.bincount(inverse, minlength=len(words)).astype(float)
    pos = np.bincount(inverse, weights=toxic[rows].astype(float), minlength=len(words))
    # chi-squared of presence against label, half a row added to each cell
    a, b, t = pos + 0.5, df - pos + 0.5, max(toxic.sum(), 1)
    c, d = t - pos + 0.5, (n - t) - (df - pos) + 0.5
    chi = (a * d - b * c) ** 2 * (n + 2) / ((a + b) * (c + d) * (a + c) * (b + d))
    chi[df < 3] = -1
    # of m words without any meaning about one passes this; without the cut they outnumber telling words and fill the cosines
    m = int((df >= 3).sum())
    told = int((chi > 2 * np.log(max(m, 2))).sum())
    chosen = np.sort(np.argsort(-chi, kind="stable")[: min(size, told or m)])
    words, df = words[chosen], df[chosen]
    model = Examples(words, np.log((1 + n) / (1 + df)) + 1, np.zeros((len(words), n), np.float32), np.zeros((len(words), 0), np.float32), labels, keys, prior, np.array([0.0, 0.0, 0.0]))
    for i, (w, k) in enumerate(found):
        at, weight = model.vector(w, k)
        model.weights[at, i] = weight
    blocks = (n + BLOCK - 1) // BLOCK
    model.most = np.stack([model.weights[:, j * BLOCK : (j + 1) * BLOCK].max(axis=1) for j in range(blocks)], axis=1) if n else model.most
    # each example by the others; rows weigh so that labels have their share of all labelled rows
    x = np.array([[1.0, *model.features(*model.nearest(*model.vector(w, k), without=i))] for i, (w, k) in enumerate(found)]).reshape(n, 3)
    y = toxic.astype(float)
    share = min(max(prior, 1e-3), 1 - 1e-3)
    weight = np.where(toxic, share / max(y.mean() if n else 0, 1e-9), (1 - share) / max(1 - y.mean() if n else 0, 1e-9))
    model.slope[0] = np.log(share / (1 - share))
    if n:
        model.slope = calibrate(x, y, weight, model.slope)
    return model


def learn_examples(docs: DataFrame, labels: DataFrame, examples: int = EXAMPLES) -> Examples:
    """Examples from labels (doc_id, toxic) whose document is not held out; a label without its row, or null, is not used.

    About ``examples`` texts of each label are picked by a hash of their id. The text of an id with several rows is the
    smallest; of contradicting labels the larger counts.
    """
    spark = docs.sparkSession
    usable = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out("doc_id", 5, 0)).groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    usable = written(usable, "toxicity-labels")
    sizes = {r["toxic"]: r["n"] for r in usable.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return build_examples([], np.zeros(0, np.int64), np.zeros(0, np.int64), 0.0)
    rate = F.lit(0.0)
    for label, n in sizes.items():
        rate = F.when(F.col("toxic") == label, min(1.0, examples / n)).otherwise(rate)
    sample = written(usable.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < rate * (1 << 20)), "toxicity-sample")
    # a few thousand ids: bounded by ``examples`` per label
    picked = docs.filter(F.col("text").isNotNull()).join(F.broadcast(sample), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).orderBy("toxic", "doc_id").toArrow()
    prior = sizes.get(1, 0) / sum(sizes.values())
    return build_examples(utf8(picked.column("text").combine_chunks()), picked.column("toxic").to_numpy().astype(np.int64), picked.column("doc_id").to_numpy(), prior)


def score_toxicity(docs: DataFrame, labels: DataFrame, examples: int = EXAMPLES) -> DataFrame:
    """doc_id, held_out, score, predicted, evidence (ids of the three nearest examples) and evidence_cosine, per document.

    Null and empty texts, and texts without a word of the vocabulary, have no neighbour and get the score of that. Repeated
    rows are scored each. Without labels the score is 0.
    """
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(learn_examples(docs, labels, examples))  # words * examples * 4 bytes

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in slices(batches, "text"):
            scores, ids, cosines = [], [], []
            for w, k in terms(utf8(batch.column("text"))):
                near = model.nearest(*model.vector(w, k)) if len(model.labels) else (np.zeros(0, np.int64), np.zeros(0))
                scores.append(model.score(near))
                ids.append(model.keys[near[0][:3]].tolist())
                cosines.append(near[1][:3].astype(float).tolist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(scores, pa.float64()), pa.array(ids, pa.list_(pa.int64())), pa.array(cosines, pa.list_(pa.float64()))],
                names=["doc_id", "score", "evidence", "evidence_cosine"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    found = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double, evidence array<bigint>, evidence_cosine array<double>")
    return found.select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "evidence", "evidence_cosine")
