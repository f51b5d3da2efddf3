"""Words and word shingles of texts as 64-bit hashes, for whole Arrow batches at once.

A word is a run of bytes other than space and 0x09-0x0D; A-Z are lower-cased. Texts are cut at white space into pieces of a
bounded size, so memory follows the number of words of a batch and never the square of anything.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE = 1 << 18  # bytes hashed at a time
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_STEP = np.uint64(0xD1342543DE82EF95)
_powers: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_CODES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        out = np.full(max(n, PIECE + 1024), np.uint64(base), dtype=np.uint64)
        out[0] = 1
        _powers[base] = have = np.cumprod(out, dtype=np.uint64)
    return have[:n]


def _piece(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of each word of a piece."""
    raw = np.frombuffer(data, dtype=np.uint8)
    inside = ~_SPACE[raw]
    edges = np.flatnonzero(np.diff(inside.astype(np.int8), prepend=0, append=0))
    starts, ends = edges[::2], edges[1::2]
    sums = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum(_CODES[raw] * powers(_BASE, len(raw)), out=sums[1:])
    return mix((sums[ends] - sums[starts]) * powers(_BASE_INVERSE, len(raw) + 1)[starts]), starts


def _cut(text: bytes) -> Iterator[bytes]:
    """Pieces of a long text; each but the last ends at white space."""
    at = 0
    while len(text) - at > PIECE:
        end = at + PIECE
        while end < len(text) and not _SPACE[text[end]]:
            end += 1
        yield text[at:end]
        at = end
    yield text[at:]


def word_hashes(texts: Iterable[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts, one text after the other, and the number of words of each text."""
    hashes, counts, waiting, sizes, room = [], [], [], [], PIECE

    def flush():
        nonlocal room
        room = PIECE
        if waiting:
            found, starts = _piece(b" ".join(waiting).lower())
            edges = np.cumsum(np.array(sizes, dtype=np.int64) + 1)
            hashes.append(found)
            counts.append(np.diff(np.searchsorted(starts, edges), prepend=0))
            waiting.clear()
            sizes.clear()

    for text in texts:
        text = text or b""
        if len(text) > PIECE:
            flush()
            parts = [_piece(x.lower())[0] for x in _cut(text)]
            hashes.append(np.concatenate(parts))
            counts.append(np.array([sum(map(len, parts))]))
        else:
            waiting.append(text)
            sizes.append(len(text))
            room -= len(text) + 1
            if room < 0:
                flush()
    flush()
    return (
        np.concatenate(hashes) if hashes else np.zeros(0, dtype=np.uint64),
        np.concatenate(counts).astype(np.int64) if counts else np.zeros(0, dtype=np.int64),
    )


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` words; of the whole sequence if it is shorter; nothing for no words."""
    if not len(words):
        return words
    k = min(width, len(words))
    n = len(words) - k + 1
    out = np.full(n, np.uint64(k), dtype=np.uint64)
    for j in range(k):
        out = (out ^ words[j : j + n]) * _STEP
        out ^= out >> np.uint64(29)
    return mix(out)


def shingle_sets(texts: Iterable[bytes | None], width: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingles of each text."""
    words, counts = word_hashes(texts)
    at = 0
    for n in counts.tolist():
        own = np.sort(window_hashes(words[at : at + n], width))
        at += n
        if len(own) > 1:
            keep = np.empty(len(own), dtype=bool)
            keep[0] = True
            np.not_equal(own[1:], own[:-1], out=keep[1:])
            own = own[keep]
        yield own


def utf8(column: pa.Array) -> list[bytes | None]:
    """The values of a text column as bytes."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(kind).to_pylist()


def slices(batches: Iterable[pa.RecordBatch], column: str, size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut so that a text column holds about ``size`` bytes in each, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        part = (np.cumsum(lengths) - lengths) // size
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            yield batch.slice(a, b - a)
