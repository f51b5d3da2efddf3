"""Documents packed into token sequences of one length, by exact complements first and best fit for what is left.

Documents of equal length are interchangeable, so the search for combinations needs only how many pieces of each length there
are: at most as many numbers as a sequence has tokens, whatever the corpus. Those counts are the one thing that comes to the
driver. It answers with *patterns*: which lengths stand together in a sequence, and how many sequences are alike. Pieces are
then numbered inside their length, in blocks, and each number is looked up in the patterns where the pieces are.

A pattern starts with the longest piece left. The gap behind it is looked up as a single length, as a sum of two and as a sum
of three; a combination is consumed as often as the counts allow. If pieces are too short to fill the gap with three, the
longest one that fits is added and the rest of the gap is looked up again. Pieces with no exact complement wait until all
exact ones are taken, and are then filled by best fit.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from layerlint.llm.words import _cut as parts_of, slices, utf8
from layerlint.operators.prefix import number_rows
from layerlint.session import prepare, written

ROOM = 4096
END_ID = 1
BLOCKS = 1024  # parts in which the pieces of one length are numbered
KNOWN = 1 << 19  # words whose tokens a task remembers, and the longest ones; only speed depends on them
LONGEST = 64


class Complements:
    """Counts of lengths left, and which sums two of them can have."""

    def __init__(self, counts: np.ndarray, room: int):
        self.left, self.room = counts.astype(np.int64), room
        self.sums = np.zeros(2 * room + 1, bool)  # may be out of date for sums that are gone, never for ones that are there
        there = np.flatnonzero(self.left)
        for a in there:
            self.sums[a + there] = True

    def longest(self, most: int) -> int:
        """The longest piece left of at most that length, 0 if there is none."""
        there = np.flatnonzero(self.left[1 : most + 1])
        return int(there[-1]) + 1 if len(there) else 0

    def pair(self, gap: int) -> tuple[int, ...]:
        """Two lengths left with that sum, the longer one as long as can be."""
        if gap < 2 or not self.sums[gap]:
            return ()
        low = (gap + 1) // 2
        longer = np.arange(low, gap)
        fit = (self.left[low:gap] > 0) & (self.left[gap - longer] > (longer * 2 == gap))
        at = np.flatnonzero(fit)
        return (int(longer[at[-1]]), gap - int(longer[at[-1]])) if len(at) else ()

    def exact(self, gap: int) -> tuple[int, ...]:
        """One, two or three lengths left that fill the gap."""
        if self.left[gap]:
            return (gap,)
        if found := self.pair(gap):
            return found
        low = (gap + 2) // 3
        first = np.arange(low, max(low, gap - 1))
        for c in first[(self.left[first] > 0) & self.sums[gap - first]][::-1].tolist():
            self.left[c] -= 1
            rest = self.pair(gap - c)
            self.left[c] += 1
            if rest:
                return (c, *rest)
            if not self.pair(gap - c):
                self.sums[gap - c] = False
        return ()

    def fill(self, first: int, whole: bool) -> Counter | None:
        """A sequence that begins with a length; with ``whole``, only if nothing of it stays empty."""
        uses = Counter({first: 1})
        self.left[first] -= 1
        gap = self.room - first
        while gap:
            longest = self.longest(gap)
            more = self.exact(gap) if longest and longest * 3 >= gap else ()
            if not more:
                if not longest:
                    break
                more = (longest,)
            for x in more:
                uses[x] += 1
                self.left[x] -= 1
                gap -= x
        for x, n in uses.items():
            self.left[x] += n
        return None if gap and whole else uses

    def take(self, uses: Counter) -> int:
        """Consume a sequence as often as the counts allow."""
        times = min(int(self.left[x]) // n for x, n in uses.items())
        for x, n in uses.items():
            self.left[x] -= n * times
        return times


def patterns(counts: np.ndarray, room: int = ROOM) -> list[tuple[int, Counter]]:
    """(how often, {length: uses}) for counts[length] pieces of each length up to ``room``.

    Every pattern uses up some length, so there are at most twice as many patterns as lengths.
    """
    index, out = Complements(counts, room), []
    for whole in (True, False):
        for first in range(room, 0, -1):
            while index.left[first] and (uses := index.fill(first, whole)):
                out.append((index.take(uses), uses))
    return out


def layout(counts: np.ndarray, room: int = ROOM) -> dict[str, np.ndarray]:
    """Where the pieces of each length go, by their number inside the length: one entry per length of a pattern.

    Piece ``number`` of the entry (first <= number) is copy (number - first) % uses of sequence + (number - first) // uses.
    """
    rows, taken, sequence = [], np.zeros(room + 1, np.int64), 0
    for times, uses in patterns(counts, room):
        offset = 0
        for length, n in sorted(uses.items(), reverse=True):
            rows.append((length, taken[length], n, sequence, offset))
            taken[length] += times * n
            offset += length * n
        sequence += times
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return dict(zip(("length", "first", "uses", "sequence", "offset"), table.T))


_ENDS = b".,;:!?"
_LETTERS = re.compile("[a-z\u00df-\u00f6\u00f8-\u00ff]+")


class Encoder(dict):
    """Token ids of texts as little-endian 32-bit numbers, by words between ASCII white space, each distinct word once.

    For a tokenizer that lower-cases, splits letters from other signs and drops white space: no token spans white space, and
    no rule looks across it. A word of letters is so one word of the tokenizer's model, and closing signs after a letter are
    another one; such words go to the model directly. All other words go through the whole tokenizer.
    """

    def __init__(self, path: str):
        super().__init__()
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer, self.letters = Tokenizer.from_file(path), {}
        self.model = self.tokenizer.model
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.bytes = {c: level.pre_tokenize_str(chr(c))[0][0] for c in range(0x80, 0x100)}

    def _of_letters(self, text: str) -> bytes:
        found = self.letters.get(text)
        if found is None:
            ids = [t.id for t in self.model.tokenize(text.translate(self.bytes))]
            found = struct.pack(f"<{len(ids)}I", *ids)
            if len(text) <= LONGEST:
                if len(self.letters) >= KNOWN:
                    self.letters.clear()
                self.letters[text] = found
        return found

    def __missing__(self, word: bytes) -> bytes:
        core = word.rstrip(_ENDS)
        text = core.decode().lower()
        if _LETTERS.fullmatch(text):
            found = self._of_letters(text) + (self[word[len(core) :]] if len(core) < len(word) else b"")
        else:
            ids = self.tokenizer.encode(word.decode(), add_special_tokens=False).ids
            found = struct.pack(f"<{len(ids)}I", *ids)
        if len(word) <= LONGEST:
            if len(self) >= KNOWN:
                self.clear()
            self[word] = found
        return found

    def encode(self, texts: Iterable[bytes | None]) -> Iterator[tuple[int, bytes]]:
        """(number of the text, some of its ids) in order, at least once per text."""
        for row, text in enumerate(texts):
            for part in parts_of(text or b""):
                if b"<|" not in part:  # nothing of it can be a special token, which only its case tells from text
                    part = part.lower()
                yield row, b"".join(map(self.__getitem__, part.split()))


_encoders: dict[str, Encoder] = {}


def encoder_of(path: str) -> Encoder:
    """The encoder of a file, kept between the tasks of a worker."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def _pieces(encoded: Iterable[tuple[int, bytes]], room: int, end_id: int) -> Iterator[tuple[int, int, int, bytes]]:
    """(text, piece, start, ids) of texts whose ids come in parts; each text gets the end id."""
    row, waiting, piece, end = None, bytearray(), 0, end_id.to_bytes(4, "little")

    def cut(last: bool):
        nonlocal piece
        while len(waiting) > 4 * room or last and waiting:
            yield row, piece, piece * room, bytes(waiting[: 4 * room])
            del waiting[: 4 * room]
            piece += 1

    for at, ids in encoded:
        if at != row:
            if row is not None:
                waiting += end
                yield from cut(True)
            row, piece = at, 0
        waiting += ids
        yield from cut(False)
    if row is not None:
        waiting += end
        yield from cut(True)


def token_pieces(docs: DataFrame, tokenizer: str, room: int = ROOM, end_id: int = END_ID, key: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """Key, piece, start, length, ids_crc32 (and ids, if wanted) of the documents' tokens in pieces of at most ``room``.

    Every document ends with ``end_id``; null, empty and white texts have nothing else. Only documents of more than ``room``
    tokens are cut, and only their last piece is shorter. Repeated rows and rows without key are documents of their own.
    ``tokenizer`` is a file's path on every machine. A long text is tokenized in parts, and its pieces go out as they fill.
    """
    prepare(docs.sparkSession)
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    names = ["key", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(tokenizer)
        for batch in slices(batches, "text"):
            found = []
            pieces = _pieces(encoder.encode(utf8(batch.column("text"))), room, end_id)
            for one in pieces:
                found.append(one)
                if len(found) == 1024:
                    yield table(batch, found)
                    found = []
            if found:
                yield table(batch, found)

    def table(batch, found) -> pa.RecordBatch:
        row, piece, start, ids = zip(*found)
        columns = [batch.column("key").take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start, pa.int64())]
        columns += [pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array([zlib.crc32(x) for x in ids], pa.int64())]
        return pa.RecordBatch.from_arrays(columns + [pa.array(ids, pa.binary())] * with_ids, names=names)

    kind = rows.schema["key"].dataType.simpleString()
    out = rows.mapInArrow(run, f"key {kind}, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids binary" * with_ids)
    return out.withColumnRenamed("key", key)


def place(pieces: DataFrame, row: str, room: int = ROOM, blocks: int = BLOCKS) -> DataFrame:
    """``pieces`` (a stored table with a column length of 1 to ``room``) with sequence_id and offset instead of ``row``.

    ``row`` is different in all rows and decides which of two pieces of equal length goes where. Sequences are numbered from
    0; inside one, pieces follow each other without a gap. A length that most pieces have is numbered in many blocks.
    """
    prepare(pieces.sparkSession)
    counts = np.zeros(room + 1, np.int64)
    for length, n in pieces.groupBy("length").agg(F.count(F.lit(1))).collect():  # one row per length, room at most
        counts[length] = n
    shared = pieces.sparkSession.sparkContext.broadcast(layout(counts, room))
    numbered = number_rows(pieces, ["length"], [row], F.pmod(F.xxhash64(row), F.lit(blocks)), "__number")
    pieces = pieces.drop(row)
    kept = pieces.columns
    names = [*kept, "sequence_id", "offset"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # lengths are at most room, numbers are below 2 ** 48: both fit in one sorted key
        plan = shared.value
        keys = (plan["length"] << 48) + plan["first"]
        for batch in batches:
            length, number = (batch.column(c).to_numpy() for c in ("length", "__number"))
            entry = np.searchsorted(keys, (length << 48) + number, side="right") - 1
            number = number - plan["first"][entry]
            sequence = plan["sequence"][entry] + number // plan["uses"][entry]
            offset = plan["offset"][entry] + number % plan["uses"][entry] * length
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(sequence), pa.array(offset)], names=names)

    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields]
    return numbered.select(*kept, "__number").mapInArrow(run, ", ".join([*kinds, "sequence_id bigint", "offset bigint"]))


def pack_documents(docs: DataFrame, tokenizer: str, room: int = ROOM, end_id: int = END_ID, key: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """Every piece of the documents with its sequence and place: the columns of ``token_pieces``, sequence_id and offset."""
    pieces = token_pieces(docs, tokenizer, room, end_id, key, text, with_ids).withColumn("__row", F.monotonically_increasing_id())
    return place(written(pieces, "token-pieces"), "__row", room)


def sequences(placed: DataFrame, key: str = "doc_id") -> DataFrame:
    """sequence_id, ids (32-bit little-endian, in order) and parts (key, piece, offset, length) of pieces placed with their ids.

    A sequence has as many pieces as tokens at most, so its group is bounded.
    """
    part = F.struct("offset", "length", F.col(key).alias("key"), "piece", "ids")
    grouped = placed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(part)).alias("parts"))
    ids = F.unhex(F.array_join(F.transform("parts", lambda p: F.hex(p["ids"])), ""))
    return grouped.select("sequence_id", ids.alias("ids"), F.transform("parts", lambda p: p.dropFields("ids")).alias("parts"))
