"""WARC archives as a table of chunks: (record id, chunk number) rows with running digests.

A payload is written as one record per chunk: a ``response`` and, if it is longer than a chunk, ``continuation`` records, as
the format's segmentation rules have it. Payloads that another record has are written as ``revisit`` records without a body.
Archives are split at their record marks by Spark's own reader, so a record never has to be in memory as a whole, and large
archives are read in parallel. A chunk never contains the mark: the writer ends a chunk inside it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from layerlint.session import prepare

MARK = "WARC/1.1\r\n"
CHUNK = 1 << 16
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_of_sha1(hexadecimal: Column) -> Column:
    """Upper-case base32 of a SHA-1 given in hex: 20 bits of five hex digits are four letters."""
    letters = []
    for part in range(8):
        bits = F.conv(F.substring(hexadecimal, 5 * part + 1, 5), 16, 10).cast("int")
        letters += [F.substring(F.lit(BASE32), F.shiftright(bits, 15 - 5 * k).bitwiseAND(31) + 1, F.lit(1)) for k in range(4)]
    return F.concat(*letters)


def _uuid(*parts: Column) -> Column:
    x = F.md5(F.concat_ws(":", *[p.cast("string") for p in parts]))
    pieces = [F.substring(x, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *pieces), F.lit(">"))


def _chunk_ends(payload: Column, chunk: int) -> Column:
    """Where the chunks of a payload end: every ``chunk`` bytes and inside every record mark."""
    steps = F.transform(F.sequence(F.lit(1), F.greatest(F.ceil(F.octet_length(payload) / chunk), F.lit(1))).cast("array<int>"), lambda i: F.least(i * chunk, F.octet_length(payload)))
    pieces = F.split(payload.cast("string"), MARK.replace(".", "\\."), -1)
    # four bytes into the k-th mark
    marks = F.transform(
        F.sequence(F.lit(1), F.size(pieces) - 1),
        lambda k: F.aggregate(F.slice(pieces, 1, k), F.lit(0), lambda n, p: n + F.octet_length(p)) + (k - 1) * len(MARK) + 4,
    )
    return F.when(F.size(pieces) > 1, F.array_sort(F.array_union(steps, marks))).otherwise(steps)


def plan_records(pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html", least_revisit: int = 0) -> DataFrame:
    """One row per page: key, url, payload (null for revisits), payload_bytes, payload_digest, record_type, refers_to, record_id.

    Among pages with equal payloads of ``least_revisit`` bytes or more the largest key is the response; repeated rows of that
    key are responses too. Smaller payloads, and payloads that only null keys have, are responses. A null payload is empty.
    Only small rows meet by payload; the payload itself moves once, by payload and key.
    """
    given = pages.select(F.col(key).alias("key"), F.col(url).cast("string").alias("url"), F.coalesce(F.col(payload).cast("binary"), F.lit(b"")).alias("payload"))
    given = given.withColumn("sha1", F.sha1("payload")).withColumn("payload_bytes", F.octet_length("payload").cast("bigint"))
    small = given.select("key", "url", "sha1", "payload_bytes")
    best = small.filter((F.col("payload_bytes") >= least_revisit) & F.col("key").isNotNull()).groupBy("sha1", "payload_bytes").agg(F.max("key").alias("best"))
    to = best.select(F.col("sha1").alias("sha1_"), F.col("best"))
    responses = given.join(to, (given["sha1"] == to["sha1_"]) & (given["key"] == to["best"])).select("key", "url", "sha1", "payload_bytes", "payload", F.lit("response").alias("record_type"), F.lit(None).cast(small.schema["key"].dataType).alias("refers_to"))
    revisits = small.join(to, (small["sha1"] == to["sha1_"]) & ~small["key"].eqNullSafe(to["best"])).select("key", "url", "sha1", "payload_bytes", F.lit(None).cast("binary").alias("payload"), F.lit("revisit").alias("record_type"), F.col("best").alias("refers_to"))
    # payloads without a chosen response: small ones, and those of null keys alone
    alone = given.join(to, given["sha1"] == to["sha1_"], "left_anti").select("key", "url", "sha1", "payload_bytes", "payload", F.lit("response").alias("record_type"), F.lit(None).cast(small.schema["key"].dataType).alias("refers_to"))
    planned = responses.unionByName(revisits)
    if least_revisit > 0 or dict(pages.dtypes).get(key) is None or pages.schema[key].nullable:
        planned = planned.unionByName(alone.filter((F.col("payload_bytes") < least_revisit) | F.col("key").isNull()))
    return planned.select("key", "url", "payload", "payload_bytes", base32_of_sha1(F.col("sha1")).alias("payload_digest"), "record_type", "refers_to")


def write_archives(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", payload: str = "html", least_revisit: int = 0, chunk: int = CHUNK, date: str = "2024-01-01T00:00:00Z") -> None:
    """Write gzip-compressed archives to the folder ``path``, one file per task.

    A record's header carries its key and the key it refers to as ``X-Key`` and ``X-Refers-To-Key``; null keys have none.
    """
    rows = plan_records(pages, key, url, payload, least_revisit).withColumn("record_id", _uuid(F.monotonically_increasing_id(), F.col("payload_digest")))
    body = F.coalesce("payload", F.lit(b""))
    cut = F.when(F.col("record_type") == "revisit", F.array(F.lit(0))).otherwise(_chunk_ends(body, chunk))
    rows = rows.withColumn("ends", cut).select("*", F.posexplode("ends").alias("at", "end"))
    start = F.when(F.col("at") == 0, 0).otherwise(F.element_at("ends", F.greatest(F.col("at"), F.lit(1))))
    rows = rows.withColumn("data", F.substring(body, start + 1, F.col("end") - start)).withColumn("chunks", F.size("ends"))
    first, last, several = F.col("at") == 0, F.col("at") == F.col("chunks") - 1, F.col("chunks") > 1
    http = F.when(first, F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("payload_bytes").cast("string"), F.lit("\r\n\r\n"))).otherwise("")
    number = (F.col("at") + 1).cast("string")

    def line(name: str, value: Column, when: Column | None = None) -> Column:
        text = F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
        return F.coalesce(text if when is None else F.when(when, text), F.lit(""))

    header = F.concat(
        line("WARC-Type", F.when(first, F.col("record_type")).otherwise("continuation")),
        line("WARC-Record-ID", F.when(first, F.col("record_id")).otherwise(_uuid(F.col("record_id"), number))),
        line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", F.regexp_replace("url", "[\\x00-\\x20]", "%20"), F.col("url") != ""),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest")), first),
        line("WARC-Block-Digest", F.concat(F.lit("sha1:"), base32_of_sha1(F.sha1(F.concat(http.cast("binary"), F.col("data")))))),
        line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), F.col("record_type") == "revisit"),
        line("WARC-Segment-Origin-ID", F.col("record_id"), ~first),
        line("WARC-Segment-Number", number, several),
        line("WARC-Segment-Total-Length", (F.col("payload_bytes") + F.octet_length(F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("payload_bytes").cast("string"), F.lit("\r\n\r\n")))).cast("string"), last & several),
        line("X-Key", F.col("key").cast("string")),
        line("X-Refers-To-Key", F.col("refers_to").cast("string")),
        line("Content-Type", F.when(first, F.lit("application/http; msgtype=response")).otherwise("application/octet-stream")),
        line("Content-Length", (F.octet_length(http) + F.octet_length("data")).cast("string")),
        F.lit("\r\n"), http,
    )
    record = F.concat(F.lit(MARK.encode()), header.cast("binary"), F.col("data"), F.lit(b"\r\n"))
    # the writer puts the last line end of the record
    rows.select(record.cast("string").alias("value")).write.option("lineSep", "\r\n").option("compression", "gzip").text(path)


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """Rows (record_id, chunk_no, segmented, record_type, url, key, refers_to, payload_bytes, payload_digest, data, intact) of archives.

    Works on plain and compressed archives that this module wrote. intact says whether the block has the stated length and
    digest. data is the payload's part, without the HTTP header of a record's first block.
    """
    raw = spark.read.option("lineSep", MARK).text(path).filter("value != ''").select(F.col("value").cast("binary").alias("raw"))
    text = F.col("raw").cast("string")
    # header lines are short; what follows the first empty line is the block
    parts = raw.select(F.substring_index(text, "\r\n\r\n", 1).alias("header"), "raw")
    skip = F.octet_length("header") + 4

    def value(name: str) -> Column:
        found = F.regexp_extract("header", rf"(?im)^{name}:\x20*([^\r\n]*)", 1)
        return F.when(found != "", found)

    parts = parts.select(
        "raw", skip.alias("skip"), value("WARC-Record-ID").alias("own_id"), value("WARC-Segment-Origin-ID").alias("origin"),
        value("WARC-Type").alias("record_type"), value("WARC-Target-URI").alias("url"), value("X-Key").alias("key"), value("X-Refers-To-Key").alias("refers_to"),
        F.substring_index(value("WARC-Payload-Digest"), ":", -1).alias("payload_digest"), F.substring_index(value("WARC-Block-Digest"), ":", -1).alias("block_digest"),
        F.coalesce(value("WARC-Segment-Number").cast("int"), F.lit(1)).alias("chunk_no"),
        value("WARC-Segment-Number").isNotNull().alias("segmented"), value("Content-Length").cast("bigint").alias("length"),
    )
    parts = parts.withColumn("block", F.expr("substring(raw, skip + 1, octet_length(raw) - skip - 4)")).drop("raw", "skip")
    intact = (F.octet_length("block") == F.col("length")) & (base32_of_sha1(F.sha1("block")) == F.col("block_digest"))
    http = F.when(F.col("chunk_no") == 1, F.substring_index(F.col("block").cast("string"), "\r\n\r\n", 1))
    return parts.withColumn("http", http).select(
        F.coalesce("origin", "own_id").alias("record_id"), "chunk_no", "segmented", "record_type", "url", "key", "refers_to",
        F.regexp_extract("http", r"(?im)^Content-Length:\x20*(\d+)", 1).cast("bigint").alias("payload_bytes"), "payload_digest",
        F.when(F.col("chunk_no") == 1, F.expr("substring(block, octet_length(http) + 5, octet_length(block))")).otherwise(F.col("block")).alias("data"), intact.alias("intact"),
    )


def _running(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest and length of each record up to each chunk; one hash state at a time is kept."""
    import base64

    current, state, size, number = None, hashlib.sha1(), 0, 0
    for batch in batches:
        digests, sizes, order = [], [], []
        for record, chunk, data in zip(batch.column("record_id").to_pylist(), batch.column("chunk_no").to_pylist(), batch.column("data")):
            if record != current:
                current, state, size, number = record, hashlib.sha1(), 0, 0
            payload = data.as_buffer()
            state.update(payload)
            size += payload.size
            number += 1
            digests.append(base64.b32encode(state.digest()).decode())
            sizes.append(size)
            order.append(number == chunk)
        yield pa.RecordBatch.from_arrays(
            [batch.column("record_id"), batch.column("chunk_no"), pa.array(sizes, pa.int64()), pa.array(digests, pa.string()), pa.array(order, pa.bool_())],
            names=["record_id", "chunk_no", "size_so_far", "digest_so_far", "in_order"],
        )


def running_digests(chunks: DataFrame) -> DataFrame:
    """Rows (record_id, chunk_no, size_so_far, digest_so_far, in_order): the SHA-1 and length of a payload up to each chunk.

    The chunks of a record are streamed in order through one task, a chunk at a time. in_order is false from a gap on.
    """
    streamed = chunks.select("record_id", "chunk_no", "data").repartition("record_id").sortWithinPartitions("record_id", "chunk_no")
    return streamed.mapInArrow(_running, "record_id string, chunk_no int, size_so_far bigint, digest_so_far string, in_order boolean")


def read_records(chunks: DataFrame) -> DataFrame:
    """One row per record: key, refers_to, record_type, payload_bytes, payload_digest, chunks, intact.

    Length and digest of a response are computed from its chunks; those of a revisit are the stated ones, as it has no body.
    intact: every block has its stated digest, no chunk is missing and the whole has the stated digest and length. Single
    chunks are hashed where they are read; only the chunks of longer records are moved.
    """
    stated = ("record_id", "key", "refers_to", "record_type", "payload_bytes", "payload_digest")
    here = chunks.filter("not segmented").select(
        *stated, F.lit(1).alias("chunks"), F.octet_length("data").cast("bigint").alias("size"), base32_of_sha1(F.sha1("data")).alias("digest"), "intact",
    )
    several = chunks.filter("segmented")
    blocks = several.groupBy("record_id").agg(F.min("intact").alias("intact"))
    moved = running_digests(several).groupBy("record_id").agg(
        F.count(F.lit(1)).cast("int").alias("chunks"), F.max("size_so_far").alias("size"), F.max_by("digest_so_far", "chunk_no").alias("digest"), F.min("in_order").alias("in_order"),
    ).join(blocks, "record_id").select("record_id", "chunks", "size", "digest", (F.col("intact") & F.col("in_order")).alias("intact"))
    whole = here.union(several.filter("chunk_no = 1").select(*stated).join(moved, "record_id"))
    response = F.col("record_type") == "response"
    return whole.select(
        "key", "refers_to", "record_type", F.when(response, F.col("size")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(response, F.col("digest")).otherwise(F.col("payload_digest")).alias("payload_digest"), "chunks",
        (F.col("intact") & (~response | ((F.col("size") == F.col("payload_bytes")) & (F.col("digest") == F.col("payload_digest"))))).alias("intact"),
    )


def archive_round_trip(pages: DataFrame, path: str, chunk: int = CHUNK, least_revisit: int = 0) -> DataFrame:
    """Write a record per page below ``path`` and read the archives back: page_id, payload_bytes, payload_digest, record_type,
    refers_to, chunks, intact. Repeated page rows give a record each; an empty table gives no record."""
    spark = prepare(pages.sparkSession)
    kind = pages.schema["page_id"].dataType
    write_archives(pages, path, chunk=chunk, least_revisit=least_revisit)
    records = read_records(read_chunks(spark, path))
    return records.select(F.col("key").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to"), "chunks", "intact")
