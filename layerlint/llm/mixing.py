"""Mixing sources to target weights by Poisson replication."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from layerlint.operators.prefix import running
from layerlint.session import prepare, written

PART = 32.0  # largest mean inverted at once; larger means are sums of independent parts
TERMS = 160  # of the distribution of one part; the rest has less than 1e-40
BLOCK = 4096  # parts of a document drawn in one row
SPAN = 65536  # blocks listed by one row


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) from 52 bits of an MD5."""
    digest = F.md5(F.concat_ws(":", *parts))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(2**52))


def repetition_rates(docs: DataFrame, weights: Mapping[str | None, float] | None = None, total_bytes: float | None = None, source: str = "source", text: str = "text") -> DataFrame:
    """One row per source: bytes of its texts and the mean number of copies per document that gives it its weight.

    rate = weight / all weights * total_bytes / bytes. Without ``weights`` every source weighs the same; a source that is not
    in ``weights`` gets none. total_bytes is that of the input unless given. Null is a source of its own. A source without a
    byte of text cannot be weighed and has rate 1.
    """
    sizes = docs.groupBy(F.col(source).alias("source")).agg(F.sum(F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint")).alias("bytes"))
    if weights is None:
        sizes = sizes.withColumn("weight", F.lit(1.0))
    else:
        given = F.lit(0.0)
        for name, weight in weights.items():
            given = F.when(F.col("source").eqNullSafe(F.lit(name)), float(weight)).otherwise(given)
        sizes = sizes.withColumn("weight", given)
    sizes = written(sizes, "mixing-sizes")
    sums = sizes.filter("bytes > 0").agg(F.sum("weight").alias("weight"), F.sum("bytes").alias("bytes")).first()
    total = float(total_bytes if total_bytes is not None else sums["bytes"] or 0)
    rate = F.when(F.col("bytes") > 0, F.col("weight") / F.lit(float(sums["weight"] or 1.0)) * F.lit(total) / F.col("bytes")).otherwise(1.0)
    rates = sizes.withColumn("rate", rate).withColumn("parts", F.greatest(F.ceil(F.col("rate") / PART), F.lit(1)).cast("bigint")).withColumn("mean", F.col("rate") / F.col("parts"))
    # P(X <= k) for k = 0, 1, ...
    start = F.exp(-F.col("mean"))
    steps = F.aggregate(
        F.sequence(F.lit(1), F.lit(TERMS)),
        F.struct(start.alias("p"), start.alias("c"), F.array(start).alias("cdf")),
        lambda s, k: F.struct(
            (s["p"] * F.col("mean") / k).alias("p"), (s["c"] + s["p"] * F.col("mean") / k).alias("c"),
            F.concat(s["cdf"], F.array(s["c"] + s["p"] * F.col("mean") / k)).alias("cdf"),
        ),
    )
    return written(rates.withColumn("cdf", steps["cdf"]), "mixing-rates")


def _blocks(rows: DataFrame) -> DataFrame:
    """A row per block of ``BLOCK`` parts, numbered ``__group``; listed in two steps, so that no row has a long array."""
    last = F.floor((F.col("__parts") - 1) / BLOCK)
    spans = rows.withColumn("__span", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor(last / SPAN))))
    first = F.col("__span") * SPAN
    return spans.withColumn("__group", F.explode(F.sequence(first, F.least(first + (SPAN - 1), last)))).drop("__span")


def _drawn(rows: DataFrame, seed: str) -> DataFrame:
    """``__count``: the sum of the draws of the parts in a block."""
    def draw(part: Column) -> Column:
        return F.size(F.filter("__cdf", lambda c: c <= uniform(F.lit(seed), part.cast("string"), F.col("__name")))).cast("bigint")

    first = F.col("__group") * BLOCK + 1
    parts = F.sequence(first, F.least(first + (BLOCK - 1), F.col("__parts")))
    # the number of the only part is hashed once and not for every term
    one = F.size(F.filter("__cdf", lambda c: c <= F.col("__u"))).cast("bigint")
    rows = rows.withColumn("__u", uniform(F.lit(seed), F.lit("1"), F.col("__name")))
    total = F.aggregate(F.transform(parts, draw), F.lit(0).cast("bigint"), lambda a, b: a + b)
    return rows.withColumn("__count", F.when(F.col("__parts") == 1, one).otherwise(total)).drop("__u")


def replicate(docs: DataFrame, rates: DataFrame, seed: str = "mix", key: str = "doc_id", source: str = "source", text: str = "text", copy: str = "copy_no") -> DataFrame:
    """Each document as many times as a Poisson distribution with its source's rate says, in an order independent of the input.

    The count is the inverse of the distribution at a number hashed from seed, key and text, so it is the same in every run
    and on every cluster; repeated rows have equal counts. All columns stay; ``copy`` counts the copies of a row from 0 and
    replaces a column of that name. Rows go to partitions by a hash of document and copy and are sorted by it there: a global
    shuffle. Null texts hash as empty ones. An empty table gives no rows. A document with very many copies is drawn and listed
    in blocks that go to different tasks.
    """
    name = F.md5(F.concat_ws(":", F.coalesce(F.col(key).cast("string"), F.lit("")), F.coalesce(F.col(text), F.lit(""))))
    rows = docs.drop(copy).withColumn("__name", name)
    own = rates.select(F.col("source").alias("__source"), F.col("parts").alias("__parts"), F.col("mean").alias("__mean"), F.col("cdf").alias("__cdf"))
    rows = rows.join(own, F.col(source).eqNullSafe(F.col("__source"))).drop("__source")
    if rates.filter(F.col("parts") > BLOCK).isEmpty():
        rows = _drawn(rows.withColumn("__group", F.lit(0).cast("bigint")), seed).withColumn("__before", F.lit(0).cast("bigint"))
    else:
        # rows of one name, number of parts and mean draw the same, so that only these are numbered
        draw = ["__name", "__parts", "__mean"]
        many = _drawn(_blocks(rows.filter(F.col("__parts") > BLOCK).select(*draw, "__cdf").dropDuplicates(draw)), seed)
        till = running(many.select(*draw, "__group", "__count"), draw, "__group", F.floor(F.col("__group") / BLOCK), sums={"__till": "__count"})
        before = till.select(*draw, "__group", (F.col("__till") - F.col("__count")).alias("__before"))
        rows = _drawn(_blocks(rows), seed).join(before, [*draw, "__group"], "left").withColumn("__before", F.coalesce("__before", F.lit(0)))
    rows = rows.filter("__count > 0").drop("__cdf", "__parts", "__mean", "__group")
    rows = rows.withColumn(copy, F.explode(F.sequence(F.col("__before"), F.col("__before") + F.col("__count") - 1))).drop("__count", "__before")
    place = F.md5(F.concat_ws(":", F.lit(seed), F.lit("place"), F.col("__name"), F.col(copy).cast("string")))
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.withColumn("__place", place).repartition(partitions, "__place").sortWithinPartitions("__place").drop("__place", "__name")


def mix_sources(docs: DataFrame, weights: Mapping[str | None, float] | None = None, total_bytes: float | None = None, seed: str = "mix") -> DataFrame:
    """Documents replicated so that sources have their target weights in bytes, shuffled globally."""
    prepare(docs.sparkSession)
    return replicate(docs, repetition_rates(docs, weights, total_bytes), seed)


MIX_SQL = f"""
WITH RECURSIVE sizes AS (
  SELECT source, CAST(sum(coalesce(strlen(text), 0)) AS BIGINT) AS bytes FROM documents GROUP BY source
), sums AS (SELECT CAST(count(*) AS DOUBLE) AS weight, CAST(sum(bytes) AS DOUBLE) AS bytes FROM sizes WHERE bytes > 0),
rates AS (
  SELECT source, CASE WHEN s.bytes > 0 THEN 1.0::DOUBLE / sums.weight * sums.bytes / s.bytes ELSE 1.0::DOUBLE END AS rate FROM sizes s, sums
), parts AS (SELECT source, greatest(ceil(rate / {PART}), 1)::INT AS parts, rate / greatest(ceil(rate / {PART}), 1)::INT AS mean FROM rates),
terms(source, k, p, c, mean) AS (
  SELECT source, 0, exp(-mean), exp(-mean), mean FROM parts
  UNION ALL SELECT source, k + 1, p * mean / (k + 1), c + p * mean / (k + 1), mean FROM terms WHERE k < {TERMS}
), draws AS (
  SELECT row_number() OVER () AS r, d.*, j, CAST('0x' || substr(md5('mix:' || j || ':' || md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, ''))), 1, 13) AS BIGINT) / 4503599627370496.0::DOUBLE AS u
  FROM documents d JOIN parts p ON d.source IS NOT DISTINCT FROM p.source, LATERAL (SELECT unnest(generate_series(1, p.parts)) AS j) js
), counts AS (
  SELECT any_value(d.doc_id) AS doc_id, any_value(d.text) AS text, any_value(d.lang) AS lang, any_value(d.source) AS source, any_value(d.n_chars) AS n_chars, count(t.k) AS n
  FROM draws d LEFT JOIN terms t ON d.source IS NOT DISTINCT FROM t.source AND t.c <= d.u GROUP BY d.r, d.j
)
"""
