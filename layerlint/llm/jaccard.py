"""Exact near duplicates by word shingles: a token-group matrix over rare-first prefixes.

1. Texts with equal shingle sets become one *node*; everything below runs on nodes.
2. A linked pair shares a shingle among the first ``n - ceil(t n) + 1`` of each set in any order that holds for all texts. The
   order here is *rare first* in three steps: (A) shingles in the lower ``NEAR`` part of the hash range that at most ``RARE``
   nodes have, (B) all others of the upper part, (C) frequent ones of the lower part. Lists of A and C are counted over all
   nodes, in buckets of packed rows; shingles of a single node come first in the order, link nothing and end there. Most
   nodes have enough of A. Only the others, the *open* nodes, go on to B, counted among open nodes, and C.
3. Similar nodes form *groups*: nodes that picked the same shared shingle are compared with the most typical of them, the one
   with the most frequent shingles, and those that are similar join it. So a group of thousands of near copies costs a few
   comparisons per member.
4. The matrix has a row (shingle, group) per shingle of a group's union. A node queries all other groups that its prefix meets.
   A group opens only if the shingles of the query that its union lacks are few enough for a link and if lengths agree.
5. The query is compared with the members of opened groups exactly, on whole sets, in rounds: the first asks about four members
   of each group, and each later one fifteen times as many as all before it. A link joins two groups, and what lies inside one component is
   not asked again; groups joined in a round go by one name from then on, so a round only looks at its own links. So a query that has many links into a large loose group meets a few of its members and not all. A member
   is met only through a prefix shingle that leaves both sets room for enough common ones.

Every link between different groups passes 4 and 5, links inside a group cannot change components, so components are exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from layerlint.llm.graph import components
from layerlint.llm.words import mix, shingle_sets, slices, utf8
from layerlint.session import prepare, written

NEAR = int(0.35 * 2**64)
RARE = 8  # nodes that have a shingle of step A
LEADERS = 4  # independent groupings
FLUSH = 1 << 19  # listed shingles packed at a time
SALTS = 64
PARTS = 16  # of a group's queries in a round


def node_of(shingles: np.ndarray) -> int:
    """Name of a set, the same for equal sets."""
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


def _nodes(width: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            n, node, near = [], [], []
            for own in shingle_sets(utf8(batch.column("text")), width):
                n.append(len(own))
                node.append(node_of(own) if len(own) else None)
                near.append(int(np.searchsorted(own, np.uint64(NEAR))))
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(n, pa.int64()), pa.array(node, pa.int64()), pa.array(near, pa.int64())], names=["key", "n", "node", "near"])

    return run


def _near_sets(width: int):
    """(node, lower part of its set), once per node and task, of Arrow batches of texts."""

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray]]:
        seen: set[int] = set()
        for batch in slices(batches, "text"):
            for own in shingle_sets(utf8(batch.column("text")), width):
                if len(own) and (node := node_of(own)) not in seen:
                    seen.add(node)
                    yield node, own[: int(np.searchsorted(own, np.uint64(NEAR)))]

    return read


def _far_sets(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray]]:
    """(node, upper part of its set) of Arrow batches of sets."""
    for batch in batches:
        sets = batch.column("shingles")
        values, edges = sets.values.to_numpy(zero_copy_only=False).view(np.uint64), sets.offsets.to_numpy()
        for node, a, b in zip(batch.column("node").to_pylist(), edges, edges[1:]):
            own = values[a:b]
            yield node, own[int(np.searchsorted(own, np.uint64(NEAR))) :]


def _lists(read, buckets: int):
    """Shingles of nodes packed by bucket. A shingle that is common in a task is dealt over ``SALTS`` buckets by node, with a
    mark left in its own bucket, so no list has to meet in one task."""

    def pack(tokens: np.ndarray, nodes: np.ndarray, sets: int) -> pa.RecordBatch:
        order = np.argsort(tokens, kind="stable")
        tokens, nodes = tokens[order], nodes[order]
        first = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]]))
        sizes = np.diff(np.append(first, len(tokens)))
        salted = np.repeat(sizes >= max(256, sets // 16), sizes)
        home = mix(tokens)
        dealt = np.where(salted, mix(home + mix(nodes) % np.uint64(SALTS)), home)
        marks = np.unique(tokens[salted])
        tokens, nodes = np.concatenate([tokens, marks]), np.concatenate([nodes, np.zeros(len(marks), np.uint64)])
        flags = np.concatenate([salted, np.ones(len(marks), bool)])
        bucket = (np.concatenate([dealt, mix(marks)]) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        bucket = bucket[order]
        cuts = np.flatnonzero(np.diff(bucket)) + 1
        parts = zip(*(np.split(x[order], cuts) for x in (tokens, nodes, flags)))
        return pa.RecordBatch.from_arrays(
            [pa.array(bucket[np.concatenate([[0], cuts])]), pa.array([b"".join(x.tobytes() for x in part) for part in parts], pa.binary())],
            names=["bucket", "packed"],
        )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, nodes, waiting = [], [], 0
        for node, some in read(batches):
            tokens.append(some)
            nodes.append(np.full(len(some), node, dtype=np.int64).view(np.uint64))
            waiting += len(some)
            if waiting >= FLUSH:
                yield pack(np.concatenate(tokens), np.concatenate(nodes), len(tokens))
                tokens, nodes, waiting = [], [], 0
        if waiting:
            yield pack(np.concatenate(tokens), np.concatenate(nodes), len(tokens))

    return run


def _shared(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (token, node) of the shingles in a partition's buckets that may have two nodes or more."""
    parts: list[tuple[np.ndarray, ...]] = []
    for batch in batches:
        for packed in batch.column("packed").to_pylist():
            k = len(packed) // 17
            parts.append((
                np.frombuffer(packed, np.uint64, k), np.frombuffer(packed, np.uint64, k, 8 * k), np.frombuffer(packed, bool, k, 16 * k),
            ))
    if not parts:
        return
    tokens, nodes, flags = (np.concatenate(x) for x in zip(*parts))
    parts.clear()
    order = np.argsort(tokens, kind="stable")
    tokens, nodes, flags = tokens[order], nodes[order], flags[order]
    first = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]]))
    sizes = np.diff(np.append(first, len(tokens)))
    # a list of copies of one node has no second node
    lowest, highest = np.minimum.reduceat(nodes, first), np.maximum.reduceat(nodes, first)
    keep = np.repeat((lowest != highest) | np.logical_or.reduceat(flags, first), sizes)
    tokens, nodes = tokens[keep], nodes[keep]
    keep = nodes != 0
    tokens, nodes = tokens[keep].view(np.int64), nodes[keep].view(np.int64)
    for at in range(0, len(tokens), 1 << 16):
        yield pa.RecordBatch.from_arrays([pa.array(tokens[at : at + (1 << 16)]), pa.array(nodes[at : at + (1 << 16)])], names=["token", "node"])


def _texts(width: int):
    """One text per node and task."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in slices(batches, "text"):
            nodes, keep = [], []
            for i, own in enumerate(shingle_sets(utf8(batch.column("text")), width)):
                if len(own) and (node := node_of(own)) not in seen:
                    seen.add(node)
                    nodes.append(node)
                    keep.append(i)
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), batch.column("text").take(pa.array(keep, pa.int64()))], names=["node", "text"])

    return run


def _sets(width: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            own = [x.view(np.int64) for x in shingle_sets(utf8(batch.column("text")), width)]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(own, pa.list_(pa.int64()))], names=["node", "shingles"])

    return run


def _similar(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The rows of ``pairs`` (a, b, ...) whose whole sets are similar."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    return pairs.join(left, "a").join(right, "b").withColumn("both", both).filter(
        100 * F.col("both") >= percent * (F.size("x") + F.size("y") - F.col("both"))
    ).select(*pairs.columns)


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 5, percent: int = 75) -> DataFrame:
    """One row per row of ``docs``: key, n_shingles, component_id, node.

    Texts link if ``100 * common >= percent * union`` over their distinct shingles of ``width`` words; fewer words are one
    shingle. component_id is the smallest key that links reach. A text without words, or null, has no shingle, links with
    nothing and keeps its own key. Null keys take part but are never the smallest: a component of null keys alone has a null
    id. Repeated rows are copies of each other. Other columns are ignored; an empty table gives no rows.
    """
    spark = prepare(docs.sparkSession)
    given = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = given.schema["key"].dataType.simpleString()
    texts = given.select("text")
    rows = written(given.mapInArrow(_nodes(width), f"key {kind}, n bigint, node bigint, near bigint"), "jaccard-rows")
    most = F.col("n") - F.floor((percent * F.col("n") + 99) / 100) + 1  # length of a prefix
    nodes = rows.filter("node is not null").groupBy("node").agg(F.min("key").alias("first_key"), F.min("n").alias("n"), F.min("near").alias("near")).withColumn("most", most)

    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def shared_of(source: DataFrame, read, name: str) -> DataFrame:
        """(token, node, df) of shingles that two nodes or more have."""
        packed = source.mapInArrow(_lists(read, 8 * partitions), "bucket bigint, packed binary").repartition(partitions, "bucket")
        pairs = written(packed.mapInArrow(_shared, "token bigint, node bigint").distinct(), name)
        counted = pairs.groupBy("token").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
        return written(pairs.join(counted, "token"), f"{name}-counted")

    own = Window.partitionBy("node")
    by_df = F.row_number().over(own.orderBy("df", "token"))
    near = shared_of(texts, _near_sets(width), "jaccard-near")
    state = nodes.join(near.groupBy("node").agg(F.count(F.lit(1)).alias("s"), F.count_if(F.col("df") > RARE).alias("hot"), F.sum(F.log("df")).alias("known")), "node", "left").fillna(0, ["s", "hot", "known"])
    state = written(state.withColumn("a", F.col("near") - F.col("hot")), "jaccard-state")
    # step A: near shingles of one node, then those of a few
    step_a = near.filter(F.col("df") <= RARE).withColumn("at", by_df).join(state, "node").withColumn("place", F.col("near") - F.col("s") + F.col("at")).filter("place <= most").select("token", "node", "n", "place")
    open_nodes = state.filter(F.col("a") < F.col("most"))

    # whole sets of the nodes that may have a link
    met = written(step_a.join(step_a.groupBy("token").agg(F.count(F.lit(1)).alias("met")).filter("met > 1"), "token").select("token", "node", "n"), "jaccard-a")
    wanted = written(met.select("node").union(open_nodes.select("node")).distinct(), "jaccard-wanted")
    sets = written(
        texts.mapInArrow(_texts(width), "node bigint, text string").join(wanted, "node").dropDuplicates(["node"])
        .mapInArrow(_sets(width), "node bigint, shingles array<bigint>"), "jaccard-sets",
    )

    # steps B and C for open nodes
    opened = written(open_nodes.select("node", "n", "near", "a", "most", "known", (F.col("n") - F.col("near")).alias("far")), "jaccard-open")
    far = shared_of(sets.join(opened.select("node"), "node"), _far_sets, "jaccard-far")
    counts = far.groupBy("node").agg(F.count(F.lit(1)).alias("s_far"))
    step_b = far.withColumn("at", by_df).join(opened, "node").join(counts, "node").withColumn("place", F.col("a") + F.col("far") - F.col("s_far") + F.col("at")).filter("place <= most").select("token", "node", "n", "place")
    step_c = near.filter(F.col("df") > RARE).withColumn("at", by_df).join(opened, "node").withColumn("place", F.col("a") + F.col("far") + F.col("at")).filter("place <= most").select("token", "node", "n", "place")
    prefix = written(step_a.union(step_b).union(step_c), "jaccard-prefix")
    prefix = written(prefix.join(prefix.groupBy("token").agg(F.count(F.lit(1)).alias("met")).filter("met > 1"), "token").select("token", "node", "n", (F.col("n") - F.col("place") + 1).alias("room")), "jaccard-met")

    # groups around the most typical node of a shared shingle
    living = prefix.select("node").distinct()
    known = written(near.join(living, "node"), "jaccard-known")
    widest = known.groupBy("node").agg(F.max("df").alias("top"))
    picks = known.join(widest, "node").groupBy("node").agg(*[
        F.min_by("token", F.xxhash64("token", F.lit(k))).alias(f"g{k}") if k else F.min_by("token", F.struct((2 * F.col("df") < F.col("top")).alias("low"), F.xxhash64("token"))).alias("g0")
        for k in range(LEADERS)
    ])
    typical = state.select("node", F.round(F.col("known") / F.greatest(F.col("near"), F.lit(1)), 6).alias("typical"))
    named = written(
        picks.join(typical, "node").select("node", "typical", F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col(f"g{k}").alias("g")) for k in range(LEADERS)])))
        .select("node", "typical", "col.k", "col.g"), "jaccard-named",
    )
    leaders = named.groupBy("k", "g").agg(F.max(F.struct("typical", "node"))["node"].alias("b"), F.count(F.lit(1)).alias("size")).filter("size > 1")
    stars = named.join(leaders, ["k", "g"]).filter(F.col("node") != F.col("b")).select(F.col("node").alias("a"), "b").distinct()
    links = written(_similar(stars, sets, percent), "jaccard-stars")
    groups = components(links, "jaccard-groups").withColumnRenamed("component", "grp")

    # Queries against the groups that their prefixes meet. A pair of sizes n and m needs percent * (n + m) / (100 + percent)
    # common shingles, so what a set has but for shingles that it alone has must be as many. Upper shingles are known to be
    # a node's own among open nodes only. From the first common shingle on, either set has room for its later ones only.
    own_far = opened.join(counts, "node", "left").select("node", (F.col("far") - F.coalesce("s_far", F.lit(0))).alias("alone_far"))
    common = state.join(own_far, "node", "left").select(
        "node", (F.col("n") - F.col("near") + F.col("s")).alias("common"),
        (F.col("n") - F.col("near") + F.col("s") - F.coalesce("alone_far", F.lit(0))).alias("common_open"), F.col("alone_far").isNotNull().alias("is_open"),
    )
    member = written(prefix.join(groups, "node", "left").withColumn("grp", F.coalesce("grp", "node")).join(common, "node"), "jaccard-member")
    members = written(member.drop("token", "room").distinct(), "jaccard-members")
    size = members.groupBy(F.col("grp").alias("other")).agg(
        F.count(F.lit(1)).alias("members"), F.min("n").alias("low"), F.max("n").alias("high"), F.max("common").alias("most_common"),
        F.max("common_open").alias("most_open"), F.min("is_open").alias("all_open"),
    )
    cells = written(member.groupBy("token", F.col("grp").alias("other")).agg(F.max("room").alias("most_room")).join(size, "other"), "jaccard-cells")
    both_open = F.col("is_open") & F.col("all_open")
    needed = percent * (F.col("n") + F.col("low"))
    enough = (100 + percent) * F.least("room", "most_room", F.when(both_open, F.col("common_open")).otherwise(F.col("common")), F.when(both_open, F.col("most_open")).otherwise(F.col("most_common"))) >= needed
    lengths = (100 * F.col("high") >= percent * F.col("n")) & (100 * F.col("n") >= percent * F.col("low"))
    # each pair of groups is asked from the one with the larger name; a large group has a small one
    left, right = member.alias("q"), cells.alias("c")
    through = written(
        left.join(right, (F.col("q.token") == F.col("c.token")) & (F.col("c.other") < F.col("q.grp")) & enough & lengths)
        .select("node", "n", "room", "grp", "q.token", "other", "members"), "jaccard-asked",
    )
    asked = through.select("node", "n", "grp", "other", "members").distinct()
    many = asked.filter("members > 1").select("node", "n", "other")
    asking = written(many.select("node").distinct(), "jaccard-asking")
    asked_of = many.select("other").distinct()
    # members of those groups, not their shingles, are looked for by group: a large group has many shingles
    inside = members.select("node", F.col("grp").alias("other")).join(asked_of, "other", "left_semi")
    union = known.join(inside, "node").select("token", "other").distinct()
    hits = known.join(asking, "node").select("node", "token").join(many, "node").join(union, ["token", "other"]).groupBy("node", "other").agg(F.count(F.lit(1)).alias("hits"))
    # shingles of the query that the union lacks, of the lower part only: a lower bound of all. A short query may have none
    # there in common, or none at all, and still pass
    passed = (
        many.join(hits, ["node", "other"], "left").fillna(0, ["hits"]).join(state.select("node", "near", "most"), "node")
        .filter(F.col("near") - F.col("hits") <= F.col("most") - 1).select("node", "other")
    )
    # one and two: what the groups of a pair are called by now
    single = asked.filter("members = 1").select(F.col("node").alias("a"), F.col("other").alias("b"), F.col("grp").alias("one"), F.col("other").alias("two"))
    similar = written(_similar(single, sets, percent), "jaccard-single")
    waiting = asked.filter("members > 1").join(passed, ["node", "other"]).select("node", "other", F.col("grp").alias("one"), F.col("other").alias("two"))
    # a group's members in the order of a hash: round k asks those before place 4, 64, 1024, ... that no round before it asked
    place = F.pmod(F.xxhash64(F.lit("turn"), "node"), F.lit(1 << 32)) / F.lit(float(1 << 32)) * F.col("members")
    turn = F.greatest(F.floor((F.log2(place) + 2) / 4), F.lit(0)).cast("int")
    turn = F.when(F.col("members") > 4, F.coalesce(turn, F.lit(0))).otherwise(0)
    hit = through.filter("members > 1")
    mates = member.select("token", F.col("grp").alias("other"), "node", "n", "room").join(hit.select("token", "other", "members").distinct(), ["token", "other"])
    mates = written(mates.select("token", "other", F.col("node").alias("b"), F.col("n").alias("m"), F.col("room").alias("rest"), turn.alias("turn")), "jaccard-mates")
    fits = (100 + percent) * F.least("room", "rest") >= percent * (F.col("n") + F.col("m"))
    renamed: list[DataFrame] = []  # (node, component): old and new name of what was joined, one table per round with links

    def joined(waiting: DataFrame, similar: DataFrame) -> DataFrame:
        """The pairs that still wait, by the names that their groups have after the links of ``similar``."""
        if similar.isEmpty():
            return waiting
        names = components(similar.select(F.col("one").alias("a"), F.col("two").alias("b")), "jaccard-tied")
        renamed.append(names)
        for name in ("one", "two"):
            waiting = waiting.join(names.select(F.col("node").alias(name), "component"), name, "left").withColumn(name, F.coalesce("component", name)).drop("component")
        return waiting.filter("one != two").select("node", "other", "one", "two")

    waiting = joined(waiting, similar)
    rounds = mates.agg(F.max("turn")).first()[0]
    for k in range(0 if rounds is None else rounds + 1):
        waiting = written(waiting, "jaccard-waiting")
        if waiting.isEmpty():
            break
        now = mates.filter(F.col("turn") == k).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))
        part = F.pmod(F.xxhash64("node"), F.lit(PARTS)).cast("int")
        asker = hit.select("node", "n", "room", "token", "other", part.alias("part")).join(waiting, ["node", "other"]).alias("q")
        same = (F.col("q.token") == F.col("mate.token")) & (F.col("q.other") == F.col("mate.other")) & (F.col("q.part") == F.col("mate.part"))
        alike = (100 * F.col("n") >= percent * F.col("m")) & (100 * F.col("m") >= percent * F.col("n"))
        tried = asker.join(now.alias("mate"), same & alike & fits).select(F.col("node").alias("a"), "b", "one", "two").distinct()
        similar = written(_similar(tried, sets, percent), "jaccard-links")
        waiting = joined(waiting, similar)

    found = members.select("node", F.col("grp").alias("component"))
    if renamed:
        last = reduce(DataFrame.union, [names.select("node") for names in renamed]).distinct().withColumn("last", F.col("node"))
        for names in renamed:
            last = last.join(names.select(F.col("node").alias("last"), "component"), "last", "left").select("node", F.coalesce("component", "last").alias("last"))
        last = last.select(F.col("node").alias("component"), "last")
        found = found.join(last, "component", "left").select("node", F.coalesce("last", "component").alias("component"))
    found = written(found, "jaccard-components")
    best = nodes.join(found, "node").groupBy("component").agg(F.min("first_key").alias("component_id"))
    # texts without a link have the first key of their copies
    ids = nodes.join(found.join(best, "component").select("node", "component_id"), "node", "left").select("node", F.coalesce("component_id", "first_key").alias("component_id"))
    return rows.join(ids, "node", "left").select(
        F.col("key").alias(key), F.col("n").alias("n_shingles"),
        F.when(F.col("node").isNull(), F.col("key")).otherwise(F.col("component_id")).alias("component_id"), "node",
    )
