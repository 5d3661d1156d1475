"""The trie of conversations that begin alike, with totals of every subtree, rolled up by bands of depth.

A node is a distinct sequence of first turns.  Paths are cut into bands of fixed height.  Inside a band every node sends
its values to its ancestors there, at most ``height`` of them.  The topmost nodes of the bands, with the totals of
their bands, form a smaller trie of the same kind, which is rolled up likewise; its completed totals go from each such
node to its parent and that one's ancestors in the band above.  A path of ``d`` turns thus takes about ``log(d)`` to
the base ``height`` rounds.  Names of nodes are digests built the same way, so that no task sees more than ``height``
turns of a conversation at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .mixing import word_count
from .ranking import ranged_sums
from .tables import removed, stored

HEIGHT = 16
ROOT = "X''"
# Bytes of joined ids that one row carries.
BLOB = 1 << 16


def digest(data: Column) -> Column:
    """The first 16 bytes of the SHA-256."""
    return F.unhex(F.substring(F.sha2(data, 256), 1, 32))


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rebuilt conversations, as ``conv_id, pos, turn, words, n``, and every ``conv_id`` with its length ``n``.

    ``turns`` has ``conv_id, i, turn, words``, ``i`` from 1.  Conversation ``c`` gets the first ``h`` turns of
    conversation ``c - c % 20``, then its own after its first ``h``, where ``h = crc32(c) % 4``.
    """
    lengths, _ = stored(turns.groupBy("conv_id").agg(F.max("i").alias("own")), "trie-lengths")
    head = F.expr("crc32(CAST(CAST(conv_id AS STRING) AS BINARY)) % 4")
    convs = lengths.select("conv_id", "own", head.alias("h"), F.expr("conv_id - conv_id % 20").alias("first_id"))
    firsts = lengths.select(F.col("conv_id").alias("first_id"), F.col("own").alias("there"))
    convs = convs.join(firsts, "first_id", "left").withColumn("lent", F.expr("least(h, coalesce(there, 0))"))
    convs = convs.withColumn("n", F.expr("lent + greatest(own - h, 0)"))
    convs, _ = stored(convs.select("conv_id", "first_id", "h", "lent", "n"), "trie-conversations")
    heads = turns.where("i <= 3 AND conv_id % 20 = 0").withColumnRenamed("conv_id", "first_id")
    lent = heads.join(convs, "first_id").where("i <= h").select("conv_id", F.col("i").alias("pos"), "turn", "words", "n")
    own = turns.join(convs.drop("first_id"), "conv_id").where("i > h")
    own = own.select("conv_id", F.expr("lent + i - h").alias("pos"), "turn", "words", "n")
    return lent.unionByName(own), convs.select("conv_id", "n")


def banded(items: DataFrame, height: int) -> DataFrame:
    """Collect ``conv_id, pos, ...`` into ``conv_id, band, items``, at most ``height`` in order of ``pos``."""
    band = F.expr(f"CAST((pos - 1) div {height} AS BIGINT)").alias("band")
    item = F.struct("pos", *[c for c in items.columns if c not in ("conv_id", "pos")])
    return items.groupBy("conv_id", band).agg(F.sort_array(F.collect_list(item)).alias("items"))


def named(items: DataFrame, height: int, longest: int) -> DataFrame:
    """Bands as ``conv_id, band, items, start, ids``: names of all prefixes of each conversation's ``turn`` digests.

    ``ids`` are the names of the prefixes that end inside the band, ``start`` is that of the prefix before it.  Equal
    sequences, and only those, get equal names.  A full band's digest is a turn of the level above, where the prefix
    up to the end of the band is named.
    """
    bands = banded(items, height)
    chain = F.aggregate(
        "items",
        F.expr("CAST(array() AS ARRAY<BINARY>)"),
        lambda done, x: F.concat(done, F.array(digest(F.concat(F.coalesce(F.try_element_at(done, F.lit(-1)), F.expr(ROOT)), x["turn"])))),
    )
    bands = bands.withColumn("local", chain)
    if longest <= height:
        start, full = F.expr(ROOT), F.lit(None).cast("binary")
    else:
        bands, _ = stored(bands, "trie-local")
        whole = bands.where(F.size("local") == height)
        whole = whole.select("conv_id", (F.col("band") + 1).alias("pos"), F.element_at("local", -1).alias("turn"))
        above = named(whole, height, longest // height)
        ids = above.select("conv_id", F.posexplode("ids").alias("k", "id"), "band")
        ends = F.expr(f"band * {height} + k")
        ids = ids.select("conv_id", F.explode(F.array(
            F.struct((ends + 1).alias("band"), F.col("id").alias("start"), F.lit(None).cast("binary").alias("full")),
            F.struct(ends.alias("band"), F.lit(None).cast("binary").alias("start"), F.col("id").alias("full")),
        )).alias("edge")).select("conv_id", "edge.*")
        edges = ids.groupBy("conv_id", "band").agg(F.max("start").alias("start"), F.max("full").alias("full"))
        bands = bands.join(edges, ["conv_id", "band"], "left")
        start, full = F.coalesce("start", F.expr(ROOT)), F.col("full")
    bands = bands.withColumn("start", start).withColumn("full", full)
    last = F.lit(height)
    ids = F.transform(
        "local", lambda x, k: F.when((k + 1 == last) & F.col("full").isNotNull(), F.col("full")).otherwise(digest(F.concat("start", x)))
    )
    return bands.select("conv_id", "band", "items", "start", ids.alias("ids"))


def paths(bands: DataFrame) -> DataFrame:
    """Every node once: ``id, parent, path``, where ``path`` leads through its band down to itself."""
    at = bands.select("start", "ids", F.posexplode("ids").alias("k", "id"))
    parent = F.expr("CASE WHEN k = 0 THEN start ELSE ids[k - 1] END").alias("parent")
    at = at.select("id", parent, F.expr("slice(ids, 1, k + 1)").alias("path"))
    return at.groupBy("id").agg(F.any_value("parent").alias("parent"), F.any_value("path").alias("path"))


def up(df: DataFrame, values: tuple[str, ...]) -> DataFrame:
    return df.select(F.explode("path").alias("id"), *values).groupBy("id").agg(*[F.sum(v).alias(v) for v in values])


def rolled(bands: DataFrame, own: DataFrame, values: tuple[str, ...], height: int, longest: int) -> DataFrame:
    """``id`` and the sums of ``values`` over its subtree; ``bands`` as of :func:`named`, ``own`` the nodes' values."""
    nodes, _ = stored(paths(bands).join(own, "id", "left"), "trie-nodes")
    inside = up(nodes, values)
    if longest <= height:
        return inside
    inside, _ = stored(inside, "trie-inside")
    tops = bands.select("conv_id", (F.col("band") + 1).alias("pos"), F.col("ids")[0].alias("id"))
    # The last of a band of tops also opens the next one.
    again = tops.where(F.col("pos") % height == 0).withColumn("open", F.lit(1))
    groups = tops.withColumn("open", F.lit(0)).unionByName(again)
    band = F.expr(f"CAST((pos - 1) div {height} AS BIGINT) + open").alias("band")
    groups = groups.groupBy("conv_id", band).agg(F.sort_array(F.collect_list(F.struct("pos", "id", "open"))).alias("all"))
    start = F.expr("CASE WHEN all[0].open = 1 THEN all[0].id END").alias("start")
    ids = F.expr("transform(filter(all, x -> x.open = 0), x -> x.id)").alias("ids")
    groups = groups.select("conv_id", "band", start, ids).where(F.size("ids") > 0)
    groups, _ = stored(groups, "trie-tops")
    top_ids = groups.select(F.explode("ids").alias("id")).distinct()
    done, _ = stored(rolled(groups, inside.join(top_ids, "id"), values, height, -(-longest // height)), "trie-done")
    joins = nodes.where(F.size("path") == 1).select("id", "parent").join(done, "id")
    sums = joins.groupBy("parent").agg(*[F.sum(v).alias(v) for v in values]).withColumnRenamed("parent", "id")
    below = up(nodes.select("id", "path").join(sums, "id"), values)
    return inside.unionByName(below).groupBy("id").agg(*[F.sum(v).alias(v) for v in values])


def joined_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows ``id, conv_id`` to rows ``id, conv_id, ids``: the first of a run and its ids, comma-joined."""
    at, first, parts, size = None, None, [], 0
    for batch in batches:
        out = []
        for node, conv in zip(batch["id"].to_pylist(), batch["conv_id"].to_pylist()):
            if node != at or size >= BLOB:
                if parts:
                    out.append((at, first, ",".join(parts)))
                at, first, parts, size = node, conv, [], 0
            parts.append(str(conv))
            size += len(parts[-1]) + 1
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else ((), (), ()), (pa.binary(), pa.int64(), pa.string()))], ["id", "conv_id", "ids"])
    if parts:
        yield pa.RecordBatch.from_arrays([pa.array([at], pa.binary()), pa.array([first], pa.int64()), pa.array([",".join(parts)])], ["id", "conv_id", "ids"])


def hashed_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows of :func:`joined_ids` to ``id, ends``: the SHA-256 of each node's ids, fed piece by piece."""
    at, state = None, None
    for batch in batches:
        out = []
        for node, ids in zip(batch["id"].to_pylist(), batch["ids"].to_pylist()):
            if node != at:
                if state:
                    out.append((at, state.hexdigest()))
                at, state = node, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.binary()), pa.array([x[1] for x in out], pa.string())], ["id", "ends"])
    if state:
        yield pa.RecordBatch.from_arrays([pa.array([at], pa.binary()), pa.array([state.hexdigest()])], ["id", "ends"])


def ended(ends: DataFrame, partitions: int) -> DataFrame:
    """``id, ends`` of rows ``id, conv_id``: the hash of each node's ascending ids.

    Ranges of node and id are joined to strings by many tasks; one task then reads a node's strings in order.
    """
    ranges = ends.repartitionByRange(partitions, "id", "conv_id").sortWithinPartitions("id", "conv_id")
    blobs = ranges.mapInArrow(joined_ids, "id binary, conv_id bigint, ids string")
    ordered = blobs.repartition(partitions, "id").sortWithinPartitions("id", "conv_id")
    return ordered.mapInArrow(hashed_ids, "id binary, ends string")


def conversation_trie(conversations: DataFrame, height: int = HEIGHT) -> DataFrame:
    """One row per node of the trie of rebuilt conversations.

    Columns: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``.  Needs
    ``conv_id, turn, role, text``; other columns, whatever their names, are not read.  Turns are ordered by ``turn``,
    null first; ties by a digest of role and text; repeated rows are turns of their own.  A null role or text is
    empty.  Rows without a ``conv_id`` belong to no conversation: a node is named by an id.  An empty table gives no
    node, else the root is the one node of depth 0, its parent null.  Turns are told apart by 128 bits of SHA-256.
    """
    spark = conversations.sparkSession
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turn = digest(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").alias("place"),
        turn.alias("turn"),
        word_count(text).alias("words"),
        F.monotonically_increasing_id().alias("row"),
        F.lit(1).alias("one"),
    )
    rows, path = stored(rows, "trie-rows")
    order = [F.col("place").asc_nulls_first(), F.col("turn").asc(), F.col("row").asc()]
    placed = ranged_sums(rows, ["conv_id"], order, "one", "trie-ranges")
    placed, _ = stored(placed.select("conv_id", (F.col("before") + 1).alias("i"), "turn", "words"), "trie-turns")
    removed(spark, path)
    items, convs = rebuilt(placed)
    n_convs, least, longest = convs.agg(F.count("*"), F.min("conv_id"), F.coalesce(F.max("n"), F.lit(0))).first()
    bands, _ = stored(named(items, height, longest), "trie-bands")

    at = bands.select("conv_id", "band", "ids", "items", "start", F.posexplode("ids").alias("k", "id"))
    at = at.select(
        "conv_id",
        "id",
        F.expr("items[k].pos").alias("depth"),
        F.expr("items[k].words").alias("words"),
        F.expr("items[k].n").alias("n"),
        F.expr("CASE WHEN k = 0 THEN start ELSE ids[k - 1] END").alias("parent"),
    )
    nodes = at.groupBy("id", "depth", "parent").agg(
        F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.max("words").alias("words")
    )
    root = spark.range(1 if n_convs else 0).select(
        F.expr(ROOT).alias("id"), F.lit(0).cast("bigint").alias("depth"), F.lit(None).cast("binary").alias("parent"),
        F.lit(n_convs).cast("bigint").alias("n_convs"), F.lit(least).cast("bigint").alias("conv_id"),
        F.lit(0).cast("bigint").alias("words"),
    )
    nodes, _ = stored(nodes.unionByName(root), "trie-counts")
    children = nodes.groupBy(F.col("parent").alias("id")).agg(F.count("*").alias("n_children"))
    nodes = nodes.join(children.where("id IS NOT NULL"), "id", "left").na.fill(0, ["n_children"])
    nodes = nodes.withColumn("n_leaves", F.expr("CAST(n_children = 0 AS BIGINT)"))
    nodes = nodes.withColumn("saved_tokens", F.expr("(n_convs - 1) * words"))
    nodes, _ = stored(nodes, "trie-values")

    values = ("n_leaves", "saved_tokens")
    totals = rolled(bands, nodes.select("id", *values), values, height, longest)
    totals, _ = stored(totals, "trie-totals")
    every = nodes.where("depth = 1").select("id").join(totals, "id").agg(*[F.sum(v).alias(v) for v in values])
    every = every.select(F.expr(ROOT).alias("id"), F.expr("coalesce(n_leaves, 1)").alias("n_leaves"), F.expr("coalesce(saved_tokens, 0)").alias("saved_tokens"))
    last = at.where("depth = n").select("id", "conv_id")
    last = last.unionByName(convs.where("n = 0").select(F.expr(ROOT).alias("id"), "conv_id"))
    hashes = ended(last, int(spark.conf.get("spark.sql.shuffle.partitions")))

    full = nodes.drop(*values).join(totals.unionByName(every), "id").join(hashes, "id", "left")
    parents = nodes.where("n_children > 0").select(F.col("id").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    # A parent may have a third of all nodes as children: the last join is one that Spark splits when it is skewed.
    return full.join(parents, "parent", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.expr("coalesce(ends, sha2('', 256))").alias("ends_sha256"),
    )
