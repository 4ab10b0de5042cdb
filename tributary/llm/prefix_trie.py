"""The trie of shared beginnings of conversations, and sums over its subtrees.

A node stands for the first d turns of all conversations that begin so. Its key is made of
sums of hashes of (place, turn), so the key of a beginning is a running sum, which slices of
a long conversation can work out side by side.

Sums over subtrees go by bands of a fixed number of depths: a node is handed only to its
ancestors in its own band, the sums that are complete at the roots of bands go through the
same step as the nodes of a tree that is so many times lower, and what comes back is handed
to the ancestors in the band above. A trie of depth D takes log D rounds to the base of the
height, and no node is handed on more than twice that height a round.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tributary.llm.tables import pick, skew_join, stored

#: Depths in a band.
HEIGHT = 4
#: Turns that a conversation may take over from the head of its hundred, less one.
HEADS = 6
#: Characters of ids that one row of a list holds.
CHUNK = 1 << 20

_EMPTY = hashlib.sha256(b"").hexdigest()
_SUM = "decimal(38,0)"


def _numbered(turns: DataFrame) -> DataFrame:
    """(conv, slice, place, n, one, two, chars): turns by number, with two hashes.

    The order of all turns is made by range, so that a conversation may lie in any number
    of tasks; the number of a turn is its place in the slice and the turns in those before.
    """
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    rows = (
        pick(turns, conv_id="bigint", turn="bigint", role="string", text="string")
        .where("conv_id is not null")
        .select(F.col("conv_id").alias("conv"), "turn", role.alias("role"),
                F.sha2(text, 256).alias("digest"), F.length(text).cast("bigint").alias("chars"))
        .withColumn("key", F.sha2(F.concat_ws(" ", F.sha2("role", 256), "digest"), 256))
    )
    order = [F.col(c).asc_nulls_first() for c in ("conv", "turn", "role", "digest")]
    rows = (
        rows.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select(
            "conv", "chars",
            *[
                F.conv(F.substring("key", 1 + 15 * i, 15), 16, 10).cast("bigint").alias(name)
                for i, name in enumerate(("one", "two"))
            ],
            F.spark_partition_id().alias("slice"),
            F.monotonically_increasing_id().alias("line"),
        )
    )
    rows = stored(rows, "turns")
    slices = rows.groupBy("conv", "slice").agg(
        F.min("line").alias("start"), F.count("*").alias("turns")
    )
    whole = Window.partitionBy("conv")
    slices = slices.select(
        "conv", "slice", "start",
        (F.sum("turns").over(whole.orderBy("slice")) - F.col("turns")).alias("before"),
        F.sum("turns").over(whole).alias("n"),
    )
    return rows.join(slices, ["conv", "slice"]).select(
        "conv", "slice", (F.col("line") - F.col("start") + F.col("before")).alias("place"),
        "n", "one", "two", "chars",
    )


def _taken(conv: Column) -> Column:
    return (F.crc32(conv.cast("string").cast("binary")) % HEADS).cast("bigint")


def rebuilt(turns: DataFrame) -> DataFrame:
    """(conv, depth, slice, one, two, chars, last): turns of the rebuilt conversations.

    Conversation c begins with the first h turns of c - c % 100 and goes on with its own
    after the first h; h is crc32(c) % 6. One row of depth 0 opens each conversation.
    """
    rows = stored(_numbered(turns), "numbered")
    convs = rows.where("place = 0").select("conv", "n", _taken(F.col("conv")).alias("h"))
    convs = convs.withColumn("head", F.col("conv") - F.col("conv") % 100)
    heads = convs.select(F.col("conv").alias("head"), F.col("n").alias("offered"))
    convs = stored(
        convs.join(heads, "head", "left")
        .withColumn("m", F.least("h", F.coalesce("offered", F.lit(0).cast("bigint"))))
        .withColumn("length", F.col("m") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
        .select("conv", "head", "h", "m", "length"),
        "convs",
    )
    none = F.lit(0).cast("bigint")
    top = convs.select(
        "conv", none.alias("depth"), F.lit(-1).alias("slice"), none.alias("one"),
        none.alias("two"), none.alias("chars"), (F.col("length") == 0).alias("last"),
    )
    first = rows.where(F.col("place") < HEADS - 1).select(
        F.col("conv").alias("head"), "place", "one", "two", "chars"
    )
    begun = (
        convs.where("m > 0").join(first, "head").where("place < m")
        .withColumn("depth", F.col("place") + 1).withColumn("slice", F.lit(-1))
    )
    # Only slices are many; each (conversation, slice) is no more than a slice.
    ends = rows.select("conv", "slice").distinct().join(convs, "conv")
    own = (
        rows.join(ends, ["conv", "slice"]).where("place >= h")
        .withColumn("depth", F.col("place") - F.col("h") + F.col("m") + 1)
    )
    columns = ["conv", "depth", "slice", "one", "two", "chars"]
    last = (F.col("depth") == F.col("length")).alias("last")
    return top.unionByName(begun.select(*columns, last)).unionByName(own.select(*columns, last))


def _node(depth: Column, one: Column, two: Column) -> Column:
    return F.unhex(F.md5(F.concat_ws(":", depth, one, two)))


def paths(turns: DataFrame) -> DataFrame:
    """(conv, depth, node, parent, chars, last) for each beginning of each conversation."""
    rows = rebuilt(turns)
    # A slice of (place, turn) hashes is summed on its own, then moved by those before it.
    rows = rows.withColumns({
        "one": F.when(F.col("depth") > 0, F.xxhash64("depth", "one", "two")).otherwise(0).cast(_SUM),
        "two": F.when(F.col("depth") > 0, F.xxhash64("two", "depth", "one")).otherwise(0).cast(_SUM),
    })
    rows = stored(rows, "beginnings")
    before = Window.partitionBy("conv").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = rows.groupBy("conv", "slice").agg(F.sum("one").alias("a"), F.sum("two").alias("b"))
    slices = slices.select(
        "conv", "slice",
        *[F.coalesce(F.sum(c).over(before), F.lit(0)).cast(_SUM).alias(c) for c in ("a", "b")],
    )
    within = Window.partitionBy("conv", "slice").orderBy("depth")
    sums = rows.join(slices, ["conv", "slice"]).withColumns({
        "x": (F.sum("one").over(within) + F.col("a")).cast(_SUM),
        "y": (F.sum("two").over(within) + F.col("b")).cast(_SUM),
    })
    parent = _node(
        F.col("depth") - 1, (F.col("x") - F.col("one")).cast(_SUM),
        (F.col("y") - F.col("two")).cast(_SUM),
    )
    return sums.select(
        "conv", "depth", _node(F.col("depth"), F.col("x"), F.col("y")).alias("node"),
        F.when(F.col("depth") > 0, parent).alias("parent"), "chars", "last",
    )


def subtree_sums(paths: DataFrame, nodes: DataFrame, values: list[str], height: int) -> DataFrame:
    """(node, *values): the values summed over each node's subtree, its top included.

    ``paths`` (conv, depth, node) has the whole way to every node of ``nodes`` (node, conv,
    depth, *values) along the node's own ``conv``. Depths begin at 0 and have no gaps.
    """
    ways = paths.select(
        "conv", F.floor(F.col("depth") / height).alias("band"), F.col("depth").alias("up"),
        F.col("node").alias("above"),
    )
    sums = [F.sum(v).alias(v) for v in values]
    banded = nodes.withColumn("band", F.floor(F.col("depth") / height))
    inside = (
        banded.join(ways, ["conv", "band"])
        .where("up <= depth")
        .groupBy(F.col("above").alias("node"))
        .agg(*sums)
    )
    if nodes.where(F.col("depth") >= height).isEmpty():
        return inside
    inside = stored(inside, "inside")
    roots = (
        nodes.where(F.col("depth") % height == 0)
        .select("node", "conv", (F.col("depth") / height).cast("bigint").alias("depth"))
        .join(inside, "node")
    )
    roots = stored(roots, "roots")
    lower = paths.where(F.col("depth") % height == 0).select(
        "conv", (F.col("depth") / height).cast("bigint").alias("depth"), "node"
    )
    whole = subtree_sums(lower, roots, values, height)
    handed = (
        roots.where("depth > 0")
        .select("node", "conv", (F.col("depth") - 1).alias("band"))
        .join(whole, "node")
        .join(ways.drop("up"), ["conv", "band"])
        .select(F.col("above").alias("node"), *values)
    )
    return stored(
        inside.unionByName(handed).groupBy("node").agg(*sums), "subtrees"
    )


def _hashed_lists(ends: DataFrame) -> DataFrame:
    """(node, ends_sha256) of the ids (node, conv) in numeric order, joined by commas.

    Ids are put in order by range, so one node's may fill many tasks; each task joins its
    own to pieces of text, and only pieces meet where a digest is made, one after another.
    """
    schema = pa.schema([("node", pa.binary()), ("first", pa.int64()), ("ids", pa.string())])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, first, ids, size = None, 0, [], 0
        for batch in batches:
            done = []
            for node, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if node != last or size > CHUNK:
                    if last is not None:
                        done.append((last, first, ",".join(ids)))
                    last, first, ids, size = node, conv, [], 0
                ids.append(str(conv))
                size += len(ids[-1]) + 1
            if done:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*done), schema)], schema=schema
                )
        if last is not None:
            yield pa.RecordBatch.from_pylist(
                [{"node": last, "first": first, "ids": ",".join(ids)}], schema
            )

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = pa.schema([("node", pa.binary()), ("ends_sha256", pa.string())])
        last, sha = None, None
        for batch in batches:
            done = []
            for node, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if node == last:
                    sha.update(b",")
                else:
                    if last is not None:
                        done.append((last, sha.hexdigest()))
                    last, sha = node, hashlib.sha256()
                sha.update(ids.encode())
            if done:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*done), out)], schema=out
                )
        if last is not None:
            yield pa.RecordBatch.from_pylist(
                [{"node": last, "ends_sha256": sha.hexdigest()}], out
            )

    ordered = ends.select("node", "conv").repartitionByRange("node", "conv")
    pieces = ordered.sortWithinPartitions("node", "conv").mapInArrow(
        join, "node binary, first long, ids string"
    )
    pieces = pieces.repartition("node").sortWithinPartitions("node", "first")
    return pieces.mapInArrow(digest, "node binary, ends_sha256 string")


def trie(turns: DataFrame, height: int = HEIGHT) -> DataFrame:
    """One row for each node of the trie of rebuilt conversations (see ``rebuilt``).

    Needs conv_id, turn, role and text. Returns conv_id (the smallest member), depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Turns go by ``turn``, null first; turns of equal number by role, then by the digest of
    the text, and equal rows are turns of their own. Null roles and texts are empty. Rows
    without conv_id take no part. A table without conversations has no nodes. Other columns
    are ignored.
    """
    way = stored(paths(turns), "paths")
    nodes = way.groupBy("node").agg(
        F.min("conv").alias("conv"), F.max("depth").alias("depth"), F.max("parent").alias("parent"),
        F.count("*").alias("n_convs"), F.max("chars").alias("chars"),
    )
    nodes = stored(nodes, "nodes")
    children = (
        nodes.where("parent is not null")
        .groupBy(F.col("parent").alias("node"))
        .agg(F.count("*").alias("n_children"))
    )
    nodes = nodes.join(children, "node", "left").withColumns({
        "n_children": F.coalesce("n_children", F.lit(0).cast("bigint")),
        "n_leaves": F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("bigint"),
        "saved_tokens": (F.col("n_convs") - 1) * F.col("chars"),
    })
    nodes = stored(nodes, "nodes")
    values = ["n_leaves", "saved_tokens"]
    sums = subtree_sums(way, nodes.select("node", "conv", "depth", *values), values, height)
    above = nodes.select(F.col("node").alias("parent"), F.col("conv").alias("parent_conv_id"))
    out = skew_join(nodes.drop(*values), above, "parent")
    out = out.join(sums, "node").join(
        _hashed_lists(way.where("last").select("node", "conv")), "node", "left"
    )
    return out.select(
        F.col("conv").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children",
        "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(_EMPTY)).alias("ends_sha256"),
    )
