"""Sharding by a k-d tree over metadata: near-equal bytes for each leaf.

Documents are points with one coordinate for each piece of metadata. A node holding more than
one shard is split along the dimension in which its points spread widest, at the weighted median
of their bytes, until every leaf is one shard. Languages and sources lie in order, each as wide
as its share of all bytes.

Documents of equal text are one point, so copies stay together. A group that weighs more than
``HEAVY`` of a shard would leave a median no even choice. Such groups, fewer than 100 a shard,
are first packed, each whole, into as many boxes as there are shards, no box heavier than a
shard; a box is dealt to a side by its place, no side gets more boxes than shards, and the
median is that of the light points which fill up what the boxes leave. Only a group that is
heavier than a shard is cut, into as few pieces as it needs, and one that no box has room for.

Medians are found by counting, never by collecting: a coordinate and a hash that settles ties
make a number of 62 bits, and each round sums the bytes of every node by the next few bits of
that number, until the one bin that holds the median is light or the bits are used up. All
nodes of a level are split in the same rounds, and a round sends at most ``2**STEP`` sums for
each node to the driver.

Defined results: a null text weighs one byte; null metadata are smallest; repeated rows are
placed one by one; an empty table gives an empty result. Columns beside the ones named are
ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tributary.llm.tables import pick, stored

SHARDS = 16
#: Groups heavier than this share of a shard are packed one by one.
HEAVY = 0.01
#: Values of lang or source with less than one part in so many of all bytes lie by their hash.
VALUES = 4096
#: Bits settled in one round.
STEP = 10
#: A median is settled when the undecided bytes are at most this share of a shard.
EXACT = 0.0005
_BITS = 31
#: Rows of a shard that one task numbers, about.
SLICE_ROWS = 5000

#: Coordinates of a point, each from 0 to 2**31 - 1.
DIMENSIONS = ("lang", "source", "length", "age")


def documents(docs: DataFrame) -> DataFrame:
    """(doc_id, row, size, text_crc32, point and metadata) of each document.

    ``row`` is a number of the row's own, and the copy of its table is to be stored. ``point``
    is the same for equal texts.
    """
    texts = pick(docs, doc_id="bigint", text="string", lang="string", source="string")
    return texts.select(
        "doc_id",
        F.monotonically_increasing_id().alias("row"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("bigint").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("point"),
        "lang",
        "source",
    )


def _with_code(rows: DataFrame, name: str, total: int) -> DataFrame:
    """Adds the place of a text column's value: the share of bytes of smaller values and half
    its own. Values too light to tell come last, by their hash."""
    weights = rows.groupBy(name).agg(F.sum("size").alias("bytes"))
    told = weights.where((F.col("bytes") >= total / VALUES) | F.col(name).isNull()).collect()
    before, codes = 0, []
    for row in sorted(told, key=lambda r: (r[name] is not None, r[name] or "")):
        codes.append((row[name], int((before + row.bytes / 2) / max(total, 1) * (2**_BITS - 1))))
        before += row.bytes
    table = rows.sparkSession.createDataFrame(codes, "value string, code bigint")
    spread = F.pmod(F.xxhash64(name), F.lit(2**_BITS)) * F.lit((total - before) / max(total, 1))
    other = (F.lit(before / max(total, 1) * (2**_BITS - 1)) + spread).cast("bigint")
    return (
        rows.join(F.broadcast(table), F.col(name).eqNullSafe(F.col("value")), "left")
        .withColumn(f"{name}_code", F.coalesce("code", F.least(other, F.lit(2**_BITS - 1))))
        .drop("value", "code")
    )


def points(rows: DataFrame, total: int) -> DataFrame:
    """(point, tie, bytes, rows, one column for each dimension) of the stored documents."""
    span = rows.agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).first()
    low, high = span.low or 0, span.high or 0
    top = 2**_BITS - 1
    age = (F.coalesce("doc_id", F.lit(low)) - low) / F.lit(float(max(high - low, 1)))
    length = F.least(F.log2(F.col("size").cast("double")) / 40, F.lit(1.0))
    for name in ("lang", "source"):
        rows = _with_code(rows, name, total)
    grouped = rows.groupBy("point").agg(
        F.sum("size").alias("bytes"),
        F.count("*").alias("rows"),
        F.min("lang_code").alias("lang"),
        F.min("source_code").alias("source"),
        F.max((length * top).cast("bigint")).alias("length"),
        F.min((age * top).cast("bigint")).alias("age"),
    )
    return grouped.withColumn("tie", F.pmod(F.xxhash64("point"), F.lit(2**_BITS)))


@dataclass
class Box:
    """Heavy groups that share a shard."""

    load: int = 0
    #: (point, rows of it), the heaviest first.
    parts: list[tuple[int, int]] = field(default_factory=list)
    #: Coordinates of the heaviest group.
    at: dict[str, int] = field(default_factory=dict)


def packed(groups: list, shards: int, total: int) -> list[Box]:
    """Boxes for heavy groups (point, bytes, rows, coordinates), no more than shards.

    Each group goes whole into the fullest box with room for it. A group heavier than a box
    first fills empty ones; a group that fits nowhere is cut among those with most room.
    """
    # Single texts heavier than a shard leave less for the others.
    room, boxes = total / max(shards, 1), [Box() for _ in range(shards)]
    texts = sorted((g.bytes // g.rows for g in groups for _ in range(min(g.rows, shards))), reverse=True)
    rest, open_ = total, shards
    for size in texts:
        if open_ < 2 or size <= rest / open_:
            break
        rest, open_ = rest - size, open_ - 1
        room = rest / open_

    def put(box: Box, group, rows: int) -> None:
        if not box.parts:
            box.at = {name: group[name] for name in DIMENSIONS}
        box.parts.append((group.point, rows))
        box.load += rows * (group.bytes // group.rows)

    for group in sorted(groups, key=lambda g: (-g.bytes, g.point)):
        size, left = group.bytes // group.rows, group.rows
        while left * size > room and (empty := [box for box in boxes if not box.parts]):
            rows = min(left, max(1, int(room // size)))
            put(empty[0], group, rows)
            left -= rows
        fits = [box for box in boxes if box.load + left * size <= room]
        if left and fits:
            put(max(fits, key=lambda box: box.load), group, left)
            left = 0
        while left:
            box = min(boxes, key=lambda box: box.load)
            rows = min(left, max(1, int((room - box.load) // size)))
            put(box, group, rows)
            left -= rows
    return [box for box in boxes if box.parts]


@dataclass
class Split:
    node: int
    dimension: str
    cut: int  # of coordinate and tie; smaller ones go left


def _number(splits: dict[int, str]) -> Column:
    """Coordinate along the node's dimension, then the tie."""
    out = F.lit(None).cast("bigint")
    for node, name in splits.items():
        value = F.shiftleft(F.col(name), _BITS) + F.col("tie")
        out = F.when(F.col("node") == node, value).otherwise(out)
    return out


def _medians(
    points: DataFrame, wide: dict[int, str], wanted: dict[int, float], target: float
) -> list[Split]:
    """The cut of each node that leaves ``wanted`` of its bytes to the left."""
    total = 2 * _BITS
    placed = points.select("node", "bytes", _number(wide).alias("number")).where(
        "number is not null"
    )
    prefix = dict.fromkeys(wide, 0)  # settled bits of the cut
    before = dict.fromkeys(wide, 0.0)  # bytes left of what is settled
    open_ = set(wide)
    done: dict[int, int] = {}
    used = 0
    while open_ and used < total:
        step = min(STEP, total - used)
        left = total - used - step
        inside = F.lit(False)
        for node in open_:
            inside = inside | (
                (F.col("node") == node)
                & (F.shiftright("number", total - used) == F.lit(prefix[node]))
            )
        bins = (
            placed.where(inside)
            .groupBy("node", F.shiftright("number", left).alias("bin"))
            .agg(F.sum("bytes").alias("bytes"))
            .collect()
        )
        used += step
        for node in list(open_):
            own = sorted((row.bin, row.bytes) for row in bins if row.node == node)
            want = wanted[node]
            for bin_, size in own:
                if before[node] + size >= want or bin_ == own[-1][0]:
                    break
                before[node] += size
            prefix[node] = bin_
            if size <= EXACT * target or used == total:
                # The bin goes to the side that leaves the smaller error.
                right = want - before[node] > size / 2
                done[node] = (bin_ + right) << left
                open_.remove(node)
    return [Split(node, wide[node], done[node]) for node in wide]


def assign(
    points: DataFrame, boxes: list[Box], shards: int, target: float
) -> tuple[DataFrame, list[int]]:
    """(point, shard) of the light points, and the shard of each box."""
    holds = {0: (0, shards, list(range(len(boxes))))}  # node -> first shard, shards, boxes
    points = points.withColumn("node", F.lit(0))
    while any(n > 1 for _, n, _ in holds.values()):
        spread = points.groupBy("node").agg(
            F.sum("bytes").alias("bytes"),
            *[F.struct(F.min(name).alias("low"), F.max(name).alias("high")).alias(name)
              for name in DIMENSIONS],
        )
        light = {row.node: row for row in spread.collect()}
        wide, wanted, after = {}, {}, {}
        for node, (first, n, own) in holds.items():
            if n == 1:
                after[node] = (first, n, own)
                continue

            def width(name: str, node: int = node, own: list[int] = own) -> int:
                ends = [boxes[i].at[name] for i in own]
                if node in light:
                    ends += [light[node][name].low, light[node][name].high]
                return max(ends, default=0) - min(ends, default=0)

            name = max(DIMENSIONS, key=width)
            left, right = n // 2, n - n // 2
            own = sorted(own, key=lambda i: (boxes[i].at[name], boxes[i].parts[0]))
            many = min(max(round(len(own) * left / n), len(own) - right), left)
            after[2 * node + 1] = (first, left, own[:many])
            after[2 * node + 2] = (first + left, right, own[many:])
            if node in light:
                loads = [sum(boxes[i].load for i in part) for part in (own[:many], own[many:])]
                share = (light[node].bytes + sum(loads)) * left / n
                wide[node] = name
                wanted[node] = min(max(share - loads[0], 0), light[node].bytes)
        splits = _medians(points, wide, wanted, target)
        node = F.col("node")
        children = F.lit(None).cast("int")
        for split in splits:
            value = F.shiftleft(F.col(split.dimension), _BITS) + F.col("tie")
            child = F.when(value < split.cut, 2 * split.node + 1).otherwise(2 * split.node + 2)
            children = F.when(node == split.node, child).otherwise(children)
        points = stored(points.withColumn("node", F.coalesce(children, node)), "points")
        holds = after
    leaf = F.lit(0)
    placed = [0] * len(boxes)
    for node_id, (first, _, own) in holds.items():
        leaf = F.when(F.col("node") == node_id, first).otherwise(leaf)
        for i in own:
            placed[i] = first
    return points.select("point", leaf.cast("int").alias("shard")), placed


def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot); slots of a shard have no gap."""
    rows = stored(documents(docs), "documents")
    total = rows.agg(F.sum("size").alias("bytes")).first().bytes or 0
    target = max(total, 1) / shards
    every = stored(points(rows, total), "points")
    heavy = F.col("bytes") > HEAVY * target  # fewer than shards / HEAVY
    boxes = packed(every.where(heavy).collect(), shards, total)
    light, placed = assign(every.where(~heavy), boxes, shards, target)
    pieces: dict[int, list[tuple[int, int]]] = {}
    for box, place in zip(boxes, placed, strict=True):
        for point, n in box.parts:
            pieces.setdefault(point, []).append((place, n))
    table = []
    for point, parts in pieces.items():
        parts.sort()
        until = [sum(n for _, n in parts[: i + 1]) for i in range(len(parts))]
        table.append((point, [place for place, _ in parts], until))
    table = docs.sparkSession.createDataFrame(
        table, "point bigint, places array<int>, until array<bigint>"
    )
    columns = ["doc_id", "row", "size", "text_crc32"]
    rows = rows.join(F.broadcast(table), "point", "left")
    cut = _numbered(rows.where(F.size("places") > 1), "point", "line")
    piece = F.size(F.filter("until", lambda n: n <= F.col("line")))
    out = (
        rows.where("places is null").join(light, "point").select(*columns, "shard")
        .union(rows.where(F.size("places") == 1).select(*columns, F.col("places")[0]))
        .union(cut.select(*columns, F.get("places", piece)))
    )
    out = _numbered(stored(out, "placed"), "shard", "slot")
    return out.select("doc_id", "size", "text_crc32", "shard", "slot")


def _numbered(rows: DataFrame, by: str, name: str) -> DataFrame:
    """Adds the place of each row, from 0, in its group, numbered slice by slice."""
    largest = rows.groupBy(by).agg(F.count("*").alias("n")).agg(F.max("n").alias("n"))
    slices = max(1, -(-(largest.first().n or 0) // SLICE_ROWS))
    rows = rows.withColumn("slice", F.pmod(F.xxhash64("row"), F.lit(slices)))
    up = Window.partitionBy(by).orderBy("slice")
    first = (
        rows.groupBy(by, "slice")
        .agg(F.count("*").alias("n"))
        .withColumn("first", F.sum("n").over(up) - F.col("n"))
        .drop("n")
    )
    place = F.row_number().over(Window.partitionBy(by, "slice").orderBy("row"))
    return (
        rows.withColumn("place", place)
        .join(first, [by, "slice"])
        .withColumn(name, (F.col("first") + F.col("place") - 1).cast("bigint"))
        .drop("slice", "place", "first")
    )
