"""SimHash near-duplicates, found through deletion variants of half fingerprints.

A fingerprint has 64 bits. Two that differ in at most three bits differ in at most one bit
of their left or of their right half. So each half is indexed under 32 variants, each with
another bit wiped out: halves that differ in one bit meet where that bit is wiped out, equal
halves meet everywhere. Fingerprints that meet are compared bit by bit.

Equal fingerprints are merged first, so copies cost nothing. The pairs under one variant are
compared in numpy and only a spanning star of what is linked leaves a task, never all pairs. A
variant with more than ``MEET`` fingerprints is dealt out again by variants of the quarters
of the other half, under which at most 2**18 different fingerprints can meet. The most crowded
ones, found on a part of the fingerprints, are dealt out before they ever meet in one task.

Defined results: null and empty texts have no words and the fingerprint zero, which links like
any other; a text of fewer than three words is one shingle; repeated rows are linked to each
other and each gets a row; a null id never names a component unless all ids in it are null; an
empty table gives an empty result. Columns beside the ones named are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from tributary.llm.components import components
from tributary.llm.tables import as_rows, batches, from_rows, pick, place, stored

SHINGLE = 3
MAX_BITS = 3
MEET = 2048
_SLICE = 1 << 15
# Crowded keys are looked for among one print in so many; so many keys at most are dealt out
# before their prints meet, each over so many tasks.
_SEEN, _KEYS, _DEALS = 64, 4096, 64
_NO_ID = -(2**63)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64 bits, each set if it is set in over half of the hashes of the shingles."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        hashed = [b" ".join(words)]
        n = 1
    else:
        hashed = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
        n = len(words) - shingle + 1
    hashes = np.fromiter(map(xxh64_intdigest, hashed, repeat(42)), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, _SLICE):  # so that a very long text needs little memory
        part = hashes[at : at + _SLICE].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, text_hash, print) of each document."""
    texts = pick(docs, doc_id="bigint", text="string").withColumn(
        "text_hash", F.xxhash64("text")
    )

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        own = [fingerprint(x.as_py(), shingle) for x in part.column("text")]
        prints = np.array(own, np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays(
            [part.column("doc_id"), part.column("text_hash"), pa.array(prints)],
            ["doc_id", "text_hash", "print"],
        )

    return batches(texts, work, "doc_id bigint, text_hash bigint, print bigint")


def _variants(keys: np.ndarray, values: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    """Keys continued by the wiped-out bit and what is left of the ``bits`` bits."""
    for bit in range(bits):
        left = values & np.uint64(~(1 << bit) & ((1 << bits) - 1))
        yield ((keys * np.uint64(bits) + np.uint64(bit)) << np.uint64(bits)) | left


def _halves(part: pa.RecordBatch) -> pa.RecordBatch:
    prints = part.column("print").to_numpy().view(np.uint64)
    keys = [
        key
        for half in (0, 1)
        for key in _variants(
            np.full(len(prints), half, np.uint64),
            (prints >> np.uint64(32 * half)) & np.uint64(0xFFFFFFFF),
            32,
        )
    ]
    return _keyed(keys, prints)


def _quarters(part: pa.RecordBatch) -> pa.RecordBatch:
    """Variants of the half that the first variant does not cover."""
    prints = part.column("print").to_numpy().view(np.uint64)
    first = part.column("key").to_numpy().view(np.uint64)
    half = first >> np.uint64(37)
    other = (prints >> ((np.uint64(1) - half) * np.uint64(32))) & np.uint64(0xFFFFFFFF)
    keys = [
        key
        for quarter in (0, 1)
        for key in _variants(
            first * np.uint64(2) + np.uint64(quarter),
            (other >> np.uint64(16 * quarter)) & np.uint64(0xFFFF),
            16,
        )
    ]
    return _keyed(keys, prints)


def _keyed(keys: list[np.ndarray], prints: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.concatenate(keys).view(np.int64)),
            pa.array(np.tile(prints, len(keys)).view(np.int64)),
        ],
        ["key", "print"],
    )


class _Sets:
    """Union-find over fingerprints."""

    def __init__(self) -> None:
        self.parent: dict[int, int] = {}

    def root(self, x: int) -> int:
        parent = self.parent
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[up]
        return x

    def link(self, a: int, b: int) -> None:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)


def _compare(
    keys: np.ndarray, prints: np.ndarray, wiped: np.ndarray, max_bits: int, sets: _Sets
) -> None:
    """Links what differs in few bits among rows of one key; rows are sorted by key.

    ``wiped`` is the bit that a key ignores, or -1. Pairs that agree in it meet under every
    other variant too, so they are left to the one marked -1.
    """
    at = np.arange(len(keys))
    step = 1
    while len(at := at[: np.searchsorted(at, len(keys) - step)]):
        at = at[keys[at] == keys[at + step]]
        apart = prints[at] ^ prints[at + step]
        bit = wiped[at]
        new = (bit < 0) | ((apart >> np.maximum(bit, 0).astype(np.uint64)) & np.uint64(1) == 1)
        near = at[new & (np.bitwise_count(apart) <= max_bits)]
        for a, b in zip(prints[near].tolist(), prints[near + step].tolist(), strict=True):
            sets.link(a, b)
        step += 1


def _wiped_of_halves(keys: np.ndarray) -> np.ndarray:
    place = (keys >> 32) & 63
    return np.where(place & 31, place, -1)


def _wiped_of_quarters(keys: np.ndarray) -> np.ndarray:
    half = keys >> 58
    place = (1 - half) * 32 + ((keys >> 16) & 31)
    return np.where((keys >> 16) & 15, place, -1)


def _meet(
    keyed: DataFrame,
    wiped: Callable[[np.ndarray], np.ndarray],
    max_bits: int,
    most: int | None,
) -> DataFrame:
    """(a, b, crowded): links, or with ``crowded`` the key and print of a crowded key's rows.

    ``keyed`` has (key, print) and maybe ``dealt``, true for keys known to be crowded: their
    rows go to many tasks, and all of them are passed on as crowded.
    """
    if "dealt" not in keyed.columns:
        keyed = keyed.withColumn("dealt", F.lit(False))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = _Sets()
        waiting: list[tuple[np.ndarray, np.ndarray]] = []  # rows of the last key so far

        def rows(a: np.ndarray, b: np.ndarray, crowded: bool) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(a), pa.array(b), pa.array(np.full(len(a), crowded))],
                ["a", "b", "crowded"],
            )

        def settle(keys: np.ndarray, prints: np.ndarray) -> Iterator[pa.RecordBatch]:
            _, start, size = np.unique(keys, return_index=True, return_counts=True)
            size = np.repeat(size, size)
            many = size > most if most else np.zeros(len(keys), bool)
            if many.any():
                yield rows(keys[many], prints[many].view(np.int64), True)
            some = (size > 1) & ~many
            _compare(keys[some], prints[some], wiped(keys[some]), max_bits, sets)

        def settled() -> Iterator[pa.RecordBatch]:
            if waiting:
                yield from settle(*(np.concatenate(column) for column in zip(*waiting, strict=True)))
                waiting.clear()

        for part in parts:
            keys = part.column("key").to_numpy()
            prints = part.column("print").to_numpy().view(np.uint64)
            dealt = part.column("dealt").to_numpy(zero_copy_only=False).astype(bool)
            if dealt.any():
                yield rows(keys[dealt], prints[dealt].view(np.int64), True)
                keys, prints = keys[~dealt], prints[~dealt]
            if not len(keys):
                continue
            last = int(np.searchsorted(keys, keys[-1]))  # the last key may go on
            if last or (waiting and waiting[0][0][0] != keys[0]):
                waiting.append((keys[:last], prints[:last]))
                yield from settled()
            waiting.append((keys[last:], prints[last:]))
        yield from settled()
        nodes = np.fromiter(sets.parent, np.uint64, len(sets.parent))
        roots = np.fromiter(map(sets.root, sets.parent), np.uint64, len(sets.parent))
        own = nodes != roots
        yield rows(nodes[own].view(np.int64), roots[own].view(np.int64), False)

    deal = F.when(F.col("dealt"), F.pmod(F.xxhash64("print"), F.lit(_DEALS))).otherwise(0)
    return (
        keyed.repartition("key", deal)
        .sortWithinPartitions("key")
        .mapInArrow(run, "a bigint, b bigint, crowded boolean")
    )


def _crowded_keys(prints: DataFrame, meet: int) -> DataFrame:
    """Keys of halves that many prints share, seen in one print of ``_SEEN``: the most crowded
    ``_KEYS`` of those with over ``meet`` prints or so.

    It only tells whose rows to deal out before they meet; keys that it misses are found
    crowded when they do.
    """
    some = prints.where(F.pmod(F.xxhash64(F.lit(7), "print"), F.lit(_SEEN)) == 0)
    counts = batches(some, _halves, "key bigint, print bigint").groupBy("key").count()
    many = counts.where(F.col("count") > max(meet / _SEEN, 1))
    return many.orderBy(F.desc("count"), "key").limit(_KEYS).select("key", F.lit(True).alias("dealt"))


def links(prints: DataFrame, max_bits: int = MAX_BITS, meet: int = MEET) -> DataFrame:
    """(a, b): links that join up all different prints within ``max_bits`` (at most 3) bits."""
    if not 0 <= max_bits <= MAX_BITS:
        raise ValueError("halves with one bit wiped out find at most three differing bits")
    # Each print becomes 64 rows, so small partitions are not merged before that.
    partitions = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    prints = prints.repartition(partitions, "print")
    pair = "key bigint, print bigint"
    keyed = batches(prints, _halves, pair)
    known = stored(_crowded_keys(prints, meet), "crowded")
    if not known.isEmpty():
        dealt = keyed.join(F.broadcast(known), "key", "left")
        keyed = dealt.withColumn("dealt", F.coalesce("dealt", F.lit(False)))
    found = stored(_meet(keyed, _wiped_of_halves, max_bits, meet), "links")
    near = found.where("not crowded").select("a", "b")
    crowded = found.where("crowded").select(F.col("a").alias("key"), F.col("b").alias("print"))
    if crowded.isEmpty():
        return near
    again = _meet(batches(crowded, _quarters, pair), _wiped_of_quarters, max_bits, None)
    return near.union(again.select("a", "b"))


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, meet: int = MEET
) -> DataFrame:
    """(doc_id, text_hash, print, root, component_id) of each document.

    ``root`` is one print of the component.
    """
    rows = stored(fingerprints(docs, shingle), "fingerprints")
    different = rows.groupBy("print").agg(F.min("doc_id").alias("first"))
    roots = components(links(different.select("print"), max_bits, meet))
    rooted = different.join(roots, different["print"] == roots["node"], "left").select(
        "print", "first", F.coalesce("root", "print").alias("root")
    )
    rooted = stored(rooted, "rooted")
    named = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    of_print = rooted.join(named, "root").select("print", "root", "component_id")
    return rows.join(of_print, "print").select(
        "doc_id", "text_hash", "print", "root", "component_id"
    )


def keep_one(
    docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, meet: int = MEET
) -> DataFrame:
    """The document with the smallest id of each component, with all its columns.

    Among rows that repeat that id, the one with the smallest fingerprint stays.
    """
    found = near_duplicates(docs, shingle, max_bits, meet)
    least = F.min(F.struct(F.isnull("doc_id"), "doc_id", "print", "text_hash"))
    first = (
        found.groupBy("root")
        .agg(least.alias("least"))
        .select(
            F.coalesce("least.doc_id", F.lit(_NO_ID)).alias("id"),
            F.col("least.text_hash").alias("hash"),
        )
    )
    doc_id, text = (F.col(f"row.{place(docs, name)}") for name in ("doc_id", "text"))
    row = as_rows(docs).select(
        "row",
        F.coalesce(doc_id.cast("bigint"), F.lit(_NO_ID)).alias("id"),
        F.xxhash64(text.cast("string")).alias("hash"),
    )
    # One row of an id and text is enough; each task drops its repeated rows before the shuffle.
    nth = F.row_number().over(Window.partitionBy("id", "hash").orderBy("id"))
    once = row.withColumn("nth", nth).where("nth = 1").drop("nth")
    return from_rows(once.join(first, ["id", "hash"], "left_semi"), docs)

