"""Packing documents into sequences of fixed length by the sum-of-squares rule.

A document becomes its token ids and an end token; only documents longer than a sequence are
cut. Pieces are dealt into groups of bounded size at random. Within a group, longest first,
each piece goes into the open sequence, or a new one, after which the sum over all gaps of
the squared number of open sequences with that gap is smallest. Sequences of all groups that
stay too empty are opened again and their pieces are packed once more together.

Pieces are written out once; groups are formed from a number that is stored with each piece,
so neither a hot id nor a lost executor changes a group.

Defined results: a null or empty text is the end token alone; repeated rows are packed one by
one; an empty table gives an empty result. Columns beside the ones named are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count
from zlib import crc32

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.tables import pick, stored
from tributary.llm.words import words

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
LENGTH = 4096
END = 1
#: Pieces that one group holds on average.
GROUP_PIECES = 20_000
#: Sequences filled less than this are packed a second time.
REOPEN = 0.98


def pieces(
    docs: DataFrame, tokenizer: str = TOKENIZER, length: int = LENGTH, end: int = END
) -> DataFrame:
    """(doc_id, key, piece, start, length, ids_crc32, ids): the cut documents.

    ``key`` is the row's own number; ``ids`` are little-endian unsigned 32-bit integers.
    """
    tail = np.array([end], "<u4").tobytes()

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = count(TaskContext.get().partitionId() << 33)
        of = words(tokenizer)
        for part in parts:
            every = of.ids_of_texts(part.column("text"))
            for at in range(0, part.num_rows, 500):
                rows: list[tuple] = []
                for doc_id in part.column("doc_id").slice(at, 500).to_pylist():
                    ids = next(every) + tail
                    for i in range(0, len(ids), 4 * length):
                        own = ids[i : i + 4 * length]
                        rows.append(
                            (doc_id, next(key), i // (4 * length), i // 4, len(own) // 4,
                             crc32(own), own)
                        )
                types = [pa.int64()] * 6 + [pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)],
                    ["doc_id", "key", "piece", "start", "length", "ids_crc32", "ids"],
                )

    return pick(docs, doc_id="bigint", text="string").mapInArrow(
        run,
        "doc_id bigint, key bigint, piece bigint, start bigint, length bigint, "
        "ids_crc32 bigint, ids binary",
    )


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each item, placed in the order given."""
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    open_ = np.zeros(capacity + 1, np.int64)  # bins with each gap; full and empty ones don't count
    with_gap: list[list[int]] = [[] for _ in range(capacity + 1)]
    made = 0
    for i, size in enumerate(lengths.tolist()):
        there = open_[size:capacity]
        change = 2 * (open_[: capacity - size] - there) + 2  # in the sum, by gap before
        if len(change):
            change[0] = 1 - 2 * there[0]
            change[there == 0] = np.iinfo(np.int64).max
            best = int(change.argmin())
        if len(change) and change[best] <= 2 * open_[capacity - size] + 1:
            gap = size + best
            own = with_gap[gap].pop()
            open_[gap] -= 1
        else:
            gap, own = capacity, made
            made += 1
        bins[i], offsets[i] = own, capacity - gap
        gap -= size
        if gap:
            open_[gap] += 1
            with_gap[gap].append(own)
    return bins, offsets


def _packed(rows: DataFrame, groups: int, first: int, capacity: int) -> DataFrame:
    """(key, length, sequence_id, offset, filled); groups are numbered from ``first``."""

    def pack(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "key"], ascending=[False, True], ignore_index=True)
        bins, offsets = sum_of_squares(group["length"].to_numpy(), capacity)
        filled = np.bincount(bins, group["length"]).astype(np.int64)
        return pd.DataFrame(
            {
                "key": group["key"],
                "length": group["length"],
                "sequence_id": (int(key[0]) << 32) + bins,
                "offset": offsets,
                "filled": filled[bins],
            }
        )

    group = F.lit(first) + F.pmod(F.xxhash64(F.lit(first), "key"), F.lit(groups))
    return (
        rows.select(group.alias("group"), "key", "length")
        .groupBy("group")
        .applyInPandas(
            pack, "key bigint, length bigint, sequence_id bigint, offset bigint, filled bigint"
        )
    )


def place(
    cut: DataFrame, capacity: int = LENGTH, group_pieces: int = GROUP_PIECES
) -> DataFrame:
    """(key, sequence_id, offset) of each piece of a stored table (key, length)."""
    partial = cut.where(F.col("length") < capacity)
    groups = max(1, -(-partial.count() // group_pieces))
    once = stored(_packed(partial, groups, 0, capacity), "packed")
    poor = once.where(F.col("filled") < REOPEN * capacity)
    again = max(1, -(-poor.count() // group_pieces))
    twice = _packed(poor, again, groups, capacity)
    columns = ["key", "sequence_id", "offset"]
    full = cut.where(F.col("length") >= capacity).select(
        "key", (-1 - F.col("key")).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset")
    )
    good = once.where(F.col("filled") >= REOPEN * capacity)
    return good.select(columns).union(twice.select(columns)).union(full)


def pack(
    docs: DataFrame,
    tokenizer: str = TOKENIZER,
    length: int = LENGTH,
    end: int = END,
    with_ids: bool = True,
    group_pieces: int = GROUP_PIECES,
) -> DataFrame:
    """Each piece with its sequence and its place there, and with its ids if asked for."""
    cut = pieces(docs, tokenizer, length, end)
    cut = stored(cut if with_ids else cut.drop("ids"), "pieces")
    placed = place(cut.select("key", "length"), length, group_pieces)
    return cut.join(placed, "key").drop("key")
