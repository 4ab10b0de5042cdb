"""How filters act on one another, for every order in which they could run.

A document is known by its mask, the set of filters that it fails. In each of the k! orders
of k filters each of the k steps keeps it, removes it, or would remove it had no earlier
step done so. All these outcomes are the fields of one big integer a mask, wide enough for
any count of rows, so that counting all outcomes of many documents is one addition each:
integers are summed for each part of the corpus and only the sums are taken apart.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import permutations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tributary.llm.tables import pick

#: Bits of a field. Counts are longs, so no sum of rows ever runs over into the next field.
WIDTH = 64
#: Slices in which the sums of tasks meet first, and parts that a task holds at a time.
SLICES, PARTS = 64, 256
OUTCOMES = ("kept", "removed", "redundant")
SUMS = ("all_sum", "good_sum", "toxic_sum")

_SPACE = r"\x20\x09-\x0D"


def rules(text: Column) -> dict[str, Column]:
    """The five filters, each with the condition under which a text fails it."""
    words = F.regexp_extract_all(text, F.lit(f"[^{_SPACE}]+"), 0)
    return {
        "A": F.size(words) < 200,
        "B": 100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
        "C": 100 * F.regexp_count(text, F.lit("[A-Z]")) > 3 * F.length(text),
        "D": text.rlike("[#$%&*|]"),
    }


def orders(filters: str) -> list[str]:
    return ["".join(order) for order in permutations(filters)]


@lru_cache(maxsize=4)
def packed(filters: str) -> list[int]:
    """The integer of each mask; bit i of a mask stands for the i-th filter.

    Three fields (kept, removed, redundant) for each step of each order, then one for each
    filter that tells whether the mask is that filter alone.
    """
    out = []
    for mask in range(1 << len(filters)):
        fields = []
        for order in orders(filters):
            gone = False
            for name in order:
                fails = bool(mask >> filters.index(name) & 1)
                fields += [not gone and not fails, fails and not gone, fails and gone]
                gone = gone or fails
        fields += [mask == 1 << i for i in range(len(filters))]
        out.append(sum(1 << WIDTH * i for i, on in enumerate(fields) if on))
    return out


def unpacked(number: int, fields: int) -> list[int]:
    size = WIDTH // 8
    data = number.to_bytes(fields * size, "little")
    return [int.from_bytes(data[i : i + size], "little") for i in range(0, len(data), size)]


def masks(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, n_good, n_toxic): counts of documents that are alike in all of it.

    One row for each text, part and kind of label. Filter E fails a document whose text
    stands under a smaller doc_id too; texts meet as digests, after equal ones have been
    counted where they lie, so a text that a third of all rows share is a few rows.
    """
    rows = pick(docs, doc_id="bigint", text="string", lang="string").select(
        "doc_id", F.coalesce("lang", F.lit("")).alias("part"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    mask = sum(
        (F.when(fails, 1 << i).otherwise(0) for i, fails in enumerate(rules(F.col("text")).values())),
        F.lit(0),
    )
    keys = ["doc_id", "part", "mask", "digest"]
    rows = rows.select(
        "doc_id", "part", mask.alias("mask"), F.unhex(F.sha2("text", 256)).alias("digest")
    )
    rows = rows.groupBy(*keys).agg(F.count("*").alias("n"))
    # Rows without an id have no label; they are dealt by their texts.
    spread = F.when(F.col("doc_id").isNull(), F.xxhash64("digest")).otherwise(0)
    marks = (
        pick(labels, doc_id="bigint", quality="int", toxic="int")
        .groupBy("doc_id")
        .agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("bad"))
        .select(F.col("doc_id").alias("label_id"), F.lit(0).cast("bigint").alias("label_spread"),
                "good", "bad")
    )
    rows = rows.withColumn("spread", spread).join(
        marks,
        (F.col("doc_id") == F.col("label_id")) & (F.col("spread") == F.col("label_spread")),
        "left",
    )
    rows = rows.withColumns(
        {name: F.coalesce(name, F.lit(False)) for name in ("good", "bad")}
    )
    alike = rows.groupBy("digest", "part", "mask", "good", "bad").agg(
        F.sum("n").alias("n"),
        F.min("doc_id").alias("least"),
        F.min_by("n", "doc_id").alias("n_least"),
        F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("n_without"),
    )
    first = F.min("least").over(Window.partitionBy("digest"))
    clear = F.col("n_without") + F.when(F.col("least") == first, F.col("n_least")).otherwise(0)
    alike = alike.withColumn("clear", clear)
    one = F.struct(F.col("mask").alias("mask"), F.col("clear").alias("n"))
    again = F.struct(
        F.col("mask").bitwiseOR(F.lit(16)).alias("mask"), (F.col("n") - F.col("clear")).alias("n")
    )
    return alike.select("part", "good", "bad", F.inline(F.array(one, again))).select(
        "part", "mask", "n",
        F.when(F.col("good"), F.col("n")).otherwise(0).alias("n_good"),
        F.when(F.col("bad"), F.col("n")).otherwise(0).alias("n_toxic"),
    )


def _row(key: tuple, sums: list[int]) -> tuple:
    return (*key, *(n.to_bytes((n.bit_length() + 7) // 8, "little") for n in sums))


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = [pa.array(list(c), f.type) for c, f in zip(zip(*rows), schema, strict=True)]
    return pa.RecordBatch.from_arrays(columns, schema=schema)


def _summing(filters: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Sums the integers of the rows of a task for each part, some parts at a time."""
    schema = pa.schema([("part", pa.string()), *((name, pa.binary()) for name in SUMS)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = packed(filters)
        held: dict[str, list[int]] = {}
        for batch in batches:
            counts = batch.to_pandas().groupby(["part", "mask"], sort=False).sum()
            for (part, mask), row in zip(counts.index, counts.to_numpy(), strict=True):
                sums = held.setdefault(part, [0, 0, 0])
                for i, n in enumerate(row.tolist()):
                    sums[i] += n * numbers[mask]
                if len(held) > PARTS:
                    yield _batch([_row((p,), s) for p, s in held.items()], schema)
                    held.clear()
        if held:
            yield _batch([_row((p,), s) for p, s in held.items()], schema)

    return run


def _folded(df: DataFrame, keys: list[str]) -> DataFrame:
    """Sums of integers for equal keys; rows go by one after another, in order of the keys."""
    plain = df.select(*keys, *SUMS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, sums = None, [0, 0, 0]
        for batch in batches:
            done = []
            for *key, a, b, c in zip(*(column.to_pylist() for column in batch.columns)):
                if key != last:
                    if last is not None:
                        done.append(_row(tuple(last), sums))
                    last, sums = key, [0, 0, 0]
                sums = [n + int.from_bytes(x, "little") for n, x in zip(sums, (a, b, c))]
            if done:
                yield _batch(done, batch.schema)
        if last is not None:
            yield _batch([_row(tuple(last), sums)], batch.schema)

    ordered = plain.repartition(*keys).sortWithinPartitions(*keys)
    return ordered.mapInArrow(run, plain.schema)


def interactions(counts: DataFrame, filters: str = "ABCDE") -> DataFrame:
    """Outcomes of every step of every order, for each part.

    ``counts`` has part (string), mask (int), n, n_good and n_toxic (long). Returns part,
    filter_order, step and the counts kept, removed, redundant, unique_fails, good_lost,
    toxic_lost, shapley; a table without rows gives none.
    """
    sums = counts.select("part", "mask", "n", "n_good", "n_toxic").mapInArrow(
        _summing(filters), "part string, " + ", ".join(f"{name} binary" for name in SUMS)
    )
    sliced = sums.withColumn("slice", F.spark_partition_id() % SLICES)
    totals = _folded(_folded(sliced, ["part", "slice"]), ["part"])
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    schema = "part string, filter_order string, step int, " + ", ".join(f"{n} long" for n in names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every = orders(filters)
        k = len(filters)
        steps = len(every) * k
        for batch in batches:
            for part, *parts in zip(*(column.to_pylist() for column in batch.columns)):
                rows = []
                everyone, good, toxic = (
                    unpacked(int.from_bytes(x, "little"), 3 * steps + k) for x in parts
                )
                removed = everyone[1 : 3 * steps : 3]
                shapley = dict.fromkeys(filters, 0)
                for i, n in enumerate(removed):
                    shapley[every[i // k][i % k]] += n
                for i in range(steps):
                    name = every[i // k][i % k]
                    alone = everyone[3 * steps + filters.index(name)]
                    rows.append(
                        (part, every[i // k], i % k + 1, *everyone[3 * i : 3 * i + 3], alone,
                         good[3 * i + 1], toxic[3 * i + 1], shapley[name])
                    )
                types = [pa.string(), pa.string(), pa.int32(), *[pa.int64()] * len(names)]
                fields = ["part", "filter_order", "step", *names]
                yield _batch(rows, pa.schema(list(zip(fields, types, strict=True))))

    return totals.mapInArrow(run, schema)


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The interactions of five filters over all documents, one part for each language.

    Needs doc_id, text and lang of ``docs``, and doc_id, quality and toxic of ``labels``. A
    null text is empty, a null lang the empty text. Filter E (the text of a smaller doc_id)
    never fails rows without an id, nor do these make others fail; rows that repeat an id
    and a text count each, and fail E together or not at all. A document is good or toxic
    if any row of its labels says 1. Empty tables give no rows; other columns are ignored.
    """
    return interactions(masks(docs, labels))
