"""Mixing sources to target weights by fitting subset sums.

The sources share the words of the whole table by weight; none is asked for more than
``MAX_TIMES`` its own words. A source takes all its documents as often as its target holds
their sum, and for the rest of the budget some documents once more: documents are counted by
exact length, every length gives its share of the rest, and a bounded-knapsack dynamic
programme over the lengths that are left fits what remains. Which documents of a length are
taken is decided by a seeded hash.

Only lengths with their counts are gathered for one source, never documents: the number of
different lengths grows at most with the root of the number of words. A length that many
documents of a source share is cut into slices by hash, and only within one slice are rows
put in order.

Defined results: a null or empty text has size 0 and takes no part (0 words taken); the null
source is a source of its own and comes last; repeated rows are taken one by one, and which of
them is taken makes no difference to the result; an empty table gives an empty result. Reruns
agree: nothing depends on partitions or on order. Columns beside the ones named are ignored,
and kept by ``mix``.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tributary.llm.tables import as_rows, batches, from_rows, pick, place, stored

#: Weights given to the sources in turn.
WEIGHTS = (1.0, 2.0, 3.0)
MAX_TIMES = 3
#: Words that the dynamic programme fits at first, and at least.
FIT_WIDTH = 1 << 16
#: Widest table of the dynamic programme, and most of its cells that are looked at, about.
MOST_WIDTH, MOST_CELLS = 1 << 24, 1 << 31
#: Documents of one source and length that are put in order by one task, about.
SLICE_ROWS = 250


def targets(
    sizes: Sequence[int], weights: Sequence[float] = WEIGHTS, max_times: int = MAX_TIMES
) -> list[float]:
    """Words asked of each source: shares by weight of the sum of all, none above its limit.

    What a limit cuts off is shared anew by weight among the sources below theirs.
    """
    total = float(sum(sizes))
    share = [weights[i % len(weights)] for i in range(len(sizes))]
    limit = [max_times * float(size) for size in sizes]
    out = [0.0] * len(sizes)
    open_ = set(range(len(sizes)))
    left = total
    while open_:
        whole = sum(share[i] for i in open_)
        full = {i for i in open_ if left * share[i] / whole >= limit[i]}
        if not full:
            for i in open_:
                out[i] = left * share[i] / whole
            break
        for i in full:
            out[i] = limit[i]
        left -= sum(limit[i] for i in full)
        left = max(left, 0.0)
        open_ -= full
    return out


def fit_counts(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many of each length to take, so that the sum comes as near to ``budget`` from
    below as can be.

    Every length first gives its share, and the dynamic programme fits the rest from what is
    left. Where that misses the budget, shares are given back and fitted anew: all of them, so
    that the result is the best there is, if the table is as wide as the budget. It is for
    budgets up to ``FIT_WIDTH``, and up to ``MOST_WIDTH`` as long as lengths are few, which is
    when shares alone miss; else it is several times as wide as the longest document.
    """
    whole = int((lengths * counts).sum())
    if budget >= whole:
        return counts.copy()
    if budget <= 0:
        return np.zeros(len(lengths), np.int64)
    best = _filled(lengths, counts, _shares(lengths, counts, budget / whole), budget, FIT_WIDTH)
    missed = budget - int((best * lengths).sum())
    if missed:
        bundles = int(np.ceil(np.log2(counts[counts > 0] + 1)).sum())
        least = max(FIT_WIDTH, 4 * int(lengths.max()))
        width = min(max(least, MOST_CELLS // bundles), MOST_WIDTH, budget)
        # Smaller shares leave open what is given back; one word more for what is cut off.
        share = max(budget - width, 0) / whole
        other = _filled(lengths, counts, _shares(lengths, counts, share), budget, width)
        if budget - int((other * lengths).sum()) < missed:
            return other
    return best


def _shares(lengths: np.ndarray, counts: np.ndarray, share: float) -> np.ndarray:
    """The same share of every length, cut off to whole documents."""
    return np.minimum(np.floor(counts * share).astype(np.int64), counts)


def _filled(
    lengths: np.ndarray, counts: np.ndarray, take: np.ndarray, budget: int, width: int
) -> np.ndarray:
    """``take`` and what else fits the budget, the last ``width`` words as well as can be."""
    take = take.copy()
    rest = budget - int((take * lengths).sum())
    while rest < 0:  # rounding of a huge product
        i = int(np.flatnonzero(take)[-1])
        take[i] -= 1
        rest += int(lengths[i])
    # One more of each length, the scarcest first, until the rest can be fitted exactly.
    left = counts - take
    for i in np.lexsort((lengths, left)):
        if rest <= width:
            break
        if left[i] and lengths[i] <= rest:
            take[i] += 1
            rest -= int(lengths[i])
    while rest > width:
        fits = np.flatnonzero((take < counts) & (lengths <= rest))
        if not len(fits):
            break
        i = fits[-1]
        more = min(int(counts[i] - take[i]), -(-(rest - width) // int(lengths[i])))
        more = min(more, rest // int(lengths[i]))
        take[i] += more
        rest -= more * int(lengths[i])
    return take + _knapsack(lengths, counts - take, min(rest, width))


def _knapsack(lengths: np.ndarray, supply: np.ndarray, budget: int) -> np.ndarray:
    """Counts, within supply, of the largest sum up to ``budget``."""
    out = np.zeros(len(lengths), np.int64)
    first = np.full(budget + 1, -1, np.int64)  # the bundle that reached a sum first
    first[0] = -2
    bundles: list[tuple[int, int]] = []  # (length, how many), powers of two make every count
    usable = np.flatnonzero((supply > 0) & (lengths > 0) & (lengths <= budget))
    # No sum comes nearer than the last multiple of what divides all lengths.
    top = budget - budget % int(np.gcd.reduce(lengths[usable])) if len(usable) else 0
    for i in usable[::-1]:
        left = min(int(supply[i]), budget // int(lengths[i]))
        many = 1
        while left > 0 and first[top] == -1:
            many = min(many, left)
            size = many * int(lengths[i])
            new = np.flatnonzero((first[:-size] != -1) & (first[size:] == -1)) + size
            first[new] = len(bundles)
            bundles.append((int(i), many))
            left -= many
            many *= 2
        if first[top] != -1:
            break
    at = int(np.flatnonzero(first != -1)[-1])
    while at:
        i, many = bundles[first[at]]
        out[i] += many
        at -= many * int(lengths[i])
    return out


def sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, source, hash, size) of each document; the size is its number of words."""
    texts = pick(docs, doc_id="bigint", source="string", text="string").withColumn(
        "hash", F.xxhash64("doc_id", "text")
    )

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        words = [len((x.as_py() or "").encode().split()) for x in part.column("text")]
        return pa.RecordBatch.from_arrays(
            [part.column(name) for name in ("doc_id", "source", "hash")]
            + [pa.array(words, pa.int64())],
            ["doc_id", "source", "hash", "size"],
        )

    return batches(texts, work, "doc_id bigint, source string, hash bigint, size bigint")


def _plan_of_source(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("size", ignore_index=True)
    target, whole = float(rows["target"].iloc[0]), int(rows["source_size"].iloc[0])
    full = min(int(target // whole), MAX_TIMES) if whole else 0
    budget = min(round(target - full * whole), whole)
    extra = (
        fit_counts(rows["size"].to_numpy(), rows["n"].to_numpy(), budget)
        if whole and full < MAX_TIMES
        else np.zeros(len(rows), np.int64)
    )
    return rows.assign(full=full, extra=extra)[
        ["source", "size", "n", "source_size", "target", "full", "extra"]
    ]


def plan(counted: DataFrame, weights: Sequence[float] = WEIGHTS) -> DataFrame:
    """Per source and length: documents, target, full rounds and documents taken once more."""
    spark = counted.sparkSession
    lengths = counted.groupBy("source", "size").agg(F.count("*").alias("n"))
    totals = (
        lengths.groupBy("source")
        .agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
        .orderBy(F.col("source").asc_nulls_last())
        .collect()
    )  # one row per source
    asked = targets([row.source_size for row in totals], weights)
    table = spark.createDataFrame(
        [(row.source, row.source_size, goal) for row, goal in zip(totals, asked, strict=True)],
        "source string, source_size bigint, target double",
    ).withColumnRenamed("source", "s")
    return (
        lengths.join(table, lengths["source"].eqNullSafe(table["s"]))
        .drop("s")
        .groupBy("source")
        .applyInPandas(
            _plan_of_source,
            "source string, size bigint, n bigint, source_size bigint, target double, "
            "full bigint, extra bigint",
        )
    )


def choose(docs: DataFrame, weights: Sequence[float] = WEIGHTS, seed: int = 42) -> DataFrame:
    """Per document: its size, its source's size and target, and how often it is taken."""
    counted = stored(sizes(docs), "sizes")
    planned = stored(plan(counted, weights), "plan")
    p = planned.select(
        F.col("source").alias("p_source"), F.col("size").alias("p_size"), "n",
        "source_size", "target", "full", "extra",
    )
    slices = F.ceil(F.col("n") / SLICE_ROWS)
    rows = (
        counted.join(
            p, counted["source"].eqNullSafe(p["p_source"]) & (counted["size"] == p["p_size"])
        )
        .drop("p_source", "p_size")
        .withColumn("order", F.xxhash64(F.lit(seed), "hash"))
        .withColumn("slice", F.pmod(F.col("order"), slices))
    )
    # Lengths taken wholly or not at all need no order, nor do slices before or after the cut.
    partly = (F.col("extra") > 0) & (F.col("extra") < F.col("n"))
    before = Window.partitionBy("source", "size").orderBy("slice")
    cut = (
        rows.where(partly)
        .groupBy("source", "size", "extra", "slice")
        .agg(F.count("*").alias("rows"))
        .withColumn("until", F.sum("rows").over(before))
        .select(
            F.col("source").alias("c_source"),
            F.col("size").alias("c_size"),
            F.col("slice").alias("c_slice"),
            "rows",
            F.greatest(
                F.lit(0), F.least("rows", F.col("extra") - (F.col("until") - F.col("rows")))
            ).alias("quota"),
        )
    )
    split = rows.where(partly)
    split = split.join(
        cut,
        split["source"].eqNullSafe(cut["c_source"])
        & (split["size"] == cut["c_size"])
        & (split["slice"] == cut["c_slice"]),
    ).drop("c_source", "c_size", "c_slice")
    # Only the slice in which the share of a length ends has to be put in order.
    ends = (F.col("quota") > 0) & (F.col("quota") < F.col("rows"))
    within = Window.partitionBy("source", "size", "slice").orderBy("order", "doc_id", "hash")
    first = (F.row_number().over(within) <= F.col("quota")).cast("long")
    columns = ["doc_id", "hash", "size", "source_size", "target", "full", "more"]
    return (
        rows.where(~partly)
        .withColumn("more", (F.col("extra") > 0).cast("long"))
        .select(columns)
        .union(split.where(~ends).withColumn("more", (F.col("quota") > 0).cast("long")).select(columns))
        .union(split.where(ends).withColumn("more", first).select(columns))
        .withColumn("times", F.when(F.col("size") > 0, F.col("full") + F.col("more")).otherwise(0))
        .drop("full", "more")
    )


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, seed: int = 42) -> DataFrame:
    """The mixture: each document as many times as it is taken, with all its columns."""
    # Rows that repeat an id and text differ in nothing else that counts: their shares add up.
    taken = (
        choose(docs, weights, seed)
        .groupBy("doc_id", "hash")
        .agg(F.sum("times").alias("times"), F.count("*").alias("rows"))
        .where("times > 0")
    )
    taken = taken.select(_id("doc_id").alias("id"), "hash", "times", "rows")
    doc_id, text = (F.col(f"row.{place(docs, name)}") for name in ("doc_id", "text"))
    doc_id = doc_id.cast("bigint")
    row = as_rows(docs).select(
        "row", _id(doc_id).alias("id"), F.xxhash64(doc_id, text.cast("string")).alias("hash")
    )
    joined = row.join(taken, ["id", "hash"])
    # Of repeated rows, the first ones get what does not divide evenly.
    nth = F.row_number().over(Window.partitionBy("id", "hash").orderBy("id"))
    even = F.floor(F.col("times") / F.col("rows"))
    own = even + (F.col("nth") <= F.col("times") - even * F.col("rows")).cast("long")
    copies = joined.withColumn("nth", nth).withColumn(
        "copy", F.explode(F.array_repeat(F.lit(1), own.cast("int")))
    )
    return from_rows(copies, docs)


def _id(doc_id: Column | str) -> Column:
    """The id, or the lowest number for a null one, so that joins need no case for null."""
    return F.coalesce(doc_id, F.lit(-(2**63)))
