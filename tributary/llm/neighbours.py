"""Approximate nearest neighbours by multiprobe hashing with Gaussian (2-stable) projections.

Each table hashes a vector of length one by random projections, cut into cells of fixed
width; the cells of all projections together are a bucket. A query looks into its own bucket
and then into those where some projections move to a neighbouring cell, in the order of the
chance that a near vector fell there (the squared distances to the cell borders, added up).
Candidates of all tables are ranked by exact cosine in double precision.

Tables, projections, the width of cells and the number of probes are measured, not guessed.
The true neighbours of ``TUNING_QUERIES`` sampled vectors are found among all vectors. For each
setting of a grid, probes are added until the wanted share of them is met, and what is then
met in these buckets is counted on ``COUNTED_ROWS`` sampled vectors, repeats in other tables
included. The setting with the least work is taken. The coarsest one has cells so wide that
its probes meet all vectors once: no setting compares more than a scan would, and none is
taken that misses the wanted share.

Equal vectors are indexed once, with the few smallest ids that can matter. Buckets are matched
block by block: both sides of a bucket are cut into blocks of bounded size, and a pair of
blocks sends on only the best few of each query. Before that, every query is compared with
``BOUND_ROWS`` sampled vectors: the best of these are candidates like any other, and what is
farther than the last of them cannot be among the nearest and is never sent on. A query
whose probed buckets hold too few candidates in every table, whatever the sample gave it, is
compared with all vectors, block by block in the same way.

Defined results: vectors that are null, empty, zero or hold null or non-finite numbers take
no part, nor do rows without an id; rows that repeat an id and vector count once; vectors of
different lengths are never compared; ties go to the smaller id; an empty table gives an empty
result. Columns beside the ones named are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tributary.llm.tables import batches, pick, sampled, stored

RECALL = 0.96
TUNING_QUERIES = 80
COUNTED_ROWS = 2048
#: Vectors that every query is compared with first.
BOUND_ROWS = 1000
MOST_PROBES = 200
#: Rows of a block of a bucket.
BLOCK_ROWS = 2048
#: What a probe costs, in comparisons: a row to shuffle and a small table to rank, where a
#: comparison is one of many in a product of matrices.
PROBE_COST = 30


@dataclass(frozen=True)
class Setting:
    """Tables, projections in each, width of the cells, and buckets probed in a table."""

    tables: int
    projections: int
    width: float
    probes: int = 0


#: Settings that are tried. On the last, a unit vector's projection leaves its cell at most
#: for the next one.
GRID = (
    *(Setting(2, k, w) for w in (1.4, 2.0, 2.8) for k in (2, 4, 6, 8, 10, 12, 16, 20)),
    Setting(1, 1, 16.0),
)


def unpack(packed: Iterator[bytes]) -> np.ndarray:
    rows = list(packed)
    return np.frombuffer(b"".join(rows), "<f8").reshape(len(rows), -1) if rows else np.zeros((0, 0))


def vectors(table: DataFrame) -> DataFrame:
    """(vec_id, vec): usable rows, the vector as packed doubles; repeated rows once."""
    rows = pick(table, vec_id="bigint", embedding="array<double>")
    rows = rows.withColumnRenamed("embedding", "x")
    usable = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & usable & F.exists("x", lambda v: v != 0))

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        packed = [np.array(x.as_py(), "<f8").tobytes() for x in part.column("x")]
        return pa.RecordBatch.from_arrays(
            [part.column("vec_id"), pa.array(packed, pa.binary())], ["vec_id", "vec"]
        )

    return batches(rows, work, "vec_id bigint, vec binary")


class Hasher:
    """Projections of all tables for vectors of one length."""

    def __init__(self, size: int, setting: Setting, seed: int) -> None:
        tables, projections = setting.tables, setting.projections
        rng = np.random.default_rng([seed, size, projections])
        self.width = setting.width
        self.at = rng.standard_normal((tables, size, projections))
        self.shift = rng.uniform(0, setting.width, (tables, projections))
        self.mix = rng.integers(1, 1 << 62, (tables, projections)) * 2 + 1
        self.start = rng.integers(0, 1 << 62, tables) + size

    def cells(self, x: np.ndarray, table: int) -> np.ndarray:
        """Places in units of the cell width; their floors are the cells."""
        unit = x / np.sqrt((x * x).sum(axis=1, keepdims=True))
        return (unit @ self.at[table] + self.shift[table]) / self.width

    def keys(self, cells: np.ndarray, table: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (np.floor(cells).astype(np.int64) * self.mix[table]).sum(-1) + self.start[table]


@lru_cache(maxsize=64)
def hasher(size: int, setting: Setting, seed: int) -> Hasher:
    return Hasher(size, setting, seed)


def probes(place: np.ndarray, most: int) -> np.ndarray:
    """Moves of cells, the likeliest first, the first being none."""
    inside = place - np.floor(place)
    k = len(place)
    cost = np.concatenate([inside**2, (1 - inside) ** 2])
    order = np.argsort(cost, kind="stable")
    ranked = cost[order].tolist()
    axis, step = (order % k).tolist(), np.where(order < k, -1, 1).tolist()
    out = np.zeros((most, k), np.int64)
    made = 1
    heap = [(ranked[0], (0,))]
    while heap and made < most:
        total, chosen = heapq.heappop(heap)
        axes = [axis[i] for i in chosen]
        if len(set(axes)) == len(axes):
            out[made, axes] = [step[i] for i in chosen]
            made += 1
        last = chosen[-1] + 1
        if last < 2 * k:
            heapq.heappush(heap, (total + ranked[last], (*chosen, last)))
            heapq.heappush(heap, (total - ranked[last - 1] + ranked[last], (*chosen[:-1], last)))
    return out[:made]


def cosines(query: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Cosines of one vector with many, each summed in the same order wherever it is done."""
    dot = (rows * query).sum(axis=1)
    return dot / (np.sqrt((rows * rows).sum(axis=1)) * np.sqrt((query * query).sum()))


def _best(
    queries: np.ndarray, rows: np.ndarray, most: int, least: np.ndarray | None = None
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query, rows, cosines) of at least the ``most`` nearest rows of each query, without rows
    below the query's ``least`` cosine and without queries that have none."""
    unit = rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))
    own = queries / np.sqrt((queries * queries).sum(axis=1, keepdims=True))
    for at in range(0, len(queries), 512):
        rough = own[at : at + 512] @ unit.T
        bound = np.full(len(rough), -2.0)
        if len(rows) > most:
            bound = np.partition(rough, -most, axis=1)[:, -most]
        if least is not None:
            bound = np.maximum(bound, least[at : at + 512])
        # What is near by the product is looked at exactly; rounding is far below the margin.
        ask, near = np.nonzero(rough >= bound[:, None] - 1e-9)
        starts = np.searchsorted(ask, np.arange(len(rough) + 1))
        for i in np.flatnonzero(np.diff(starts)):
            chosen = near[starts[i] : starts[i + 1]]
            scores = cosines(queries[at + i], rows[chosen])
            if least is not None:
                enough = scores >= least[at + i]
                chosen, scores = chosen[enough], scores[enough]
            if len(chosen):
                yield at + i, chosen, scores


def _with_keys(rows: DataFrame, setting: Setting, seed: int) -> DataFrame:
    """Adds the table and the bucket; every row once for each table."""
    tables = setting.tables

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        packed = part.column("vec").to_pylist()
        out = np.zeros((tables, len(packed)), np.int64)
        sizes = np.array([len(p) for p in packed])
        for size in np.unique(sizes):
            at = np.flatnonzero(sizes == size)
            x = unpack(packed[i] for i in at)
            own = hasher(int(size) // 8, setting, seed)
            for t in range(tables):
                out[t, at] = own.keys(own.cells(x, t), t)
        repeated = part.take(pa.array(np.tile(np.arange(len(packed)), tables)))
        return pa.RecordBatch.from_arrays(
            [
                *repeated.columns,
                pa.array(np.repeat(np.arange(tables, dtype=np.int32), len(packed))),
                pa.array(out.ravel()),
            ],
            [*part.schema.names, "tab", "bucket"],
        )

    return batches(rows, work, _schema(rows, "tab int, bucket bigint"))


def _with_probes(rows: DataFrame, setting: Setting, seed: int) -> DataFrame:
    """Adds table and bucket; every row once for each bucket that it looks into."""

    def work(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        index, tab, bucket = [], [], []
        for i, packed in enumerate(part.column("vec").to_pylist()):
            x = unpack([packed])
            own = hasher(x.shape[1], setting, seed)
            for t in range(setting.tables):
                place = own.cells(x, t)[0]
                moved = np.unique(own.keys(np.floor(place) + probes(place, setting.probes), t))
                index += [i] * len(moved)
                tab += [t] * len(moved)
                bucket += moved.tolist()
        return pa.RecordBatch.from_arrays(
            [*part.take(pa.array(index, pa.int64())).columns, pa.array(tab, pa.int32()),
             pa.array(bucket, pa.int64())],
            [*part.schema.names, "tab", "bucket"],
        )

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:  # a few queries at a time: each becomes many rows
            for at in range(0, part.num_rows, 50):
                yield work(part.slice(at, 50))

    return rows.mapInArrow(run, _schema(rows, "tab int, bucket bigint"))


def _schema(rows: DataFrame, more: str) -> str:
    own = ", ".join(f"{name} {kind}" for name, kind in rows.dtypes)
    return f"{own}, {more}"


_KEY = ["tab", "bucket"]


def _cells(indexed: DataFrame, asking: DataFrame) -> DataFrame:
    """(tab, bucket, held, row_blocks, ask_blocks): buckets that are asked, the ids that they
    hold, and the blocks of both sides."""
    blocks = lambda n: F.ceil(F.col(n) / BLOCK_ROWS).cast("int")
    held = F.sum(F.size("ids")).alias("held")
    rows = indexed.groupBy(*_KEY).agg(F.count("*").alias("rows"), held)
    asked = asking.groupBy(*_KEY).agg(F.count("*").alias("asked"))
    return stored(
        rows.join(asked, _KEY).select(
            *_KEY, "held", blocks("rows").alias("row_blocks"), blocks("asked").alias("ask_blocks")
        ),
        "cells",
    )


def _match(indexed: DataFrame, asking: DataFrame, cells: DataFrame, most: int) -> DataFrame:
    """(qid, qhash, vec_id, score): per pair of blocks the best ids of each query.

    ``indexed`` has (tab, bucket, vec, ids), ``asking`` has (tab, bucket, vec, qid, qhash,
    least), ``cells`` is of both; scores below ``least`` are left out.
    """
    cells = cells.drop("held")

    def dealt(df: DataFrame, own: str, other: str) -> DataFrame:
        """Each row in one block of its side, once for every block of the other side."""
        return (
            df.join(cells, _KEY)
            .withColumn(own, F.pmod(F.xxhash64("vec"), F.col(f"{own}s")).cast("int"))
            .withColumn(other, F.explode(F.sequence(F.lit(0), F.col(f"{other}s") - 1)))
            .drop("row_blocks", "ask_blocks")
        )

    by = [*_KEY, "row_block", "ask_block"]
    kind = "qid bigint, qhash bigint, vec_id bigint, score double"

    def match(ask: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        found: dict[str, list] = {"qid": [], "qhash": [], "vec_id": [], "score": []}
        if len(ask) and len(own):
            ids = own["ids"].tolist()
            qids, hashes = ask["qid"].tolist(), ask["qhash"].tolist()
            least = ask["least"].to_numpy()
            for i, near, scores in _best(unpack(ask["vec"]), unpack(own["vec"]), most, least):
                rows = [
                    (-score, vec_id)
                    for n, score in zip(near.tolist(), scores.tolist(), strict=True)
                    for vec_id in ids[n]
                ]
                best = heapq.nsmallest(most, rows)
                found["qid"] += [qids[i]] * len(best)
                found["qhash"] += [hashes[i]] * len(best)
                found["vec_id"] += [vec_id for _, vec_id in best]
                found["score"] += [-score for score, _ in best]
        return pd.DataFrame(found)

    return (
        dealt(asking, "ask_block", "row_block")
        .groupBy(*by)
        .cogroup(dealt(indexed, "row_block", "ask_block").groupBy(*by))
        .applyInPandas(match, kind)
    )


def _with_sample(asking: DataFrame, sample: list[tuple[bytes, list[int]]], most: int) -> DataFrame:
    """Adds ``best``, the nearest rows of the sample, and ``least``, the score of the last of
    them if there are enough."""
    known = {
        size: (
            unpack(vec for vec, _ in sample if len(vec) == size),
            [ids for vec, ids in sample if len(vec) == size],
        )
        for size in {len(vec) for vec, _ in sample}
    }

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        found, least = [], []
        for packed in part.column("vec").to_pylist():
            x, ids = known.get(len(packed), (np.zeros((0, len(packed) // 8)), []))
            scores = cosines(unpack([packed])[0], x).tolist()
            rows = [(-s, i) for s, own in zip(scores, ids, strict=True) for i in own]
            best = heapq.nsmallest(most, rows)
            least.append(-best[-1][0] if len(best) == most else -2.0)
            found.append([{"vec_id": i, "score": -s} for s, i in best])
        kind = pa.list_(pa.struct([("vec_id", pa.int64()), ("score", pa.float64())]))
        return pa.RecordBatch.from_arrays(
            [*part.columns, pa.array(least, pa.float64()), pa.array(found, kind)],
            [*part.schema.names, "least", "best"],
        )

    more = "least double, best array<struct<vec_id: bigint, score: double>>"
    return batches(asking, work, _schema(asking, more))


def _top(found: DataFrame, by: list[str], most: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def _truth(different: DataFrame, sample: list[bytes], most: int) -> list[tuple[int, bytes]]:
    """The true nearest other vectors of a few sampled ones, among all vectors."""

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        packed = part.column("vec").to_pylist()
        out: list[tuple[int, bytes, float]] = []
        sizes = np.array([len(p) for p in packed])
        for size in np.unique(sizes):
            at = np.flatnonzero(sizes == size)
            asked = [i for i, p in enumerate(sample) if len(p) == size]
            if not asked:
                continue
            x = unpack(packed[i] for i in at)
            for i, near, scores in _best(unpack(sample[j] for j in asked), x, most + 1):
                out += (
                    (asked[i], packed[at[n]], score)
                    for n, score in zip(near, scores.tolist(), strict=True)
                    if packed[at[n]] != sample[asked[i]]
                )
        return pa.RecordBatch.from_arrays(
            [
                pa.array([a for a, _, _ in out], pa.int64()),
                pa.array([b for _, b, _ in out], pa.binary()),
                pa.array([c for _, _, c in out], pa.float64()),
            ],
            ["asked", "vec", "score"],
        )

    found = batches(different.select("vec"), work, "asked bigint, vec binary, score double")
    order = Window.partitionBy("asked").orderBy(F.desc("score"), "vec")
    near = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)
    return [(row.asked, bytes(row.vec)) for row in near.select("asked", "vec").collect()]


def _measured(
    setting: Setting,
    queries: list[bytes],
    truth: list[tuple[int, bytes]],
    rows: list[bytes],
    recall: float,
    seed: int,
) -> tuple[int, float] | None:
    """Probes until the wanted share of true neighbours is met, and the share of all rows that
    a query meets then; None if ``MOST_PROBES`` do not suffice."""
    near: list[list[bytes]] = [[] for _ in queries]
    for asked, vec in truth:
        near[asked].append(vec)
    need, met = [], np.zeros(MOST_PROBES)
    for n, query in enumerate(queries):
        alike = [vec for vec in rows if len(vec) == len(query)]
        x = unpack([query, *near[n], *alike])
        own = hasher(x.shape[1], setting, seed)
        first = np.full(len(near[n]), MOST_PROBES)
        for t in range(setting.tables):
            place = own.cells(x, t)
            keys = own.keys(np.floor(place[0]) + probes(place[0], MOST_PROBES), t)
            order = np.argsort(keys, kind="stable")
            wanted = own.keys(place[1:], t)
            at = order[np.minimum(np.searchsorted(keys, wanted, sorter=order), len(keys) - 1)]
            rank = np.where(keys[at] == wanted, at, MOST_PROBES)
            first = np.minimum(first, rank[: len(first)])
            met += np.bincount(rank[len(first) :], minlength=MOST_PROBES + 1)[:MOST_PROBES]
        need += first.tolist()
        if n == 15 and np.mean(np.array(need) == MOST_PROBES) > 3 * (1 - recall):
            return None  # far from it
    last = int(np.quantile(need, recall, method="higher")) if need else 0
    if last == MOST_PROBES:
        return None
    return last + 1, float(met[: last + 1].sum()) / max(len(rows) * len(queries), 1)


def tune(different: DataFrame, most: int, recall: float, seed: int) -> Setting:
    """The setting of ``GRID`` with the least work that meets the wanted share of true
    neighbours of a sample."""
    n = different.count()
    vecs = different.select("vec")
    chosen = sampled(vecs, F.xxhash64(F.lit(seed), "vec"), TUNING_QUERIES).collect()
    queries = [bytes(row.vec) for row in chosen]
    truth = _truth(different, queries, most)
    counted = sampled(vecs, F.xxhash64(F.lit(seed + 2), "vec"), COUNTED_ROWS).collect()
    rows = [bytes(row.vec) for row in counted]
    best = (float("inf"), replace(GRID[-1], probes=3))
    for setting in GRID:
        found = _measured(setting, queries, truth, rows, recall, seed)
        if found:
            probed, share = found
            work = share * n + setting.tables * PROBE_COST * probed
            best = min(best, (work, replace(setting, probes=probed)), key=lambda x: x[0])
    return best[1]


def nearest(
    table: DataFrame,
    is_query: Column,
    neighbours: int = 5,
    recall: float = RECALL,
    seed: int = 42,
) -> DataFrame:
    """(query_id, rank, vec_id, score) of the nearest rows found for each query row.

    ``is_query`` is a condition on ``vec_id``.
    """
    most = neighbours + 1  # a query meets itself
    rows = stored(vectors(table), "vectors")
    # Of equal vectors only so many smallest ids can ever be among the nearest.
    few = Window.partitionBy("vec").orderBy("vec_id")
    different = (
        rows.withColumn("place", F.dense_rank().over(few))
        .where(F.col("place") <= most)
        .groupBy("vec")
        .agg(F.array_sort(F.collect_set("vec_id")).alias("ids"))
    )
    different = stored(different, "different")
    setting = tune(different, neighbours, recall, seed)
    queries = rows.where(is_query).distinct()
    asking = (
        queries.groupBy("vec")
        .agg(F.min("vec_id").alias("qid"))
        .withColumn("qhash", F.xxhash64("vec"))
    )
    chosen = sampled(different, F.xxhash64(F.lit(seed + 1), "vec"), BOUND_ROWS)
    sample = [(bytes(row.vec), row.ids) for row in chosen.select("vec", "ids").collect()]
    asking = stored(_with_sample(asking, sample, most), "asking")
    at_once = asking.select("qid", "qhash", F.inline("best"))
    asking = asking.drop("best")
    query = ["qid", "qhash"]
    indexed = _with_keys(different, setting, seed)
    probing = _with_probes(asking, setting, seed)
    cells = _cells(indexed, probing)

    def nearest_met(rows: DataFrame) -> DataFrame:
        once = rows.groupBy(*query, "vec_id").agg(F.max("score").alias("score"))
        return _top(once, query, most).drop("rank")

    near = stored(nearest_met(_match(indexed, probing, cells, most)), "near")
    # Of queries that have nothing to show for it, since scores below ``least`` were left out,
    # those whose buckets hold too few ids in every table look at everything of their length.
    counts = near.groupBy(*query).agg(F.count("*").alias("n"))
    few_near = asking.join(counts, query, "left").where(F.coalesce("n", F.lit(0)) < most).drop("n")
    enough = (
        _with_probes(few_near.select("vec", *query), setting, seed)
        .select(*query, *_KEY)
        .join(cells, _KEY)
        .groupBy(*query, "tab")
        .agg(F.sum("held").alias("held"))
        .where(F.col("held") >= most)
    )
    short = stored(few_near.join(enough, query, "left_anti"), "short")
    everything = lambda df: df.withColumn("tab", F.lit(-1)).withColumn(
        "bucket", F.octet_length("vec").cast("bigint")
    )
    every, asked = everything(different), everything(short)
    whole = _match(every, asked, _cells(every, asked), most)
    met = nearest_met(near.unionByName(at_once))
    met = met.join(short.select(*query), query, "left_anti").unionByName(whole)
    best = _top(met, ["qid", "qhash"], most).drop("rank")
    answers = (
        queries.withColumnRenamed("vec_id", "query_id")
        .join(asking, "vec")
        .select("query_id", "qid", "qhash")
        .join(best, ["qid", "qhash"])
        .where("vec_id != query_id")
    )
    return _top(answers, ["query_id", "qhash"], neighbours).select(
        "query_id", "rank", "vec_id", "score"
    )
