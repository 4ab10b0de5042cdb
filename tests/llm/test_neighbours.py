import numpy as np
import pytest
from pyspark.sql import functions as F

from tributary.llm import neighbours

SCHEMA = "vec_id long, embedding array<float>, label int"


def rows_of(x):
    return [(i, [float(v) for v in row], 0) for i, row in enumerate(x)]


def plain(rows, every, most=5):
    """{query: [(vec_id, score)]} by comparing every pair."""
    usable = {}
    for vec_id, vec, *_ in rows:
        if vec_id is not None and vec and None not in vec and np.isfinite(vec).all() and any(vec):
            usable.setdefault((vec_id, tuple(np.float32(vec).astype(float))), None)
    out = {}
    for vec_id, vec in usable:
        if vec_id % every:
            continue
        q = np.array(vec)
        scored = []
        for other, own in usable:
            if (other, own) != (vec_id, vec) and len(own) == len(vec):
                x = np.array(own)
                scored.append((-(x @ q) / np.sqrt((x @ x) * (q @ q)), other))
        out[vec_id] = [(i, -s) for s, i in sorted(scored)[:most]]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        own = out.setdefault(r.query_id, [])
        own.append((r.vec_id, r.score))
        assert r.rank == len(own)
    return out


def test_recall_on_vectors_without_structure(spark):
    x = np.random.default_rng(1).normal(size=(1500, 24)).astype("f")
    rows = rows_of(x)
    got = found(neighbours.nearest(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 50 == 0))
    wanted = plain(rows, 50)
    assert got.keys() == wanted.keys()
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in wanted[q]}) for q in wanted)
    assert hits / (5 * len(wanted)) >= 0.9
    unit = x / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    for q, near in got.items():
        assert len(near) == 5
        assert all(score == pytest.approx(unit[q] @ unit[i], abs=1e-12) for i, score in near)


def test_near_copies_are_found(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(150, 16))
    x = (centres[:, None] + rng.normal(size=(150, 6, 16)) * 0.02).reshape(-1, 16)
    got = found(neighbours.nearest(spark.createDataFrame(rows_of(x), SCHEMA), F.col("vec_id") % 6 == 0))
    right = sum(i // 6 == q // 6 for q, near in got.items() for i, _ in near)
    assert right >= 0.97 * 5 * 150


def test_a_third_of_all_rows_is_one_vector(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 16)
    x = np.random.default_rng(3).normal(size=(300, 8)).astype("f")
    x[::3] = x[0]
    rows = rows_of(x)
    table = spark.createDataFrame(rows, SCHEMA).withColumn("score", F.lit(1)).withColumn("tab", F.lit(1))
    got, wanted = found(neighbours.nearest(table, F.col("vec_id") % 10 == 0)), plain(rows, 10)
    assert got.keys() == wanted.keys()
    for q in wanted:
        if q % 3 == 0:  # copies: the smallest other ids, at a cosine of one
            assert [i for i, _ in got[q]] == [i for i in (0, 3, 6, 9, 12, 15) if i != q][:5]
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in wanted[q]}) for q in wanted)
    assert hits / (5 * len(wanted)) >= 0.9


def test_isolated_queries_beside_a_dense_cluster(spark, monkeypatch):
    """Nobody is near them, so their buckets are empty; they are compared with all vectors."""
    monkeypatch.setattr(neighbours, "BOUND_ROWS", 20)
    monkeypatch.setattr(neighbours, "tune", lambda *_: neighbours.Setting(4, 12, 1.4, 1))
    rng = np.random.default_rng(5)
    x = rng.normal(size=(1200, 16)) * 0.02 + np.eye(16)[0]
    x[::100] = rng.normal(size=(12, 16))
    rows = rows_of(x.astype("f"))
    got = found(neighbours.nearest(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 100 == 0))
    assert {q: [i for i, _ in near] for q, near in got.items()} == {
        q: [i for i, _ in near] for q, near in plain(rows, 100).items()
    }


def test_odd_rows_take_no_part(spark):
    good = rows_of(np.eye(4) + 0.1)
    rows = [
        *good, good[0], (0, [float("nan"), 1.0, 1.0, 1.0], 0), (50, None, 0), (100, [], 0),
        (150, [0.0] * 4, 0), (200, [1.0, None, 1.0, 1.0], 0), (250, [float("inf"), 1.0, 1.0, 1.0], 0),
        (None, [1.0, 1.0, 1.0, 1.0], 0), (300, [1.0, 2.0], 0), (350, [2.0, 4.0], None),
    ]
    got = found(neighbours.nearest(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 50 == 0))
    wanted = plain(rows, 50)
    assert {q: [i for i, _ in near] for q, near in got.items()} == {
        q: [i for i, _ in near] for q, near in wanted.items()
    }
    assert got[300] == [(350, pytest.approx(1.0))]
    empty = spark.createDataFrame([], SCHEMA)
    assert neighbours.nearest(empty, F.col("vec_id") % 50 == 0).count() == 0


def test_probes_come_by_rising_cost():
    rng = np.random.default_rng(4)
    place = rng.normal(size=5) * 3
    inside = place - np.floor(place)
    moves = neighbours.probes(place, 60)
    cost = (np.where(moves < 0, inside**2, 0) + np.where(moves > 0, (1 - inside) ** 2, 0)).sum(1)
    assert (np.diff(cost) >= -1e-12).all() and not moves[0].any()
    assert len({tuple(m) for m in moves.tolist()}) == 60
    grid = np.array(np.meshgrid(*[[-1, 0, 1]] * 5)).reshape(5, -1).T
    every = (np.where(grid < 0, inside**2, 0) + np.where(grid > 0, (1 - inside) ** 2, 0)).sum(1)
    assert np.allclose(np.sort(every)[:60], cost)


def work_of(x, setting, seed=42):
    """Mean of the rows that a query meets in its buckets, and of the neighbours among them."""
    met = hits = 0
    queries = range(0, len(x), 50)
    own = neighbours.Hasher(x.shape[1], setting, seed)
    cells = [own.cells(x, t) for t in range(setting.tables)]
    keys = [own.keys(c, t) for t, c in enumerate(cells)]
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    for q in queries:
        seen = np.zeros(len(x), bool)
        for t in range(setting.tables):
            probed = own.keys(np.floor(cells[t][q]) + neighbours.probes(cells[t][q], setting.probes), t)
            here = np.isin(keys[t], probed)
            met += here.sum()
            seen |= here
        near = unit @ unit[q]
        near[q] = -2
        hits += seen[np.argsort(-near)[:5]].sum()
    return met / len(queries), hits / (5 * len(queries))


@pytest.mark.parametrize("kind", ["random", "clusters", "one cluster"])
def test_the_setting_meets_less_than_a_scan(spark, kind):
    """Work and recall of the chosen setting, on vectors it was not measured on."""
    rng = np.random.default_rng(6)
    if kind == "random":
        x = rng.normal(size=(2500, 64))
    elif kind == "clusters":
        x = rng.normal(size=(80, 64))[rng.integers(0, 80, 2500)] + 0.3 * rng.normal(size=(2500, 64))
    else:
        x = np.concatenate([rng.normal(size=(1600, 64)), np.eye(64)[0] + 0.02 * rng.normal(size=(900, 64))])
    table = spark.createDataFrame(rows_of(x), SCHEMA)
    packed = neighbours.vectors(table).select("vec", F.array("vec_id").alias("ids")).cache()
    setting = neighbours.tune(packed, 5, neighbours.RECALL, 42)
    met, recall = work_of(x, setting)
    assert recall >= 0.9
    assert met <= len(x)
    if kind == "clusters":
        assert met <= 0.2 * len(x)


def test_the_coarsest_setting_meets_all_rows(spark, monkeypatch):
    """Where no other setting would do, each query still meets its neighbours."""
    monkeypatch.setattr(neighbours, "GRID", neighbours.GRID[-1:])
    x = np.random.default_rng(7).normal(size=(400, 6)).astype("f")
    rows = rows_of(x)
    got = found(neighbours.nearest(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 20 == 0))
    assert {q: [i for i, _ in near] for q, near in got.items()} == {
        q: [i for i, _ in near] for q, near in plain(rows, 20).items()
    }
