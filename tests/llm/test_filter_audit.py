"""The audit against a plain loop over documents, orders and steps."""

from collections import defaultdict
from itertools import permutations

import numpy as np
import pytest
from samples import docs, edge_rows  # noqa: F401

from tributary.llm import filter_audit

LABELS = "doc_id long, quality int, toxic int"


def fails(text: str) -> set[str]:
    words = text.encode().split()  # ASCII white space only
    return {
        name
        for name, bad in {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text),
            "D": any(c in "#$%&*|" for c in text),
        }.items()
        if bad
    }


def plain(rows, labels) -> set[tuple]:
    """rows: (doc_id, text, lang, ...); labels: (doc_id, quality, toxic)."""
    rows = [(i, t or "", lang or "") for i, t, lang, *_ in rows]
    failed = []
    for i, text, _ in rows:
        own = fails(text)
        if i is not None and any(j is not None and j < i and t == text for j, t, _ in rows):
            own.add("E")
        failed.append(own)
    good = {i for i, q, _ in labels if q == 1} - {None}
    toxic = {i for i, _, t in labels if t == 1} - {None}
    out = set()
    for part in {lang for _, _, lang in rows}:
        here = [(i, f) for (i, _, lang), f in zip(rows, failed, strict=True) if lang == part]
        found, shapley = [], defaultdict(int)
        for order in permutations("ABCDE"):
            left, gone = here, []
            for step, name in enumerate(order, 1):
                removed = [x for x in left if name in x[1]]
                redundant = sum(name in f for _, f in gone)
                left = [x for x in left if name not in x[1]]
                gone = gone + removed
                shapley[name] += len(removed)
                found.append(
                    ("".join(order), step, len(left), len(removed), redundant,
                     sum(f == {name} for _, f in here), sum(i in good for i, _ in removed),
                     sum(i in toxic for i, _ in removed))
                )
        out |= {(part, *row, shapley[row[0][row[1] - 1]]) for row in found}
    return out


def checked(spark, docs, rows, labels, clash=False):  # noqa: F811
    out = filter_audit.audit(docs(rows, clash), spark.createDataFrame(labels, LABELS))
    got = [tuple(r) for r in out.collect()]
    assert len(got) == len(set(got))
    assert set(got) == plain(rows, labels)
    return got


@pytest.mark.parametrize("clash", [False, True])
def test_edge_rows(spark, docs, clash):  # noqa: F811
    labels = [(4, 1, 0), (4, None, 1), (5, 0, 1), (6, 1, 1), (None, 1, 1), (99, 1, 0)]
    got = checked(spark, docs, edge_rows(), labels, clash)
    assert {r[0] for r in got} == {"", "en", "de"}
    assert len(got) == 3 * 600


def test_random_rows(spark, docs):  # noqa: F811
    rng = np.random.default_rng(3)
    texts = []
    for _ in range(25):
        words = rng.choice(["ab", "c", "De", "F#", "gh", "ii", "K"], rng.integers(150, 260))
        extra = [f"w{i}" for i in range(rng.integers(0, 160))]
        texts.append(" ".join([*words, *extra]))
    rows = [
        (int(rng.integers(0, 60)), texts[rng.integers(0, 25)], ["x", "y", None][rng.integers(0, 3)], None, 0)
        for _ in range(120)
    ]
    labels = [(i, int(rng.integers(0, 2)), int(rng.integers(0, 2))) for i in range(40)]
    checked(spark, docs, rows, labels)


def test_no_rows(spark, docs):  # noqa: F811
    out = filter_audit.audit(docs([]), spark.createDataFrame([], LABELS))
    assert out.collect() == []


def test_fields_do_not_run_over(spark):
    """Counts near the largest long stay in their fields."""
    big = 2**61
    rows = [("p", 1, big, big, 0), ("p", 3, big, 0, big), ("p", 0, big, 0, 0)]
    counts = spark.createDataFrame(rows, "part string, mask int, n long, n_good long, n_toxic long")
    out = {(r.filter_order, r.step): r for r in filter_audit.interactions(counts, "XY").collect()}
    assert len(out) == 4
    first, second = out["XY", 1], out["XY", 2]
    assert (first.kept, first.removed, first.good_lost, first.toxic_lost) == (big, 2 * big, big, big)
    assert (second.removed, second.redundant, second.shapley) == (0, big, big)
    assert (first.unique_fails, second.unique_fails, first.shapley) == (big, 0, 3 * big)


def test_more_parts_than_a_task_holds(spark):
    n = filter_audit.PARTS * 3
    rows = [(f"p{i % n}", 1 + i % 2, 1, 0, 0) for i in range(3 * n)]
    counts = spark.createDataFrame(rows, "part string, mask int, n long, n_good long, n_toxic long")
    out = filter_audit.interactions(counts.repartition(3), "XY").where("step = 1").collect()
    assert len(out) == 2 * n
    assert {r.kept + r.removed for r in out} == {3}
