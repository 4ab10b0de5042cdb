"""The trie against one built by dictionaries."""

import hashlib
import random
import zlib

import pytest

from tributary.llm import prefix_trie
from tributary.llm.tables import skew_join

COLUMNS = "conv_id long, turn long, role string, text string"


def plain(rows) -> list[tuple]:
    own: dict[int, list] = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            text = text or ""
            digest = hashlib.sha256(text.encode()).hexdigest()
            own.setdefault(conv, []).append((turn is not None, turn, role or "", digest, text))
    own = {
        c: [(r[2], r[4]) for r in sorted(t, key=lambda r: (r[0], r[1] or 0, r[2], r[3]))]
        for c, t in own.items()
    }
    members: dict[tuple, list[int]] = {}
    ends: dict[tuple, list[int]] = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        head = int(c / 100) * 100
        whole = (*own.get(head, [])[:h], *turns[h:])
        for d in range(len(whole) + 1):
            members.setdefault(whole[:d], []).append(c)
        ends.setdefault(whole, []).append(c)
    children: dict[tuple, int] = {}
    for node in members:
        if node:
            children[node[:-1]] = children.get(node[:-1], 0) + 1
    leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for node, who in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in children
            saved[node[:d]] += (len(who) - 1) * len(node[-1][1]) if node else 0
    return sorted(
        (
            min(who), len(node), min(members[node[:-1]]) if node else None, len(who),
            children.get(node, 0), leaves[node], saved[node],
            hashlib.sha256(",".join(map(str, sorted(ends.get(node, [])))).encode()).hexdigest(),
        )
        for node, who in members.items()
    )


def checked(spark, rows, columns=COLUMNS, **args):
    out = prefix_trie.trie(spark.createDataFrame(rows, columns), **args)
    got = [tuple(r) for r in out.collect()]
    wanted = plain([r[:4] for r in rows])
    assert sorted(got, key=lambda r: (r[0], r[1])) == wanted
    return wanted


def test_edge_rows(spark):
    rows = [
        (0, None, "user", "first"), (0, 0, None, "a"), (0, 1, "user", None), (0, 1, "user", None),
        (0, 7, "", ""), (1, 0, "user", "x" * 100_000), (None, 0, "user", "lost"), (2, 5, "u", "é\U0001f600"),
        (2, 5, "u", "b"), (2, 5, "s", "c"), (7, 0, "u", "t"), (9, 0, "u", "t"), (11, 0, "u", "t"),
        (-5, 0, "u", "t"), (-105, 0, "u", "t"), (205, 3, "u", "no head"), (206, 3, "u", "no head"),
    ]
    clashing = [(*r, r[1], "b", "c", 1) for r in rows]
    columns = COLUMNS + ", node long, conv string, depth string, one long"
    checked(spark, clashing, columns)


def test_no_rows(spark):
    assert checked(spark, []) == []
    assert checked(spark, [(None, 1, "a", "b")]) == []


@pytest.mark.parametrize("height", [2, 3, 16])
def test_random_conversations(spark, height):
    """Long common beginnings, several bands and bands of bands."""
    rng = random.Random(height)
    rows = []
    for c in range(60):
        conv = c * 7
        for turn in range(rng.randint(1, 30)):
            same = turn < rng.choice((0, 8, 30))
            rows.append((conv, turn, "u", f"{turn}" if same else rng.choice("abc") * rng.randint(0, 3)))
    rng.shuffle(rows)
    wanted = checked(spark, rows, height=height)
    assert max(r[1] for r in wanted) >= 25


def test_conversation_over_many_tasks(spark):
    """One conversation holds most rows and lies in several slices."""
    rng = random.Random(1)
    rows = [(100, turn, "u", str(turn)) for turn in range(300)]
    rows += [(c, turn, "u", str(turn)) for c in range(101, 130) for turn in range(rng.randint(1, 6))]
    # Adaptive execution would join the few rows here to one slice.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        slices = prefix_trie._numbered(spark.createDataFrame(rows, COLUMNS))
        assert slices.where("conv = 100").select("slice").distinct().count() > 1
        checked(spark, rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_many_equal_conversations(spark, monkeypatch):
    """The ids that end at one node fill many pieces."""
    monkeypatch.setattr(prefix_trie, "CHUNK", 50)
    rows = [(c, turn, "u", str(turn)) for c in range(400) for turn in range(7)]
    wanted = checked(spark, rows)
    assert len(wanted) == 8


def test_bands_bound_what_is_handed_on(spark):
    """A chain of 256 nodes needs four rounds of height 4; each gives no more than 8 a node."""
    n = 256
    path = spark.createDataFrame([(0, d, d) for d in range(n)], "conv long, depth long, node long")
    nodes = spark.createDataFrame([(d, 0, d, 1) for d in range(n)], "node long, conv long, depth long, v long")
    out = prefix_trie.subtree_sums(path, nodes, ["v"], 4)
    assert sorted(map(tuple, out.collect())) == [(d, n - d) for d in range(n)]


def test_skew_join(spark):
    rows = [(0, i) for i in range(2000)] + [(i % 900, i) for i in range(3000)] + [(None, -1)]
    left = spark.createDataFrame(rows, "k long, v long")
    right = spark.createDataFrame([(i, str(i)) for i in range(0, 900, 2)], "k long, s string")
    got = sorted(map(tuple, skew_join(left, right, "k").select("k", "v", "s").collect()), key=str)
    wanted = [(k, v, str(k) if k is not None and k % 2 == 0 else None) for k, v in rows]
    assert got == sorted(wanted, key=str)
