import random
import re
from itertools import combinations

import numpy as np
import pytest
from xxhash import xxh64_intdigest

from tributary.llm import simhash
from tributary.llm.components import components

from samples import docs, edge_rows, sentence  # noqa: F401  (docs is a fixture)


def plain_print(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)]
    shingles = shingles or ([" ".join(words)] if words else [])
    hashes = [xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(
        1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) > len(hashes)
    )


def plain_groups(prints, max_bits):
    """Component of each place in a list of prints."""
    parent = list(range(len(prints)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in combinations(range(len(prints)), 2):
        if (prints[i] ^ prints[j]).bit_count() <= max_bits:
            a, b = sorted((root(i), root(j)))
            parent[b] = a
    return [root(i) for i in range(len(prints))]


def same_partition(left, right):
    return len(set(zip(left, right, strict=True))) == len(set(left)) == len(set(right))


def test_prints_match_their_definition():
    rng = random.Random(2)
    texts = [sentence(rng, rng.randint(0, 40)).title() for _ in range(60)]
    for text in [*texts, None, "", " \n", "A", "É a\x1cb B", "a " * 5]:
        assert simhash.fingerprint(text) == plain_print(text)
    long = sentence(rng, 70_000)
    words = long.lower().split()
    hashes = [xxh64_intdigest(" ".join(words[i : i + 3]).encode(), 42) for i in range(69_998)]
    ones = [sum(h >> i & 1 for h in hashes) for i in range(64)]
    assert simhash.fingerprint(long) == sum(1 << i for i in range(64) if 2 * ones[i] > 69_998)


@pytest.mark.parametrize(("max_bits", "meet"), [(3, 2048), (3, 2), (1, 3), (0, 2)])
def test_links_join_what_brute_force_joins(spark, max_bits, meet):
    """Small values of ``meet`` send everything through the second split."""
    rng = random.Random(max_bits * 10 + meet)
    prints = {0, (1 << 64) - 1}
    for _ in range(12):
        centre = rng.getrandbits(64)
        for _ in range(25):
            x = centre
            for _ in range(rng.randint(0, 5)):
                x ^= 1 << rng.randrange(64)
            prints.add(x)
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    table = spark.createDataFrame([(p,) for p in signed], "print long")
    roots = components(simhash.links(table, max_bits, meet)).collect()
    root = {r.node: r.root for r in roots}
    assert same_partition(
        [root.get(p, p) for p in signed], plain_groups(prints, max_bits)
    )


def test_links_refuse_more_bits_than_variants_find(spark):
    with pytest.raises(ValueError, match="three"):
        simhash.links(spark.createDataFrame([(1,)], "print long"), 4)


def test_components_of_long_chains_and_hubs(spark):
    chain = [(i, i + 1) for i in range(300)]
    hub = [(1000, 1000 + i) for i in range(1, 400)]
    out = components(spark.createDataFrame(chain + hub, "a long, b long")).collect()
    assert {r.node: r.root for r in out} == {
        **dict.fromkeys(range(301), 0), **dict.fromkeys(range(1000, 1400), 1000)
    }


def near_rows():
    rng = random.Random(8)
    rows = []
    for g in range(6):
        words = sentence(rng, 400).split()
        for copy in range(4):
            own = list(words)
            if copy:
                own[rng.randrange(400)] = "changed"
            rows.append((1000 * g + 100 + copy, " ".join(own), "en", "a", 1))
    return [*rows, *edge_rows()]


def test_components_of_documents(docs):
    rows = near_rows()
    out = simhash.near_duplicates(docs(rows, clash=True)).collect()
    assert len(out) == len(rows)
    prints = [plain_print(row[1]) if row[0] != 6 else simhash.fingerprint(row[1]) for row in rows]
    groups = plain_groups(prints, 3)
    least = {}
    for row, group in zip(rows, groups, strict=True):
        if row[0] is not None:
            least[group] = min(least.get(group, row[0]), row[0])
    wanted = sorted(
        (str(row[0]), p, least.get(g)) for row, p, g in zip(rows, prints, groups, strict=True)
    )
    got = sorted((str(r.doc_id), r["print"] % (1 << 64), r.component_id) for r in out)
    assert got == wanted


def test_one_document_of_each_component_stays(docs):
    rows = near_rows()
    table = docs(rows, clash=True)
    kept = simhash.keep_one(table)
    assert kept.columns == table.columns
    found = simhash.near_duplicates(table).collect()
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(
        {str(r.component_id) for r in found}
    )


@pytest.mark.parametrize("seen", [1, 1 << 40])
def test_crowded_variants(spark, monkeypatch, seen):
    """Prints around one template, more than may meet: found in time and dealt, or met first."""
    monkeypatch.setattr(simhash, "_SEEN", seen)
    rng = random.Random(9)
    base = rng.getrandbits(64)
    prints = {base}
    while len(prints) < 700:
        own = base
        for _ in range(rng.randint(1, 6)):
            own ^= 1 << rng.randrange(32, 64)
        prints.add(own)
    prints |= {rng.getrandbits(64) for _ in range(50)}
    table = spark.createDataFrame([(int(np.uint64(p).astype(np.int64)),) for p in prints], "print long")
    known = simhash._crowded_keys(table, 40).count()
    assert known > 0 if seen == 1 else known == 0
    links = {(r.a % (1 << 64), r.b % (1 << 64)) for r in simhash.links(table, 3, 40).collect()}
    assert len(links) < 64 * len(prints)
    parent = {p: p for p in prints}

    def root(p):
        while parent[p] != p:
            p = parent[p]
        return p

    for a, b in links:
        parent[root(a)] = root(b)
    ordered = sorted(prints)
    wanted = plain_groups(ordered, 3)
    groups = {}
    for p, group in zip(ordered, wanted, strict=True):
        groups.setdefault(group, set()).add(root(p))
    assert all(len(roots) == 1 for roots in groups.values())
    assert len({root(p) for p in ordered}) == len(groups)


def test_ids_may_be_null_or_repeated_and_tables_empty(docs):
    a, b = "one two three four", "five six seven eight"
    rows = [(None, a, None, None, None), (None, a, None, None, None), (1, b, "x", "y", 2),
            (1, b, "x", "y", 2), (2, b, "x", "y", 2)]
    kept = simhash.keep_one(docs(rows)).collect()
    assert sorted(str(r.doc_id) for r in kept) == ["1", "None"]
    found = simhash.near_duplicates(docs(rows)).collect()
    assert {r.component_id for r in found if r.doc_id is None} == {None}
    assert simhash.near_duplicates(docs([])).count() == 0
    assert simhash.keep_one(docs([])).count() == 0


def test_every_pair_meets_under_some_variant():
    import pyarrow as pa

    rng = random.Random(4)
    for _ in range(50):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), 3):
            b ^= 1 << bit
        part = pa.RecordBatch.from_arrays(
            [pa.array(np.array([a, b], np.uint64).view(np.int64))], ["print"]
        )
        keys = simhash._halves(part).column("key").to_numpy().reshape(-1, 2)
        assert (keys[:, 0] == keys[:, 1]).any()
