import random
from collections import defaultdict
from zlib import crc32

import numpy as np
from samples import docs, edge_rows, sentence  # noqa: F401  (docs is a fixture)
from tokenizers import Tokenizer

from tributary.llm import packing


def plain_sum_of_squares(lengths, capacity):
    """Every choice tried, the sum over all gaps told anew each time; the fullest bin wins ties,
    and an open bin against a new one."""
    gaps, out = [], []
    for size in lengths:
        def after(i, size=size):
            new = [*gaps, capacity] if i == len(gaps) else list(gaps)
            new[i] -= size
            counts = np.bincount([g for g in new if 0 < g < capacity], minlength=1)
            return int((counts**2).sum())

        fits = [i for i, g in enumerate([*gaps, capacity]) if g >= size]
        best = min(fits, key=lambda i: (after(i), i == len(gaps), [*gaps, capacity][i], -i))
        if best == len(gaps):
            gaps.append(capacity)
        out.append(gaps[best])
        gaps[best] -= size
    return out, sorted(gaps)


def test_rule_matches_trying_everything():
    rng = random.Random(1)
    for _ in range(60):
        capacity = rng.randint(5, 25)
        lengths = np.array([rng.randint(1, capacity) for _ in range(rng.randint(1, 40))])
        bins, offsets = packing.sum_of_squares(lengths, capacity)
        gaps, left = plain_sum_of_squares(lengths.tolist(), capacity)
        assert (capacity - offsets).tolist() == gaps
        filled = np.bincount(bins, lengths).astype(int)
        assert sorted((capacity - filled).tolist()) == left


def check(rows, out, length):
    """Documents are whole, sequences gapless and not overfull; returns the sequences."""
    tokenizer = Tokenizer.from_file(packing.TOKENIZER)
    wanted = []
    for doc_id, text, *_ in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        for i in range(0, len(ids), length):
            own = ids[i : i + length].tobytes()
            wanted.append((str(doc_id), i // length, i, len(own) // 4, crc32(own), own))
    got = [(str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32, bytes(r.ids)) for r in out]
    assert sorted(got) == sorted(wanted)
    sequences = defaultdict(list)
    for r in out:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, own in sorted(places):
            assert offset == at
            at += own
        assert at <= length
    return sequences


def test_documents(docs):
    rng = random.Random(2)
    rows = [(i, sentence(rng, rng.randint(0, 60)), "en", "a", 1) for i in range(500)]
    out = packing.pack(docs(rows, clash=True), length=64).collect()
    sequences = check(rows, out, 64)
    total = sum(r.length for r in out)
    assert len(sequences) <= 1.01 * total / 64 + 1


def test_many_groups_are_packed_nearly_as_well(docs):
    rng = random.Random(3)
    rows = [(None, sentence(rng, rng.randint(0, 20)), "en", "a", 1) for i in range(600)]
    out = packing.pack(docs(rows), length=128, group_pieces=60).collect()
    sequences = check(rows, out, 128)
    assert len(sequences) <= 1.05 * sum(r.length for r in out) / 128 + 1


def test_edge_rows(docs):
    out = packing.pack(docs(edge_rows(), clash=True)).collect()
    check(edge_rows(), out, packing.LENGTH)
    assert packing.pack(docs([])).count() == 0
