import random
import re

import numpy as np
import pytest
from samples import docs, edge_rows  # noqa: F401  (docs is a fixture)

from tributary.llm import crf, personal

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def plain(text):
    """Spans found with the patterns as they are stated."""
    out = []
    for order, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub(r"[^0-9]", "", m.group())
            if kind == "ip" and any(int(x) > 255 for x in m.group().split(".")):
                continue
            if kind == "card" and not (14 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            out.append((m.start(), order, kind, m.end()))
    return [(kind, start, end) for start, _, kind, end in sorted(out)]


@pytest.fixture(scope="module")
def tagger():
    return crf.train(sorted(personal.labelled_lines()))


def test_patterns_match_their_statement():
    rng = random.Random(1)
    parts = ["a.b", "@", "x-1", ".com", " ", "1", "25", "256", "0001", ".", "-", "+", "(555)", "é", "\n",
             "4111111111111111", "4111 1111 1111 1111", "+1 212", "555-0100", "10.0.0.7", "a@b.c", "@@", "%"]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(1, 14)))
        assert personal.base_spans(text) == plain(text), text


def test_patterns_take_linear_time_on_long_runs():
    for text in ("1" * 200_000, "a" * 200_000 + "@", "1." * 100_000, "+1 " * 60_000, "a@" * 60_000):
        personal.base_spans(text)


def test_tagger_finds_other_forms(tagger):
    for text, kind, value in [
        ("write to jo.doe (at) sample (dot) org soon", "crf_email", "jo.doe (at) sample (dot) org"),
        ("host 10[.]0[.]0[.]7 answers", "crf_ip", "10[.]0[.]0[.]7"),
        ("card 4111.1111.1111.1111, please", "crf_card", "4111.1111.1111.1111"),
        ("call (512) 555-0100 now", "crf_phone", "(512) 555-0100"),
    ]:
        (_, spans), = personal.all_spans([text], tagger)
        assert [(k, text[a:b]) for k, a, b in spans] == [(kind, value)]


@pytest.mark.parametrize("value", [
    "jo.doe (at) sample (dot) org", "jo[at]sample.org", "jo at sample dot org",
    "jo_doe [at] sample [dot] com", "jo at sample dot com", "JO AT SAMPLE DOT ORG",
    "Jo At Sample Dot Net", "jo (At) sample (Dot) net", "jo.doe@sample.org",
])
def test_each_form_on_a_line_without_digits(tagger, value):
    for line in ("write to {}", "no cue here\nplease write to {} soon\nnor here"):
        text = line.format(value)
        (_, spans), = personal.all_spans([text], tagger)
        assert [(kind.removeprefix("crf_"), text[a:b]) for kind, a, b in spans] == [("email", value)]


def test_lines_without_a_cue_hold_nothing(tagger, monkeypatch):
    """Reading every line finds no more than reading those with a cue."""
    rng = random.Random(6)
    parts = ["at", "At", "AT", "dot", "DOT", "(at)", "[At]", "(dot)", "[.]", ".", ".org", "jo", "sample", "sample.org",
             "a-b", "é", "@", "7", "(512)", "555-0100", " ", " ", " ", "\t", "\r", "\u2003", "\n", ","]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 30))) for _ in range(4000)]
    texts += [" ".join(rng.choices(parts[:20], k=rng.randint(3, 9))) for _ in range(4000)]
    cued = personal.all_spans(texts, tagger)
    monkeypatch.setattr(personal, "_CUE", re.compile(r"[^\n]"))
    assert personal.all_spans(texts, tagger) == cued
    assert sum(any(kind == "crf_email" for kind, *_ in spans) for _, spans in cued) > 30


def test_cues_take_linear_time_on_long_runs():
    for text in (" at " * 60_000, " at " + "a" * 200_000, " at" + " " * 200_000, " at a" * 60_000, " at a" + " " * 200_000):
        assert list(personal._lines(text)) == []


def test_held_out_lines(tagger):
    """Most spans of lines made with another seed, and next to nothing else."""
    found = wanted = false = 0
    lines = personal.labelled_lines(300, seed=7)
    all_ = personal.all_spans([line for line, _ in lines], tagger)
    for (_, spans), (_, got) in zip(lines, all_, strict=True):
        got = {(kind.removeprefix("crf_"), a, b) for kind, a, b in got}
        wanted += len(spans)
        found += len(got & set(spans))
        false += len(got - set(spans))
    assert found / wanted > 0.85
    assert false / wanted < 0.05


def test_clean_text_stays_clean(tagger):
    for text in ("In 2021 it cost 3.50, or 1,200.00 in version 2.10.3.", "see 12:30 #1234 (2020)",
                 'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"', "password=0030ef94f364d8386a"):
        assert personal.all_spans([text], tagger)[0] == ([], [])


def test_viterbi_finds_the_best_path():
    from itertools import product

    rng = np.random.default_rng(3)
    size = len(crf.LABELS)
    lengths = np.array([4, 3, 1])
    scores = rng.normal(size=(3, 4, size))
    moves = np.where(crf._allowed(), rng.normal(size=(size + 1, size)), -1e9)
    paths = crf.viterbi(scores, lengths, moves)
    for row, n in enumerate(lengths):
        def total(path, row=row):
            out = moves[size, path[0]] + scores[row, 0, path[0]]
            for t in range(1, len(path)):
                out += moves[path[t - 1], path[t]] + scores[row, t, path[t]]
            return out

        best = max(product(range(size), repeat=int(n)), key=total)
        assert tuple(paths[row, :n]) == best


def test_expected_labels_are_those_of_all_paths():
    from itertools import product

    rng = np.random.default_rng(4)
    size = len(crf.LABELS)
    scores = rng.normal(size=(1, 3, size))
    moves = np.where(crf._allowed(), rng.normal(size=(size + 1, size)), -1e9)
    seen, went = crf._expected(scores, np.ones((1, 3), bool), moves)
    weight, labels, steps = 0.0, np.zeros((3, size)), np.zeros((size + 1, size))
    for path in product(range(size), repeat=3):
        own = moves[size, path[0]] + scores[0, 0, path[0]]
        own += sum(moves[path[t - 1], path[t]] + scores[0, t, path[t]] for t in (1, 2))
        own = np.exp(own)
        weight += own
        labels[range(3), path] += own
        steps[size, path[0]] += own
        steps[path[0], path[1]] += own
        steps[path[1], path[2]] += own
    assert np.allclose(seen[0], labels / weight)
    assert np.allclose(went, steps / weight)


def test_documents(spark, docs, tagger):
    text = "é mail a.b@c.org, ip 10.0.0.7 and call (512) 555-0100"
    rows = [(1, text, "en", "a", 53), *edge_rows()]
    out = personal.find_personal(docs(rows, clash=True), tagger).collect()
    assert len(out) == len(rows)
    first = next(r for r in out if r.spans)
    assert first.base == "email:7:16,ip:21:29"
    assert first.spans == "email:7:16,ip:21:29,crf_phone:39:53"
    assert (first.n_email, first.n_ip, first.n_card, first.n_phone) == (1, 1, 0, 0)
    assert sum(bool(r.spans) for r in out) == 1

    table = docs(rows, clash=True)
    hidden = personal.redact(table, tagger)
    assert hidden.columns == table.columns
    texts = sorted((str(r.doc_id), str(r.text), str(r.n_chars)) for r in hidden.collect())
    clean = "é mail <email>, ip <ip> and call <phone>"
    rows = [(1, clean, "en", "a", len(clean)), *edge_rows()]
    assert texts == sorted((str(r[0]), str(r[1]), str(r[4])) for r in rows)
    assert personal.redact(docs([]), tagger).count() == 0


def test_spans_that_overlap_become_one():
    assert personal.hidden("abcdef", [("ip", 1, 3), ("card", 2, 5)]) == "a<ip>f"


def test_training_table_is_bounded_and_may_be_empty(spark):
    table = personal.labelled_table(spark)
    with pytest.raises(ValueError, match="more than 10 rows"):
        personal.fit_tagger(table, 10)
    none = personal.fit_tagger(table.limit(0))
    assert personal.all_spans(["call (512) 555-0100"], none) == [([], [])]
