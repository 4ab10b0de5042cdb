import math
import random

import numpy as np
import pytest
from samples import docs, edge_rows, word  # noqa: F401  (docs is a fixture)

from tributary.llm import toxicity

INSULTS = ["blockhead", "nitwit", "dolt", "plugugly"]


@pytest.fixture(scope="module")
def corpus():
    """Long invented documents; in a fifth of them two sentences hold an insult."""
    rng = random.Random(1)
    rows, labels, places = [], [], {}
    for i in range(700):
        parts = [" ".join(word(rng) for _ in range(10)) for _ in range(15)]
        if i % 5 == 0:
            places[i] = sorted(rng.sample(range(15), 2))
            for at in places[i]:
                bad = rng.choice(INSULTS) + rng.choice(["", "s", "ish"])
                parts[at] = f"{parts[at]} {bad} {word(rng)}"
        rows.append((i, ". ".join(parts) + ".", "en", "a", 1))
        labels.append((i, int(i % 5 == 0)))
    return rows, labels, places


@pytest.fixture(scope="module")
def scorer(spark, corpus):
    rows, labels, _ = corpus
    known = [*labels[:400], (None, 1), (99_999, 1), (3, None), (3, 0)]
    return toxicity.fit_scorer(
        spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n long"),
        spark.createDataFrame(known, "doc_id long, toxic int"),
    )


def test_held_out_documents_and_their_sentences(docs, corpus, scorer):
    rows, labels, places = corpus
    out = toxicity.score(docs(rows[400:], clash=True), scorer).collect()
    assert len(out) == 300
    hits = 0
    for r in out:
        text = rows[r.doc_id][1]
        assert (r.score >= toxicity.THRESHOLD) == bool(labels[r.doc_id][1])
        found = {text.count(".", 0, s.start) for s in r.sentences}
        assert found <= set(places.get(r.doc_id, []))
        hits += len(found)
        assert all(any(i in text[s.start : s.end] for i in INSULTS) for s in r.sentences)
    assert hits >= 0.8 * sum(len(own) for i, own in places.items() if i >= 400)


def test_score_is_noisy_or_of_the_sentences(corpus, scorer):
    for _, text, *_ in [*corpus[0][:50], (0, ""), (0, "x"), (0, "a. b.\n"), (0, corpus[0][0][1][:-1])]:
        chances = [p for _, _, p in scorer.sentence_scores(text)]
        assert scorer.score(text) == pytest.approx(1 - np.prod([1 - p for p in chances]))
        places = toxicity.sentences(text)
        assert "".join(text[a:b] for a, b in places) == text


def test_length_alone_makes_nothing_toxic(docs, scorer):
    base = 1 / (1 + np.exp(-scorer.constant))
    clean = "table\n" * 20_000
    weak = toxicity.Scorer({"dolt$": 1.0}, scorer.constant)
    assert scorer.score(clean) == pytest.approx(base)
    assert weak.score(clean + "dolt") < 4 * base + base
    chances = [p for _, _, p in weak.sentence_scores(clean + "dolt")]
    assert weak.score(clean + "dolt") == pytest.approx(1 - np.prod([1 - p for p in chances]))
    rows = [(1, clean, "en", "a", 1), (2, clean + INSULTS[0], "en", "a", 1)]
    out = {r.doc_id: r for r in toxicity.score(docs(rows), scorer).collect()}
    assert out[1].score == pytest.approx(base) and out[1].sentences == []
    assert out[2].score >= toxicity.THRESHOLD and len(out[2].sentences) == 1


def test_training_goes_downhill_to_the_labels():
    rng = np.random.default_rng(2)
    toxic = np.arange(40) % 2 == 0
    document = np.repeat(np.arange(40), 3)
    # Feature 0 is in one sentence of each toxic document, feature 1 anywhere.
    columns = np.where((np.arange(120) % 3 == 0) & toxic[document], 0, 1)
    rows = np.arange(120)
    keep = (columns == 0) | (rng.random(120) < 0.5)
    rest = np.bincount(document[~keep], minlength=40) / 3
    w, constant = toxicity.train(rows[keep], columns[keep], toxic, document, 2, rest)
    assert w[0] + constant > 0 and w[1] + constant < -3


def plain_loss(bags, toxic, rest, clean_weight, w, constant, penalty):
    """Minus the log likelihood of noisy-or over sentences, one after another."""
    loss = penalty / 2 * (sum(x * x for x in w) + (constant - toxicity.CONSTANT) ** 2)
    for bag, label, share in zip(bags, toxic, rest):
        clean = math.exp(-1e-3) * (1 - 1 / (1 + math.exp(-constant))) ** share
        for features in bag:
            clean *= 1 - 1 / (1 + math.exp(-constant - sum(w[i] for i in features)))
        loss -= math.log(1 - clean) if label else clean_weight * math.log(clean)
    return loss


@pytest.mark.parametrize("clean_weight", [1.0, 4.0])
def test_training_ends_where_a_plain_likelihood_is_least(clean_weight):
    rng = random.Random(7)
    toxic = [i % 3 == 0 for i in range(90)]
    bags = [
        [[j for j in range(4) if rng.random() < (0.3 if label and j == 0 else 0.15)] for _ in range(3)]
        for label in toxic
    ]
    bags = [[features for features in bag if features] for bag in bags]
    rest = [1 - len(bag) / 3 for bag in bags]
    flat = [(n, features) for n, bag in enumerate(bags) for features in bag]
    w, constant = toxicity.train(
        np.repeat(np.arange(len(flat)), [len(features) for _, features in flat]),
        np.concatenate([features for _, features in flat]), np.array(toxic),
        np.array([n for n, _ in flat]), 4, np.array(rest), clean_weight, rounds=3000, rate=0.02,
    )
    at = [*w.tolist(), constant]
    assert constant > toxicity.CONSTANT + 1  # documents toxic without a known word raise it

    def loss(point):
        return plain_loss(bags, toxic, rest, clean_weight, point[:4], point[4], 0.05)

    for i in range(5):
        for step in (-0.05, 0.05):
            assert loss(at) <= loss([x + step * (i == j) for j, x in enumerate(at)]) + 1e-4


def test_words_of_clean_text_cannot_enter(spark, corpus, scorer):
    """A word that clean documents have as often gets no weight, though toxic ones have it too."""
    rows, labels, _ = corpus
    rows = [(i, f"{text} Gardens and barns.", *rest) for i, text, *rest in rows]
    rows = [(i, f"Meadow. {text}" if i % 10 == 0 or i % 7 == 1 else text, *rest) for i, text, *rest in rows]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n long")
    found = toxicity.fit_scorer(docs, spark.createDataFrame(labels[:400], "doc_id long, toxic int"))
    assert any(word.startswith("dolt") for word in found.weights)
    for word in ("gardens", "and", "barns", "meadow"):
        assert not set(toxicity.names(word)) & set(found.weights)
    clean = {w for i, text, *_ in rows[400:] if i % 5 for w in toxicity.words_of(text)}
    weighted = {w for w in clean if any(n in found.weights for n in toxicity.names(w))}
    hits = [sum(w in toxicity.words_of(text) for i, text, *_ in rows[400:] if i % 5) for w in weighted]
    assert all(n <= 0.02 * 300 for n in hits)


def test_clean_documents_left_out_of_the_sample_count(spark, corpus, monkeypatch):
    rows, labels, _ = corpus
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n long")
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    asked, plain = [], toxicity.train
    monkeypatch.setattr(toxicity, "train", lambda *a: asked.append(a[-1]) or plain(*a))
    toxicity.fit_scorer(docs, known)
    toxicity.fit_scorer(docs, known, sample_rows=70)
    assert asked[0] == pytest.approx(1)
    assert asked[1] == pytest.approx(4, rel=0.5)


def test_edge_rows(spark, docs, corpus, scorer):
    out = toxicity.score(docs(edge_rows(), clash=True), scorer).collect()
    assert len(out) == len(edge_rows())
    assert all(0 <= r.score <= 1 for r in out)
    base = 1 / (1 + np.exp(-scorer.constant))
    assert all(r.score == pytest.approx(base) for r in out if r.doc_id in (1, 2))
    assert toxicity.score(docs([]), scorer).count() == 0
    labels = spark.createDataFrame([(i, 0) for i in range(50)], "doc_id long, toxic int")
    none = toxicity.fit_scorer(docs(corpus[0]), labels)
    assert none.weights == {}
    empty = toxicity.fit_scorer(docs([]), labels)
    assert empty.weights == {}
