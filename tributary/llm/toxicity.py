"""Toxicity as multiple-instance learning: a document is toxic if one of its sentences is.

A sentence scores by its words: the logistic of a constant plus the weights of the words in
it. A word is known by itself and by its first letters, so that inflected forms share a
weight. Sentences without any known word share one constant among them, so that length alone
adds nothing to a score. A document scores by noisy-or, one minus the chance that no sentence
is toxic, and the weights and the constant are trained so that these document scores fit the
labels of documents, clean ones counting as often as they are among all labels. Afterwards the
sentence scores say where a document offends.

Training reads a bounded sample of labelled rows (``SAMPLE_ROWS`` of each label, by a hash of
the id) and keeps a bounded number of words (``MOST_FEATURES``). Scoring reads every text whole.

Defined results: a null or empty text has one empty sentence; labels without an id, for an
unknown id or without a value take no part, and a document with several labels counts as toxic
if one of them says so; repeated rows get equal scores; an empty table gives an empty result.
Without labelled rows of both kinds every document scores ``CONSTANT``. Columns beside the ones
named are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.tables import batches, pick, sampled, stored
from tributary.llm.words import Memory

SAMPLE_ROWS = 3000
MOST_FEATURES = 20_000
THRESHOLD = 0.7
#: Where training begins with the constant of a sentence with known words, and of all those
#: without any in a document together, and where it is drawn to: one in some thousands.
CONSTANT = -9.0
#: A word is kept if so large a share of toxic sample documents has it (and at least
#: three of them), and if it is so many times likelier there than in the others.
LEAST_SHARE, LEAST_RATIO = 0.002, 4.0

_WORD = re.compile(r"[^\W\d_]+")
_END = re.compile(r"[.!?\n]+")
_PREFIXES = (4, 5, 6)


def names(word: str) -> list[str]:
    """What a word is known by: itself, marked as whole, and its first letters."""
    return [f"{word}$", *(word[:n] for n in _PREFIXES if len(word) >= n)]


def sentences(text: str) -> list[tuple[int, int]]:
    """Places of the sentences; they end at full stops, other end marks and line breaks."""
    out, at = [], 0
    for end in _END.finditer(text):
        out.append((at, end.end()))
        at = end.end()
    if at < len(text) or not out:
        out.append((at, len(text)))
    return out


def words_of(sentence: str) -> set[str]:
    return set(_WORD.findall(sentence.lower()))


@dataclass
class Scorer:
    weights: dict[str, float]
    constant: float = CONSTANT
    _memory: Memory | None = field(default=None, repr=False)

    def _known(self, piece: str) -> tuple[tuple[str, float], ...]:
        """The words with a weight in a space-free piece."""
        found = []
        for word in _WORD.findall(piece):
            weight = sum(self.weights.get(name, 0.0) for name in names(word))
            if weight:
                found.append((word, weight))
        return tuple(found)

    def _odds(self, sentence: str, of: int) -> float:
        """Minus the log of the chance that a lower-case sentence, one ``of`` so many, is clean."""
        known = {pair for piece in sentence.split() for pair in self._memory[piece]}
        if not known:
            return float(np.logaddexp(0, self.constant)) / of
        return float(np.logaddexp(0, self.constant + sum(weight for _, weight in sorted(known))))

    def sentence_scores(self, text: str) -> list[tuple[int, int, float]]:
        """(start, end, score) of each sentence."""
        if self._memory is None:
            self._memory = Memory(self._known)
        places = sentences(text)
        return [
            (start, end, float(-np.expm1(-self._odds(text[start:end].lower(), len(places)))))
            for start, end in places
        ]

    def score(self, text: str | None) -> float:
        """Noisy-or over the sentences."""
        text = text or ""
        if self._memory is None:
            self._memory = Memory(self._known)
        if any(map(self._memory.__getitem__, set(text.lower().split()))):
            places = sentences(text)
            odds = sum(self._odds(text[a:b].lower(), len(places)) for a, b in places)
        else:  # no known word anywhere, and so the whole constant
            odds = np.logaddexp(0, self.constant)
        return float(-np.expm1(-odds))


def train(
    rows: np.ndarray,
    columns: np.ndarray,
    toxic: np.ndarray,
    document: np.ndarray,
    size: int,
    rest: np.ndarray,
    clean_weight: float = 1.0,
    rounds: int = 300,
    rate: float = 0.2,
    penalty: float = 0.05,
) -> tuple[np.ndarray, float]:
    """Weights of features, and the constant.

    ``rows`` and ``columns`` pair a sentence with a feature in it; ``document`` is the
    document of each sentence and ``toxic`` the label of each document. Sentences without
    features share one constant; ``rest`` tells which share of a document's sentences they
    are. A clean document counts ``clean_weight`` times. Every document has 0.001 beside its
    sentences, so that a wrong label is no infinite loss.
    """
    w = np.append(np.full(size, 1.0), CONSTANT)  # the constant comes last
    mean, square = np.zeros(size + 1), np.zeros(size + 1)
    drawn_to = np.append(np.zeros(size), CONSTANT)
    for step in range(1, rounds + 1):
        z = w[size] + np.bincount(rows, w[columns], len(document))
        odds = np.bincount(document, np.logaddexp(0, z), len(toxic)) + 1e-3
        odds += rest * np.logaddexp(0, w[size])
        # Toxic: minus log of noisy-or; clean: the sum of all sentences' log odds.
        by_document = np.where(toxic, -1 / np.expm1(np.minimum(odds, 500)), clean_weight)
        slope = by_document[document] / (1 + np.exp(-z))
        alone = (by_document * rest).sum() / (1 + np.exp(-w[size]))
        g = np.append(np.bincount(columns, slope[rows], size), slope.sum() + alone)
        g += penalty * (w - drawn_to)
        mean += 0.1 * (g - mean)
        square += 0.01 * (g * g - square)
        w -= rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    return w[:size], float(w[size])


#: Weights below this are dropped once trained.
LEAST_WEIGHT = 1.0


def _labelled(labels: DataFrame) -> DataFrame:
    """(doc_id, toxic), one row an id."""
    return (
        pick(labels, doc_id="bigint", toxic="int")
        .where("doc_id is not null and toxic is not null")
        .groupBy("doc_id")
        .agg((F.max("toxic") > 0).alias("toxic"))
    )


def _sample(docs: DataFrame, known: DataFrame, sample_rows: int, seed: int) -> DataFrame:
    """(doc_id, toxic, text): at most ``sample_rows`` documents of each label.

    Of rows that repeat an id one is taken, so they leave room for other documents.
    """
    order = F.xxhash64(F.lit(seed), "doc_id")
    texts = pick(docs, doc_id="bigint", text="string")
    parts = []
    for label in ("toxic", "not toxic"):
        ids = sampled(known.where(label), order, sample_rows)
        rows = texts.join(F.broadcast(ids), "doc_id")
        parts.append(
            rows.groupBy("doc_id").agg(
                F.first("toxic").alias("toxic"), F.min_by("text", F.xxhash64("text")).alias("text")
            )
        )
    return parts[0].union(parts[1]).select("doc_id", "toxic", "text")


def fit_scorer(
    docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, seed: int = 42
) -> Scorer:
    """A scorer from a bounded sample of labelled documents."""
    spark = docs.sparkSession
    known = stored(_labelled(labels), "labels")
    sample = stored(_sample(docs, known, sample_rows, seed), "sample")
    sample = sample.repartition(spark.sparkContext.defaultParallelism, F.xxhash64("text"))

    def features_of(part: pa.RecordBatch) -> pa.RecordBatch:
        found, toxic = [], []
        for text, label in zip(part.column("text"), part.column("toxic"), strict=True):
            own = {name for word in words_of(text.as_py() or "") for name in names(word)}
            found += own
            toxic += [label.as_py()] * len(own)
        return pa.RecordBatch.from_arrays(
            [pa.array(found, pa.string()), pa.array(toxic, pa.bool_())], ["name", "toxic"]
        )

    rows = sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()
    per_label = {row.toxic: row.n for row in rows}
    toxic, clean = per_label.get(True, 0), per_label.get(False, 0)
    if not toxic or not clean:
        return Scorer({})
    least_ratio = LEAST_RATIO / (clean + 0.2)
    counts = (
        batches(sample, features_of, "name string, toxic boolean")
        .groupBy("name")
        .agg(F.count_if("toxic").alias("a"), F.count_if(~F.col("toxic")).alias("b"))
        .where(F.col("a") >= max(3, LEAST_SHARE * toxic))
        .where((F.col("a") + 0.1) / (toxic + 0.2) >= least_ratio * (F.col("b") + 0.1))
        .orderBy(F.desc("a"), "name")
        .limit(MOST_FEATURES)
        .collect()
    )
    index = {row.name: i for i, row in enumerate(counts)}

    def evidence(part: pa.RecordBatch) -> pa.RecordBatch:
        """Features of each sentence that has any, sentence by sentence, for each document."""
        found, rest = [], []
        for text in part.column("text"):
            text = text.as_py() or ""
            own = [
                sorted(index[n] for word in words_of(text[a:b]) for n in names(word) if n in index)
                for a, b in sentences(text)
            ]
            found.append([features for features in own if features])
            rest.append(1 - len(found[-1]) / len(own))
        kind = pa.list_(pa.list_(pa.int32()))
        return pa.RecordBatch.from_arrays(
            [part.column("doc_id"), part.column("toxic"), pa.array(found, kind), pa.array(rest)],
            ["doc_id", "toxic", "sentences", "rest"],
        )

    rows = batches(
        sample, evidence, "doc_id bigint, toxic boolean, sentences array<array<int>>, rest double"
    )
    bags = sorted((r.toxic, r.doc_id, r.sentences, r.rest) for r in rows.collect())
    flat = [(n, features) for n, (_, _, bag, _) in enumerate(bags) for features in bag]
    if not flat:
        return Scorer({})
    all_labels = {row.toxic: row["count"] for row in known.groupBy("toxic").count().collect()}
    w, constant = train(
        np.repeat(np.arange(len(flat)), [len(features) for _, features in flat]),
        np.concatenate([features for _, features in flat]),
        np.array([label for label, *_ in bags]),
        np.array([n for n, _ in flat]),
        len(index),
        np.array([rest for *_, rest in bags]),
        (all_labels[False] / clean) / (all_labels[True] / toxic),
    )
    weights = {name: float(w[i]) for name, i in index.items() if w[i] >= LEAST_WEIGHT}
    return Scorer(weights, constant)


def score(docs: DataFrame, scorer: Scorer) -> DataFrame:
    """(doc_id, score, sentences): the score, and the places of sentences at the threshold."""

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        scores, places = [], []
        for text in part.column("text"):
            text = text.as_py() or ""
            scores.append(scorer.score(text))
            places.append(
                [
                    {"start": a, "end": b, "score": p}
                    for a, b, p in scorer.sentence_scores(text)
                    if p >= THRESHOLD
                ]
                if scores[-1] >= THRESHOLD
                else []
            )
        place = pa.list_(
            pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])
        )
        return pa.RecordBatch.from_arrays(
            [part.column("doc_id"), pa.array(scores, pa.float64()), pa.array(places, place)],
            ["doc_id", "score", "sentences"],
        )

    return batches(
        pick(docs, doc_id="bigint", text="string"),
        work,
        "doc_id bigint, score double, "
        "sentences array<struct<start: bigint, end: bigint, score: double>>",
    )
