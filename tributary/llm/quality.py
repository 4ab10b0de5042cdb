"""Quality rules: statistics of each text, judged by an isolation forest.

Every text is reduced to a few counts (``statistics``). Two base rules reject a document
outright. For the others, isolation forests are fitted on the statistics of a bounded
sample, one on each statistic and one on all of them: the fewer random cuts set a document
apart, the higher its score. The score from which a forest rejects is calibrated on all rows
labelled good or bad, whose scores are summed in bins, and a forest that finds no bad rows, or only together with good
ones, rejects nothing.

Defined results: a null text is an empty one; an empty text has no words, fails the base
rules and is not kept; repeated rows are judged one by one and get equal verdicts; an
empty table gives an empty result. Without labelled rows of both kinds nothing but the
base rules rejects. A document with several labels counts as bad if one of them says so. Columns beside
the ones named are ignored, whatever they are called.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.tables import batches, each_row, pick, place, sampled, stored

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = b"#*$%&|<>"
_SPACE = b" \t\n\v\f\r"
_UPPER = bytes(range(65, 91))

COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_upper", "n_exclaim", "n_chars",
)


def repeat_words(words: list[bytes]) -> int:
    """Words that lie in a window of three words found at least twice."""
    n = len(words)
    if n < 4:
        return 0
    first: dict[bytes, int] = {}
    ids = np.fromiter(map(first.setdefault, words, range(n)), np.int64, n)
    if n >= 1 << 20:  # three ids no longer fit one integer: number them densely, then pairs
        ids = np.unique(ids, return_inverse=True)[1]
        pairs = np.unique(ids[:-1] * n + ids[1:], return_inverse=True)[1]
        keys = pairs[:-1] * n + ids[2:]
    else:
        keys = (ids[:-2] * n + ids[1:-1]) * n + ids[2:]
    ordered = np.sort(keys)
    if not (ordered[1:] == ordered[:-1]).any():
        return 0
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = twice.copy()
    covered[1:] |= twice[:-1]
    covered[2:] |= twice[:-2]
    return int(covered.sum())


def statistics(text: str | None) -> tuple[int, ...]:
    """The counts of one text, in the order of ``COUNTS``."""
    text = text or ""
    raw = text.encode()
    words = raw.split()
    lines = text.split("\n")
    seen: set[str] = set()
    filled = dup = 0
    for line in lines:
        if line.strip(" \t\v\f\r"):
            filled += 1
            if line in seen:
                dup += 1
            seen.add(line)

    def count(of: bytes) -> int:
        return len(raw) - len(raw.translate(None, of))

    return (
        len(words), len(text) - count(_SPACE), count(SYMBOLS), dup, repeat_words(words),
        filled, count(_UPPER), raw.count(b"!"), len(text),
    )


def base_failed(counts: np.ndarray) -> np.ndarray:
    words, repeated = counts[:, 0], counts[:, 4]
    return (words < MIN_WORDS) | (100 * repeated > MAX_REPEAT_PERCENT * words)


def features(counts: np.ndarray) -> np.ndarray:
    """Shares in place of counts, so that long and short texts compare."""
    words, chars, symbols, dup, repeated, lines, upper, exclaim, _ = (
        counts.astype(np.float64).T
    )
    letters = np.maximum(chars, 1)
    return np.stack(
        [
            symbols / letters,
            dup / np.maximum(lines, 1),
            repeated / np.maximum(words, 1),
            upper / letters,
            exclaim / letters,
            chars / np.maximum(words, 1),
        ],
        axis=1,
    )


def _average_path(n: np.ndarray | float) -> np.ndarray:
    """Mean depth of an unsuccessful search in a binary tree of ``n`` rows."""
    n = np.maximum(np.asarray(n, np.float64), 1)
    path = 2 * (np.log(np.maximum(n - 1, 1)) + np.euler_gamma) - 2 * (n - 1) / n
    return np.where(n > 2, path, np.where(n == 2, 1.0, 0.0))


@dataclass
class Forest:
    """Trees as arrays; node ``i`` of a tree has the children ``2i + 1`` and ``2i + 2``."""

    feature: np.ndarray  # (trees, nodes), -1 at a leaf
    cut: np.ndarray
    path: np.ndarray  # depth plus the average path of the rows left at a leaf
    rows: int

    def scores(self, x: np.ndarray) -> np.ndarray:
        """From 0 to 1; the fewer cuts isolate a row, the higher."""
        if not len(x):
            return np.zeros(0)
        total = np.zeros(len(x))
        every = np.arange(len(x))
        for feature, cut, path in zip(self.feature, self.cut, self.path, strict=True):
            node = np.zeros(len(x), np.int64)
            while True:
                f = feature[node]
                inner = f >= 0
                if not inner.any():
                    break
                right = x[every, np.maximum(f, 0)] >= cut[node]
                node = np.where(inner, 2 * node + 1 + right, node)
            total += path[node]
        return np.exp2(-total / len(self.feature) / _average_path(self.rows))


def fit_forest(x: np.ndarray, trees: int = 100, rows: int = 256, seed: int = 42) -> Forest:
    """Each tree cuts a random subset at random values until rows are alone or depth is spent."""
    rng = np.random.default_rng(seed)
    rows = min(rows, len(x))
    depth = max(1, int(np.ceil(np.log2(max(rows, 2)))))
    nodes = 2 ** (depth + 1) - 1
    feature = np.full((trees, nodes), -1)
    cut = np.zeros((trees, nodes))
    path = np.zeros((trees, nodes))
    for t in range(trees):
        stack = [(0, 0, x[rng.choice(len(x), rows, replace=False)])]
        while stack:
            node, level, own = stack.pop()
            path[t, node] = level + _average_path(len(own))
            low, high = own.min(axis=0), own.max(axis=0)
            wide = np.flatnonzero(high > low)
            if level == depth or len(own) < 2 or not len(wide):
                continue
            f = rng.choice(wide)
            at = rng.uniform(low[f], high[f])
            if at <= low[f]:
                at = high[f]
            feature[t, node], cut[t, node] = f, at
            right = own[:, f] >= at
            stack += [(2 * node + 1, level + 1, own[~right]), (2 * node + 2, level + 1, own[right])]
    return Forest(feature, cut, path, max(rows, 2))


#: Labelled documents from which forests are made, at most.
SAMPLE_ROWS = 8192
#: Bins of scores from which the thresholds are made, for each forest.
BINS = 1 << 14
#: A threshold pays for each good document that it costs with this many bad ones.
GOOD_WORTH = 50


@dataclass
class Rules:
    """Forests, the statistics that each looks at, and the score from which each rejects."""

    parts: list[tuple[list[int], Forest, float]]

    def rejects(self, counts: np.ndarray) -> np.ndarray:
        out = base_failed(counts)
        x = features(counts)
        for columns, forest, threshold in self.parts:
            out |= forest.scores(x[:, columns]) >= threshold
        return out


def _threshold(good: np.ndarray, bad: np.ndarray, low: np.ndarray, high: np.ndarray) -> float:
    """The score at which the bad rows caught outweigh the good rows lost most.

    Rows of both kinds, lowest and highest score of each bin that has rows, by falling score.
    """
    gain = np.cumsum(bad - GOOD_WORTH * good)
    at = int(np.argmax(gain)) if len(gain) else 0
    if not len(gain) or gain[at] <= 0:
        return np.inf
    return float((low[at] + high[at + 1]) / 2) if at + 1 < len(gain) else float(low[at])


def fit_forests(counts: np.ndarray, seed: int = 42) -> list[tuple[list[int], Forest]]:
    """A forest on each statistic and one on all of them."""
    if not len(counts):
        return []
    x = features(counts)
    every = list(range(x.shape[1]))
    return [
        (columns, fit_forest(x[:, columns], seed=seed)) for columns in [*([i] for i in every), every]
    ]


def calibrated(labelled: DataFrame, forests: list[tuple[list[int], Forest]]) -> Rules:
    """The forests with thresholds from all labelled rows, (counts, bad)."""

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        x = features(np.stack([part.column(name).to_numpy() for name in COUNTS], axis=1))
        bad = part.column("bad").to_numpy(zero_copy_only=False).astype(bool)
        out = []
        for i, (columns, forest) in enumerate(forests):
            scores = forest.scores(x[:, columns])
            bins, at = np.unique((scores * BINS).astype(np.int64), return_inverse=True)
            low, high = np.full(len(bins), np.inf), np.full(len(bins), -np.inf)
            np.minimum.at(low, at, scores)
            np.maximum.at(high, at, scores)
            n = [np.bincount(at[own], minlength=len(bins)) for own in (~bad, bad)]
            out.append([np.full(len(bins), i), bins, *n, low, high])
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(column)) for column in zip(*out, strict=True)],
            ["part", "bin", "good", "bad", "low", "high"],
        )

    kind = "part bigint, bin bigint, good bigint, bad bigint, low double, high double"
    rows = (
        batches(labelled.select(*COUNTS, "bad"), work, kind)
        .groupBy("part", "bin")
        .agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"),
             F.min("low").alias("low"), F.max("high").alias("high"))
        .toPandas()
        .sort_values("bin", ascending=False)
    )
    parts = []
    for i, (columns, forest) in enumerate(forests):
        own = rows[rows["part"] == i]
        if not own["good"].sum() or not own["bad"].sum():
            return Rules([])
        threshold = _threshold(*(own[name].to_numpy() for name in ("good", "bad", "low", "high")))
        if np.isfinite(threshold):
            parts.append((columns, forest, threshold))
    return Rules(parts)


_STATS = "doc_id bigint, " + ", ".join(f"{name} bigint" for name in COUNTS)


def _counts(texts: pa.Array) -> np.ndarray:
    rows = [statistics(x.as_py()) for x in texts]
    return np.array(rows, np.int64).reshape(len(rows), len(COUNTS))


def _columns(counts: np.ndarray) -> list[pa.Array]:
    return [pa.array(column) for column in counts.T]


def fit_rules(
    docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, seed: int = 42
) -> Rules:
    """Rules with forests from at most ``sample_rows`` labelled documents, chosen by a hash of
    their id, and thresholds from all of them.

    Rows that repeat an id and its counts are one document, however many they are; of rows
    that repeat an id with other counts one is in the sample and all count for thresholds.
    """
    order = F.xxhash64(F.lit(seed), "doc_id")
    known = (
        pick(labels, doc_id="bigint", quality="int")
        .where("doc_id is not null and quality is not null")
        .groupBy("doc_id")
        .agg((F.min("quality") == 0).alias("bad"))
    )

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        counts = _counts(part.column("text"))
        rows = pa.RecordBatch.from_arrays(
            [part.column("doc_id"), *_columns(counts)], ["doc_id", *COUNTS]
        )
        return rows.filter(pa.array(~base_failed(counts)))

    # Texts become counts before the join, so that no text is shuffled.
    texts = pick(docs, doc_id="bigint", text="string").where("doc_id is not null")
    labelled = stored(batches(texts, work, _STATS).distinct().join(known, "doc_id"), "labelled")
    one_each = labelled.groupBy("doc_id").agg(F.min(F.struct(*COUNTS)).alias("counts"))
    sample = sampled(one_each.select("doc_id", "counts.*"), order, sample_rows).toPandas()
    return calibrated(labelled, fit_forests(sample[list(COUNTS)].to_numpy(np.int64), seed))


def judge(docs: DataFrame, rules: Rules) -> DataFrame:
    """The counts of every document, whether a base rule fails, and whether it is kept."""

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        counts = _counts(part.column("text"))
        return pa.RecordBatch.from_arrays(
            [
                part.column("doc_id"),
                *_columns(counts),
                pa.array(base_failed(counts)),
                pa.array(~rules.rejects(counts)),
            ],
            ["doc_id", *COUNTS, "base_failed", "kept"],
        )

    return batches(
        pick(docs, doc_id="bigint", text="string"),
        work,
        _STATS + ", base_failed boolean, kept boolean",
    )


def keep_good(docs: DataFrame, rules: Rules) -> DataFrame:
    """The documents that the rules keep, with all their columns."""
    text = int(place(docs, "text")[1:])

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        return part.filter(pa.array(~rules.rejects(_counts(part.column(text)))))

    return each_row(docs, work)
