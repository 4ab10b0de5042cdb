"""A linear-chain conditional random field over the shapes of words, in numpy."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np

KINDS = ("email", "ip", "card", "phone")
#: Outside, then the beginning and the inside of each kind.
LABELS = ("O", *(f"{at}-{kind}" for kind in KINDS for at in "BI"))
_TOKEN = re.compile(r"\S+")
_RUN = re.compile(r"[0-9]+|[^\W\d_]+")
#: Words that often stand before or inside personal data.
CUES = frozenset("at dot tel phone call fax mobile mail email card visa ip host address".split())


def tokens(line: str) -> list[tuple[int, int, str]]:
    return [(m.start(), m.end(), m.group()) for m in _TOKEN.finditer(line)]


def shape(word: str) -> str:
    """``(512)`` is ``(ddd)``, ``ab.c10@mail.org`` is ``x.xdd@x.x``; cue words stay."""
    bare = word.strip("()[]<>:.,").lower()
    if bare in CUES:
        return f"={bare}"
    if word.isalpha():
        return "x"
    return _RUN.sub(_letters, word[:200])[:24]


def _letters(run: re.Match[str]) -> str:
    """Up to three digits one by one, longer numbers by how long they are."""
    n = len(run.group())
    if not "0" <= run.group()[0] <= "9":
        return "x"
    return "d" * n if n < 4 else "q" if n == 4 else "D" if n < 14 else "E" if n < 20 else "F"


def _features(before: str, own: str, after: str) -> list[str]:
    found = [f"s:{own}", f"p:{before}", f"n:{after}", "bias"]
    found += [f"has:{c}" for c in "@+(-./:#$%" if c in own]
    found += [f"a:{own[:1]}", f"z:{own[-1:]}", f"d:{min(own.count('d'), 12)}", f"q:{own.count('q')}"]
    found += [f"pd:{before[-1:]}{own[:1]}", f"nd:{own[-1:]}{after[:1]}"]
    return found


def _allowed() -> np.ndarray:
    """Whether one label may follow another; row -1 is the start of a line."""
    size = len(LABELS)
    ok = np.ones((size + 1, size), bool)
    for to, label in enumerate(LABELS):
        if label[0] == "I":
            ok[:, to] = False
            ok[to, to] = ok[to - 1, to] = True
    return ok


@dataclass
class Tagger:
    weights: dict[str, np.ndarray]
    moves: np.ndarray  # (labels + 1, labels), the last row for the start
    _rows: dict[tuple[str, str, str], int] = field(default_factory=dict)
    _scores: list[np.ndarray] = field(default_factory=list)

    def _emission(self, key: tuple[str, str, str]) -> int:
        at = self._rows.get(key)
        if at is None:
            if len(self._rows) >= 200_000:  # a memory of shapes seen, not of the input
                self._rows.clear()
                self._scores.clear()
            at = self._rows[key] = len(self._scores)
            known = [self.weights[f] for f in _features(*key) if f in self.weights]
            self._scores.append(np.sum(known, axis=0) if known else np.zeros(len(LABELS)))
        return at

    def scores(self, words: list[str]) -> np.ndarray:
        shapes = ["^", *map(shape, words), "$"]
        keys = zip(shapes, shapes[1:], shapes[2:], strict=False)
        return np.array([self._scores[self._emission(key)] for key in keys]).reshape(
            -1, len(LABELS)
        )

    def decode(self, lines: list[list[str]], cells: int = 1 << 18) -> list[np.ndarray]:
        """The best labels of each line; lines of like length are decoded together."""
        out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(lines)
        order = sorted((i for i, line in enumerate(lines) if line), key=lambda i: -len(lines[i]))
        while order:
            longest = len(lines[order[0]])
            batch, order = order[: max(1, cells // longest)], order[max(1, cells // longest) :]
            lengths = np.array([len(lines[i]) for i in batch])
            scores = np.zeros((len(batch), longest, len(LABELS)))
            for row, i in enumerate(batch):
                scores[row, : lengths[row]] = self.scores(lines[i])
            for i, path in zip(batch, viterbi(scores, lengths, self.moves), strict=True):
                out[i] = path[: len(lines[i])]
        return out


def viterbi(scores: np.ndarray, lengths: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """Best paths through (lines, places, labels); ``lengths`` must not rise."""
    rows, longest, size = scores.shape
    best = scores[:, 0] + moves[size]
    came = np.zeros((longest, rows, size), np.int8)
    live = [int((lengths > t).sum()) for t in range(longest)]
    for t in range(1, longest):
        n = live[t]
        ways = best[:n, :, None] + moves[:size]
        came[t, :n] = ways.argmax(axis=1)
        best[:n] = ways.max(axis=1) + scores[:n, t]
    path = np.zeros((rows, longest), np.int64)
    every = np.arange(rows)
    path[every, lengths - 1] = best.argmax(axis=1)
    for t in range(longest - 1, 0, -1):
        n = live[t]
        path[:n, t - 1] = came[t, every[:n], path[:n, t]]
    return path


def labels_of(line: str, spans: list[tuple[str, int, int]]) -> list[int]:
    """The label of each token of a line with these (kind, start, end) spans."""
    out = []
    for start, end, _ in tokens(line):
        inside = next(((k, a) for k, a, b in spans if start < b and end > a), None)
        if inside is None:
            out.append(0)
        else:
            at = "B" if start <= inside[1] else "I"
            out.append(LABELS.index(f"{at}-{inside[0]}"))
    return out


def train(
    lines: list[tuple[str, list[tuple[str, int, int]]]],
    rounds: int = 100,
    rate: float = 0.15,
    penalty: float = 0.02,
) -> Tagger:
    """Weights of largest penalised likelihood, by gradient steps over the whole small table."""
    lines = [(line, spans) for line, spans in lines if tokens(line)]
    size = len(LABELS)
    forbidden = ~_allowed()
    if not lines:
        return Tagger({}, np.where(forbidden, -1e9, 0.0))
    index: dict[str, int] = {}
    longest = max(len(tokens(line)) for line, _ in lines)
    rows = len(lines)
    place: list[int] = []
    feature: list[int] = []
    gold = np.zeros((rows, longest), np.int64)
    lengths = np.zeros(rows, np.int64)
    for row, (line, spans) in enumerate(lines):
        shapes = ["^", *(shape(word) for _, _, word in tokens(line)), "$"]
        lengths[row] = len(shapes) - 2
        gold[row, : lengths[row]] = labels_of(line, spans)
        for t, key in enumerate(zip(shapes, shapes[1:], shapes[2:], strict=False)):
            for name in _features(*key):
                place.append(row * longest + t)
                feature.append(index.setdefault(name, len(index)))
    first = np.flatnonzero(np.diff(place, prepend=-1))  # where the features of a place begin
    real = np.arange(longest) < lengths[:, None]
    target = np.zeros((rows, longest, size))
    target[np.arange(rows)[:, None], np.arange(longest), gold] = real
    pairs = real[:, 1:]
    moved = np.zeros((size + 1, size))
    np.add.at(moved, (gold[:, :-1][pairs], gold[:, 1:][pairs]), 1)
    np.add.at(moved, (size, gold[:, 0]), 1)
    w, moves = np.zeros((len(index), size)), np.zeros((size + 1, size))
    state = [[np.zeros_like(p), np.zeros_like(p)] for p in (w, moves)]
    for step in range(1, rounds + 1):
        own = np.where(forbidden, -1e9, moves)
        scores = np.zeros((rows * longest, size))
        scores[np.array(place)[first]] = np.add.reduceat(w[feature], first, axis=0)
        scores = scores.reshape(rows, longest, size)
        seen, went = _expected(scores, real, own)
        slope = -penalty * w
        np.add.at(slope, feature, (target - seen).reshape(-1, size)[place])
        slopes = (
            slope,
            np.where(forbidden, 0, moved - went) - penalty * moves,
        )
        for p, g, (mean, square) in zip((w, moves), slopes, state, strict=True):
            mean += 0.1 * (g - mean)
            square += 0.01 * (g * g - square)
            p += rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    return Tagger(
        {name: w[i] for name, i in index.items()}, np.where(forbidden, -1e9, moves)
    )


def _sum(x: np.ndarray, axis: int) -> np.ndarray:
    """log of the sum of exp."""
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def _expected(
    scores: np.ndarray, real: np.ndarray, moves: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Expected labels of each place and expected moves, by forward and backward sums."""
    rows, longest, size = scores.shape
    ahead, behind = np.zeros_like(scores), np.zeros_like(scores)
    ahead[:, 0] = scores[:, 0] + moves[size]
    for t in range(1, longest):
        new = _sum(ahead[:, t - 1, :, None] + moves[:size], 1) + scores[:, t]
        ahead[:, t] = np.where(real[:, t, None], new, ahead[:, t - 1])
    total = _sum(ahead[:, -1], 1)
    went = np.zeros_like(moves)
    for t in range(longest - 1, 0, -1):
        on = real[:, t, None]
        step = moves[:size] + (scores[:, t] + behind[:, t])[:, None, :]
        both = np.exp(ahead[:, t - 1, :, None] + step - total[:, None, None])
        went[:size] += (both * on[..., None]).sum(axis=0)
        behind[:, t - 1] = np.where(on, _sum(step, 2), 0)
    seen = np.exp(ahead + behind - total[:, None, None]) * real[..., None]
    went[size] += seen[:, 0].sum(axis=0)
    return seen, went
