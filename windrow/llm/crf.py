"""A linear-chain conditional random field over the lines of a text, with states bad and good."""

from __future__ import annotations

from dataclasses import dataclass
from math import log

import numpy as np

#: Character classes: lower case, upper case, digits, white space, sentence marks, other marks, symbols, beyond ASCII.
_GROUPS = (b"abcdefghijklmnopqrstuvwxyz", bytes(range(65, 91)), b"0123456789", b" \t\v\f\r\n", b".,;:'\"-()", None, b"#*$%&|<>{}[]\\^~_=+@")
N_CLASSES = 8
#: Features of a line by itself; with those of its neighbours there are three times as many, and one that is always 1.
OWN = N_CLASSES + 6
FEATURES = 3 * OWN + 1


def _classes() -> np.ndarray:
    table = np.full(256, 5, np.uint8)
    for name, some in enumerate(_GROUPS):
        if some:
            table[list(some)] = name
    table[0x80:] = 8  # further bytes of a character, which do not count
    table[0xC0:] = 7
    return table


_CLASS = _classes()


def features(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Feature row and length (in bytes) of each line that is not blank; of a blank text, one row.

    The neighbouring lines' own features stand beside a line's; past either end they are zero.
    """
    lines = [line for line in text.split(b"\n") if line.strip()] or [b""]
    own = np.zeros((len(lines) + 2, OWN))
    seen: set[bytes] = set()
    for row, line in zip(own[1:-1], lines, strict=True):
        words = line.split()
        counts = np.bincount(_CLASS[np.frombuffer(line, np.uint8)], minlength=N_CLASSES + 1)[:N_CLASSES]
        n_words, n_bytes = max(len(words), 1), max(len(line), 1)
        row[:N_CLASSES] = counts / n_bytes
        row[N_CLASSES:] = (
            1 - len(set(words)) / n_words,  # repeated words
            sum(map(bytes.__eq__, words, words[1:])) / n_words,  # the same word again at once
            min(n_bytes / n_words / 20, 2.0),
            np.log1p(len(words)) / 10,
            line in seen,
            line.rstrip()[-1:] in (b".", b"!", b"?"),
        )
        seen.add(line)
    rows = np.concatenate([own[1:-1], own[:-2], own[2:], np.ones((len(lines), 1))], axis=1)
    return rows, np.array([max(len(line), 1) for line in lines], float)


@dataclass(frozen=True)
class Model:
    """Weights of a line being good, of each pair of states in a row, and what turns a text's share
    of good length into a score: how well the sampled texts' labels follow from it."""

    weights: np.ndarray
    pairs: np.ndarray
    slope: float
    shift: float

    def marginals(self, rows: np.ndarray) -> np.ndarray:
        """Probability of each line being good, given all lines, by forward and backward messages."""
        return _messages(rows @ self.weights, self.pairs)[0]

    def share(self, text: bytes) -> float:
        """Mean of the lines' marginals, weighted by their length."""
        rows, lengths = features(text)
        return float(self.marginals(rows) @ lengths / lengths.sum())

    def score(self, text: bytes) -> float:
        return float(1 / (1 + np.exp(-(self.slope * self.share(text) + self.shift))))


def _messages(good: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Marginals of state good, expected counts of state pairs, and the log of the normaliser.

    ``good`` is the score of good over bad for each line; messages are kept to sum to one.
    """
    n = len(good)
    top = np.maximum(good, 0)
    state = np.stack([np.exp(-top), np.exp(good - top)], axis=1)
    step = np.exp(pairs - pairs.max())
    forward, backward = np.empty((n, 2)), np.ones((n, 2))
    (a, b), (c, d) = step.tolist()
    norm, f0, f1 = 0.0, *state[0].tolist()
    lines = state.tolist()
    for i in range(n):
        if i:
            f0, f1 = (f0 * a + f1 * c) * lines[i][0], (f0 * b + f1 * d) * lines[i][1]
        total = f0 + f1
        f0, f1, norm = f0 / total, f1 / total, norm + log(total)
        forward[i] = f0, f1
    b0 = b1 = 1.0
    for i in range(n - 2, -1, -1):
        g0, g1 = b0 * lines[i + 1][0], b1 * lines[i + 1][1]
        b0, b1 = a * g0 + b * g1, c * g0 + d * g1
        total = b0 + b1
        b0, b1 = b0 / total, b1 / total
        backward[i] = b0, b1
    both = forward * backward
    marginals = both[:, 1] / both.sum(axis=1)
    edges = forward[:-1, :, None] * step[None] * (state[1:] * backward[1:])[:, None, :]
    expected = (edges / edges.sum(axis=(1, 2), keepdims=True)).sum(axis=0) if n > 1 else np.zeros((2, 2))
    return marginals, expected, norm + top.sum() + (n - 1) * pairs.max()


def train(samples: list[tuple[np.ndarray, np.ndarray]], labels: list[int], rounds: int = 80, decay: float = 1e-3) -> Model:
    """Weights that make the labels likely, each line of a text carrying the text's label.

    Both labels weigh the same together, as do all texts of a label.  Steps are Adam's, over all
    samples at once.  With one label only every score is (all but) that label; without any, one half.
    """
    if len(set(labels)) < 2:
        return Model(np.zeros(FEATURES), np.zeros((2, 2)), 0.0, 30.0 * (sum(labels) * 2 - len(labels)) / max(len(labels), 1))
    each = [len(labels) / 2 / labels.count(y) for y in (0, 1)]
    at = np.zeros(FEATURES + 4)
    first, second = np.zeros_like(at), np.zeros_like(at)
    for turn in range(1, rounds + 1):
        gradient = decay * len(labels) * at
        for (rows, _), label in zip(samples, labels, strict=True):
            marginals, expected, _ = _messages(rows @ at[:FEATURES], at[FEATURES:].reshape(2, 2))
            weight = each[label] / len(rows)
            gradient[:FEATURES] += weight * ((marginals - label) @ rows)
            seen = np.zeros((2, 2))
            seen[label, label] = len(rows) - 1
            gradient[FEATURES:] += weight * (expected - seen).ravel()
        gradient /= len(labels)
        first, second = 0.9 * first + 0.1 * gradient, 0.99 * second + 0.01 * gradient**2
        at -= 0.3 * (first / (1 - 0.9**turn)) / (np.sqrt(second / (1 - 0.99**turn)) + 1e-8)
    plain = Model(at[:FEATURES].copy(), at[FEATURES:].reshape(2, 2).copy(), 1.0, 0.0)
    shares = np.array([plain.marginals(rows) @ lengths / lengths.sum() for rows, lengths in samples])
    return calibrated(plain, shares, labels)


def calibrated(model: Model, shares: list[float] | np.ndarray, labels: list[int]) -> Model:
    """``model`` with the slope and shift by which the labels follow best from the texts' shares of good length."""
    return Model(model.weights, model.pairs, *_logistic(np.array(shares, float), np.array(labels, float)))


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve through (x, y), by Newton's steps, kept from diverging
    by one made-up case of either label at either end."""
    x, y = np.append(x, [0, 0, 1, 1]), np.append(y, [0, 1, 0, 1])
    design, at = np.stack([x, np.ones_like(x)], axis=1), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ at, -30, 30)))
        hessian = design.T @ (design * (p * (1 - p))[:, None]) + 1e-6 * np.eye(2)
        at += np.linalg.solve(hessian, design.T @ (y - p))
    return float(at[0]), float(at[1])
