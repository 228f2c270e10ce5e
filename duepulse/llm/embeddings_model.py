"""Averaged subword embeddings with a linear softmax, trained by stochastic gradient descent."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from .samples import Sample


@dataclass(frozen=True)
class Settings:
    buckets: int = 1 << 16
    widths: tuple[int, ...] = (2, 3, 4)
    lower: bool = False
    pairs: bool = False
    #: Features of weight zero that every text has besides its own.
    prior: float = 20.0
    dim: int = 12
    epochs: int = 6
    rate: float = 1.0
    seed: int = 11


@dataclass
class Model:
    """``table`` holds, for each bucket, what it adds to the logits of each class."""

    classes: np.ndarray
    table: np.ndarray
    bias: np.ndarray
    temperature: float

    def probabilities(self, means: np.ndarray) -> np.ndarray:
        return softmax((means + self.bias) / self.temperature)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _share(counts: np.ndarray, prior: float) -> np.ndarray:
    return counts / max(1, counts.sum() + prior)


def _logits(sample: Sample, rows: np.ndarray, table: np.ndarray, bias: np.ndarray, prior: float) -> np.ndarray:
    means = [_share(sample.counts[i], prior) @ table[sample.buckets[i]] for i in rows]
    return np.array(means).reshape(len(rows), len(bias)) + bias


def _temperature(logits: np.ndarray, truth: np.ndarray) -> float:
    """The temperature with the least log loss on rows that the weights weren't trained on."""
    if not len(truth):
        return 1.0
    tried = np.geomspace(0.05, 20, 61)
    loss = [-np.log(np.maximum(softmax(logits / t)[np.arange(len(truth)), truth], 1e-12)).mean() for t in tried]
    return float(tried[int(np.argmin(loss))])


def train(sample: Sample, settings: Settings) -> tuple[Model, np.ndarray, np.ndarray]:
    """The model, and the calibration rows' probabilities and class numbers.

    One row in eight is kept from the gradient steps and sets the temperature.
    """
    s = settings
    classes = np.unique(sample.labels)
    truth = np.searchsorted(classes, sample.labels)
    rng = np.random.default_rng(s.seed)
    vectors = rng.uniform(-1 / s.dim, 1 / s.dim, (s.buckets, s.dim))
    weights = np.zeros((s.dim, len(classes)))
    bias = np.zeros(len(classes))
    order = rng.permutation(len(sample))
    kept, learned = order[: len(sample) // 8], order[len(sample) // 8 :]
    steps, step = max(1, s.epochs * len(learned)), 0
    for _ in range(s.epochs):
        for i in rng.permutation(learned):
            rate = s.rate * (1 - step / steps)
            step += 1
            b, share = sample.buckets[i], _share(sample.counts[i], s.prior)
            hidden = share @ vectors[b]
            error = softmax((hidden @ weights + bias)[None])[0]
            error[truth[i]] -= 1
            back = weights @ error
            weights -= rate * np.outer(hidden, error)
            bias -= 0.1 * rate * error
            # A document's buckets are distinct; the step of each is that of its own share.
            vectors[b] -= rate * len(b) ** 0.5 * share[:, None] * back
    table = vectors @ weights
    logits = _logits(sample, kept, table, bias, s.prior)
    temperature = _temperature(logits, truth[kept])
    return Model(classes, table, bias, temperature), softmax(logits / temperature), truth[kept]
