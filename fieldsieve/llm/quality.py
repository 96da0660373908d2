"""Quality classifier over random-indexing word vectors.

Every word has a sparse random index vector, derived from its spelling. A word's vector is the sum
of the index vectors of the words around it, over the labelled sample, scaled to length 1. A
document is the mean of the vectors of its words; rare words, capitals, numbers, runs of marks and
repetitions are words of their own by their shape. A two-layer network scores the pooled vector,
and a temperature fitted on rows it was not trained on turns the score into a probability.
"""

from __future__ import annotations

import random
import re
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass, field
from zlib import crc32

import numpy as np

from .labelled import sigmoid

#: Bounds of the labelled sample that a fit reads.
GOOD_SAMPLE = 2_500
BAD_SAMPLE = 2_500

DIMENSIONS = 96
INDEX_ENTRIES = 6
CONTEXT = 2
VOCABULARY = 10_000
HIDDEN = 32

_WORD = re.compile(r"\w+|[^\w\s]+")
SHAPES = ("<caps>", "<title>", "<lower>", "<digits>", "<marks>", "<mixed>", "<again>", "<long>")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text)


def shape(word: str) -> str:
    """The class a word outside the vocabulary stands in."""
    if len(word) > 24:
        return "<long>"
    if not (word[0].isalnum() or word[0] == "_"):
        return "<marks>"
    if word.isdigit():
        return "<digits>"
    if word.islower():
        return "<lower>"
    if word.isupper() and len(word) > 1:
        return "<caps>"
    return "<title>" if word.istitle() else "<mixed>"


def index_vector(word: str) -> np.ndarray:
    """A word's sparse random vector: a few places hold 1 or -1."""
    rng = random.Random(crc32(word.encode("utf-8", "surrogatepass")))
    vector = np.zeros(DIMENSIONS, dtype=np.float32)
    for place in rng.sample(range(DIMENSIONS), INDEX_ENTRIES):
        vector[place] = rng.choice((-1.0, 1.0))
    return vector


def repetitions(words: list[str]) -> int:
    """Words equal to one of the two before them."""
    if len(words) < 3:
        return int(len(words) == 2 and words[0] == words[1])
    first = int(words[1] == words[0])
    return first + sum(a == b or a == c for a, b, c in zip(words[2:], words[1:], words, strict=False))


@dataclass
class QualityModel:
    """Scores texts. Without examples of both labels every score is the examples' good share."""

    places: dict[str, int]
    vectors: np.ndarray
    layers: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)
    mean: np.ndarray | float = 0.0
    scale: np.ndarray | float = 1.0
    temperature: float = 1.0
    share: float = 0.5

    def _place(self, word: str) -> int:
        place = self.places.get(word)
        return self.places[shape(word)] if place is None else place

    def pooled(self, texts: Sequence[str]) -> np.ndarray:
        """The mean word vector of each text, with and without counting a word again, and the
        mean's length; zeros for a text without words."""
        out = np.zeros((len(texts), 2 * DIMENSIONS + 2), dtype=np.float32)
        for row, text in zip(out, texts, strict=True):
            words = words_of(text)
            if not words:
                continue
            counts: Counter = Counter()
            kinds: Counter = Counter()
            for word, n in Counter(words).items():
                place = self._place(word)
                counts[place] += n
                kinds[place] += 1
            again = repetitions(words)
            if again:
                counts[self.places["<again>"]] += again
            for at, c in ((0, counts), (DIMENSIONS, kinds)):
                n = np.fromiter(c.values(), dtype=np.float32, count=len(c))
                vectors = self.vectors[np.fromiter(c.keys(), dtype=np.int64, count=len(c))]
                row[at : at + DIMENSIONS] = n @ vectors / n.sum()
            row[-2] = again / len(words)
            row[-1] = np.log1p(len(words)) / 10
        return out

    def logits(self, pooled: np.ndarray) -> np.ndarray:
        x = (pooled - self.mean) / self.scale
        (w1, b1), (w2, b2) = self.layers
        return (np.tanh(x @ w1 + b1) @ w2 + b2)[:, 0]

    def score(self, texts: Sequence[str]) -> np.ndarray:
        if not self.layers:
            return np.full(len(texts), self.share)
        return sigmoid(self.logits(self.pooled(texts)).astype(np.float64) / self.temperature)


def word_vectors(texts: Sequence[str]) -> tuple[dict[str, int], np.ndarray]:
    """Place and vector of the most frequent words and of all shapes."""
    counts: Counter = Counter()
    for text in texts:
        counts.update(words_of(text))
    common = sorted(counts, key=lambda w: (-counts[w], w))
    kept = [w for w in common[:VOCABULARY] if counts[w] >= 5]
    places = {w: i for i, w in enumerate([*SHAPES, *kept])}
    index = np.stack([index_vector(w) for w in places])
    sums = np.zeros_like(index)
    for text in texts:
        at = np.array([places[w] if w in places else places[shape(w)] for w in words_of(text)])
        for step in range(1, CONTEXT + 1):
            if len(at) > step:
                np.add.at(sums, at[step:], index[at[:-step]])
                np.add.at(sums, at[:-step], index[at[step:]])
    sums += index  # the word itself, and all there is of a shape the sample lacks
    return places, sums / np.linalg.norm(sums, axis=1, keepdims=True)


def _train(x: np.ndarray, y: np.ndarray, rng: np.random.Generator, epochs: int = 60):
    """Two layers by Adam on the logistic loss, with both labels weighted alike."""
    sizes = [(x.shape[1], HIDDEN), (HIDDEN, 1)]
    params = []
    for a, b in sizes:
        params += [rng.standard_normal((a, b)) / np.sqrt(a), np.zeros(b)]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for at in range(0, len(order), 64):
            rows = order[at : at + 64]
            xb, yb = x[rows], y[rows]
            w1, b1, w2, b2 = params
            h = np.tanh(xb @ w1 + b1)
            error = ((sigmoid((h @ w2 + b2)[:, 0]) - yb) / len(rows))[:, None]
            back = (error @ w2.T) * (1 - h**2)
            gradients = [
                xb.T @ back + 1e-4 * w1, back.sum(axis=0), h.T @ error + 1e-4 * w2,
                error.sum(axis=0),
            ]
            step += 1
            for p, g, (m, v) in zip(params, gradients, moments, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= 0.003 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return [(params[0], params[1]), (params[2], params[3])]


def _temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature, of a fixed grid, with the least logistic loss."""
    def loss(t: float) -> float:
        p = np.clip(sigmoid(logits / t), 1e-9, 1 - 1e-9)
        return float(-(y * np.log(p) + (1 - y) * np.log(1 - p)).mean())

    return min((0.5 * 1.1**i for i in range(32)), key=loss)


def fit(examples: Sequence[tuple[str, int]], seed: int = 5) -> QualityModel:
    """Word vectors from all examples; the network from four fifths, its temperature from the rest."""
    examples = sorted(examples)
    random.Random(seed).shuffle(examples)
    texts = [t for t, _ in examples]
    y = np.array([y for _, y in examples], dtype=float)
    places, vectors = word_vectors(texts)
    model = QualityModel(places, vectors, share=(y.sum() + 0.5) / (len(y) + 1))
    if len(set(y.tolist())) < 2 or len(y) < 10:
        return model
    x = model.pooled(texts)
    model.mean, model.scale = x.mean(axis=0), x.std(axis=0) + 1e-4
    x = (x - model.mean) / model.scale
    cut = max(1, len(y) // 5)
    model.layers = _train(x[cut:], y[cut:], np.random.default_rng(seed))
    (w1, b1), (w2, b2) = model.layers
    model.temperature = _temperature((np.tanh(x[:cut] @ w1 + b1) @ w2 + b2)[:, 0], y[:cut])
    return model
