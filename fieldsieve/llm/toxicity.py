"""Toxicity by compression distance.

Two zstandard dictionaries are made, one of ordinary text and one of the toxic passages of toxic
documents. A text is cut into windows of a few words, and each window is compressed with the
ordinary dictionary and with the same dictionary continued by the toxic one. The bytes that the
toxic part saves are the window's distance; the shares of windows at or above several distances
are the text's features, and a logistic curve calibrates them to a probability.

Toxic documents are mostly ordinary text. The passages that make them toxic are found by contrast:
short character sequences of words that many more toxic than ordinary documents have. Words are
compressed with their first letters in capitals and all others small, so what begins a word is
never saved by ordinary text that has the same letters inside a word.
"""

from __future__ import annotations

import math
import random
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np

from .labelled import sigmoid

#: Bounds of the labelled sample that a fit reads.
TOXIC_SAMPLE = 2_000
ORDINARY_SAMPLE = 4_000

#: Bound of the ordinary windows that the ordinary dictionary is trained on.
ORDINARY_WINDOWS = 20_000

GRAM = 5
HEAD = 4
MARKING_Z = 6.0
WINDOW_WORDS = 4
LEVEL = 3
ORDINARY_BYTES = 32_768
TOXIC_BYTES = 4_096
DISTANCES = (2, 3, 4, 5, 6, 8)
FOLDS = 3


def headed(text: str) -> list[str]:
    """The words of a text, their first ``HEAD`` letters capital and all others small."""
    return [w[:HEAD].upper() + w[HEAD:] for w in text.lower().split()]


def windows(text: str, words: int = WINDOW_WORDS) -> list[bytes]:
    """Windows of ``words`` :func:`headed` words, blanks around each; a text without words has none.

    A word longer than 512 characters is cut, so no window is large, however long the text.
    """
    found = headed(text)
    if any(len(w) > 512 for w in found):
        found = [w[i : i + 512] for w in found for i in range(0, len(w), 512)]
    return [
        f" {' '.join(found[i : i + words])} ".encode("utf-8", "replace")
        for i in range(0, len(found), words)
    ]


def _grams(word: str) -> list[str]:
    """Sequences of a headed word and the blank after it."""
    word += " "
    return [word[i : i + GRAM] for i in range(len(word) - GRAM + 1)]


def gram_counts(texts: Sequence[str]) -> Counter:
    """How many of the texts hold each sequence."""
    counts = Counter()
    for text in texts:
        counts.update({g for w in set(headed(text)) for g in _grams(w)})
    return counts


def marking_grams(in_toxic: Counter, n: int, in_ordinary: Counter, m: int) -> set[str]:
    """Sequences whose share of ``n`` toxic documents exceeds that of ``m`` ordinary ones by a
    z-score of at least ``MARKING_Z``: a fixed one, so markers of a rare language need not match
    those of the commonest."""
    found = set()
    for gram, a in in_toxic.items():
        b = in_ordinary[gram]
        p = (a + b) / (n + m)
        if (a / n - b / m) / math.sqrt(p * (1 - p) * (1 / n + 1 / m) + 1e-12) >= MARKING_Z:
            found.add(gram)
    return found


def marked_spans(text: str, grams: set[str]) -> set[str]:
    """The parts of headed words that marking sequences cover."""
    spans = set()
    for word in set(headed(text)):
        span, end = "", -1
        for i, gram in enumerate(_grams(word)):
            if gram not in grams:
                continue
            if i <= end:
                span += gram[end - i :]
            else:
                spans.add(span)
                span = gram
            end = i + GRAM
        spans.add(span)
    return spans - {""}


def _dictionary(size: int, samples: list[bytes]) -> bytes:
    """A trained dictionary's content; of too few samples, the samples themselves."""
    import zstandard

    try:
        return zstandard.train_dictionary(size, samples).as_bytes()[-size:]
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


@dataclass
class ToxicityModel:
    """Scores texts. Without toxic or ordinary examples every score is the examples' toxic share."""

    ordinary: bytes
    toxic: bytes
    weights: np.ndarray
    mean: np.ndarray
    scale: np.ndarray

    def __post_init__(self):
        self._lengths = None

    def __getstate__(self):
        return self.__dict__ | {"_lengths": None}

    def _compressors(self):
        import zstandard

        if self._lengths is None:
            made = []
            for content in (self.ordinary, self.ordinary + self.toxic):
                data = zstandard.ZstdCompressionDict(
                    content or b" " * 8, dict_type=zstandard.DICT_TYPE_RAWCONTENT
                )
                data.precompute_compress(level=LEVEL)
                made.append(
                    zstandard.ZstdCompressor(
                        dict_data=data, level=LEVEL, write_content_size=False
                    ).compress
                )
            self._lengths = made
        return self._lengths

    def distances(self, text: str) -> list[int]:
        """Bytes saved by the toxic part, window by window."""
        plain, toxic = self._compressors()
        return [len(plain(w)) - len(toxic(w)) for w in windows(text)]

    def features(self, texts: Sequence[str]) -> np.ndarray:
        """Logarithms of how many windows reach each distance, of all windows, and the largest
        distance."""
        out = np.zeros((len(texts), len(DISTANCES) + 2))
        for row, text in zip(out, texts, strict=True):
            d = np.array(self.distances(text))
            if len(d):
                row[: len(DISTANCES)] = [np.log1p((d >= x).sum()) for x in DISTANCES]
                row[-2:] = np.log1p(len(d)), max(0, d.max())
        return out

    def score(self, texts: Sequence[str]) -> np.ndarray:
        x = (self.features(texts) - self.mean) / self.scale
        return sigmoid(x @ self.weights[:-1] + self.weights[-1])


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weights and, last, the bias of a logistic curve, by Newton's steps."""
    x1 = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x1.shape[1])
    penalty = np.full(len(w), ridge)
    penalty[-1] = 1e-6
    for _ in range(30):
        p = sigmoid(x1 @ w)
        gradient = x1.T @ (y - p) - penalty * w
        hessian = (x1 * (p * (1 - p))[:, None]).T @ x1 + np.diag(penalty + 1e-9)
        step = np.linalg.solve(hessian, gradient)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


Part = tuple[list[str], list[str], Counter, Counter]


def _part(examples: Sequence[tuple[str, int]]) -> Part:
    """Ordinary and toxic texts and the documents of either that hold each sequence."""
    texts = [[t for t, y in examples if y == label] for label in (0, 1)]
    return *texts, *map(gram_counts, texts)


def _untrained(parts: Sequence[Part], rng: random.Random) -> ToxicityModel:
    """A model with its two dictionaries and no calibration yet.

    The toxic dictionary is every marked passage once, the commonest last and so nearest; a trainer
    keeps only what repeats often and would lose the passages of rarer languages.
    """
    ordinary, toxic = ([t for part in parts for t in part[label]] for label in (0, 1))
    in_ordinary, in_toxic = (sum((part[2 + label] for part in parts), Counter()) for label in (0, 1))
    grams = marking_grams(in_toxic, len(toxic), in_ordinary, len(ordinary))
    held = Counter(span for text in toxic for span in marked_spans(text, grams))
    passages = "".join(f" {span} " for span in sorted(held, key=lambda span: (held[span], span)))
    plain = [w for text in ordinary for w in windows(text)]
    rng.shuffle(plain)
    n = len(DISTANCES) + 2
    return ToxicityModel(
        _dictionary(ORDINARY_BYTES, plain[:ORDINARY_WINDOWS]),
        passages.encode("utf-8", "replace")[-TOXIC_BYTES:],
        np.zeros(n + 1), np.zeros(n), np.ones(n),
    )


def fit(examples: Sequence[tuple[str, int]], seed: int = 3) -> ToxicityModel:
    """Dictionaries from all examples, calibrated on features of examples not seen.

    For the calibration each of ``FOLDS`` parts of the examples is scored by dictionaries made from
    the other parts. Fewer than two examples of a label give the toxic share for every text.
    """
    rng = random.Random(seed)
    examples = sorted(examples)
    rng.shuffle(examples)
    by_label = [[e for e in examples if e[1] == y] for y in (0, 1)]
    if min(map(len, by_label)) < 2:
        n = len(DISTANCES) + 2
        share = (len(by_label[1]) + 0.5) / (len(examples) + 1)
        weights = np.zeros(n + 1)
        weights[-1] = math.log(share / (1 - share))
        return ToxicityModel(b"", b"", weights, np.zeros(n), np.ones(n))

    parts = [_part(by_label[0][k::FOLDS] + by_label[1][k::FOLDS]) for k in range(FOLDS)]
    unseen, y = [], []
    for k, (ordinary, toxic, *_) in enumerate(parts):
        unseen.append(_untrained(parts[:k] + parts[k + 1 :], rng).features(ordinary + toxic))
        y += [0.0] * len(ordinary) + [1.0] * len(toxic)
    x, y = np.vstack(unseen), np.array(y)
    model = _untrained(parts, rng)
    model.mean, model.scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    model.weights = _logistic((x - model.mean) / model.scale, y)
    return model
