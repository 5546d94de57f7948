"""Quality classifier: supervised subword embeddings.

A document is the average of the hashed vectors of its words, of their character 3-grams, and of a
vector for each word that repeats the one before it; softmax over two classes; all vectors are
learned by numpy stochastic gradient descent. Scoring folds vectors and output layer into one
number for each feature, so a document costs one lookup for each word.
"""

from __future__ import annotations

import math
from collections import Counter
from operator import eq
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carestay.llm.store import map_arrow, strings
from carestay.llm.toxicity import is_held_out, labelled_sample

#: Labelled rows that the classifier is fitted on, at most (taken by hash order of doc_id).
FIT_ROWS = 4_000
BUCKETS = 1 << 17
#: The bucket of "same word again", beside the hashed ones.
AGAIN = BUCKETS
DIMENSIONS = 8
EPOCHS = 4
CACHE_WORDS = 300_000


def word_features(word: str) -> list[int]:
    """Buckets of a word and of the character 3-grams of the word between boundary marks."""
    raw = word.encode()
    marked = b"<" + raw + b">"
    return [crc32(raw, 1) % BUCKETS, *[crc32(marked[i:i + 3]) % BUCKETS for i in range(len(marked) - 2)]]


def repeats(words: list[str]) -> int:
    """How many words equal the one before them."""
    return sum(map(eq, words, words[1:]))


def bag(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct feature buckets of a whole text and their shares."""
    words = text.split()
    counts: Counter = Counter()
    for word, n in Counter(words).items():
        for f in word_features(word):
            counts[f] += n
    if again := repeats(words):
        counts[AGAIN] = again
    ids = np.fromiter(counts.keys(), np.int32, len(counts))
    shares = np.fromiter(counts.values(), np.float32, len(counts))
    return ids, shares / max(1.0, float(shares.sum()))


class QualityModel:
    """One number for each feature and a bias; scores texts."""

    def __init__(self, folded: np.ndarray, bias: float):
        self.folded, self.bias = folded.tolist(), bias
        self.cache = _Sums(self)

    def score(self, text: str) -> float:
        words = text.split()
        if len(self.cache) > CACHE_WORDS:
            self.cache.clear()
        # real part: sum of the features' numbers; imaginary part: how many features
        total = sum(map(self.cache.__getitem__, words), 0j)
        if again := repeats(words):
            total += complex(self.folded[AGAIN] * again, again)
        z = self.bias + (total.real / total.imag if total.imag else 0.0)
        return 1.0 / (1.0 + math.exp(-max(-60.0, min(60.0, z))))

    def __getstate__(self):
        return {"folded": self.folded, "bias": self.bias}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self.cache = _Sums(self)


class _Sums(dict):
    """word → sum of its features' numbers + i · their count, made when first asked for."""

    def __init__(self, model: QualityModel):
        super().__init__()
        self.folded = model.folded

    def __missing__(self, word: str) -> complex:
        found = word_features(word)
        folded = self.folded
        made = self[word] = complex(sum([folded[f] for f in found]), len(found))
        return made


def train(sample: list[tuple[str, int]], seed: int = 7, rate: float = 2.0) -> QualityModel:
    """Plain stochastic gradient descent, one document at a time, the rate falling linearly to zero.

    Without rows of both classes the result scores every text with the smoothed share of class 1.
    """
    positive = sum(y for _, y in sample)
    bias0 = math.log((positive + 1) / (len(sample) - positive + 1))
    if positive in (0, len(sample)):
        return QualityModel(np.zeros(BUCKETS + 1), bias0)
    rng = np.random.default_rng(seed)
    vectors = ((rng.random((BUCKETS + 1, DIMENSIONS)) - 0.5) / DIMENSIONS).astype(np.float32)
    output = np.zeros((2, DIMENSIONS), np.float32)
    bias = np.array([0.0, bias0], np.float32)
    bags = [bag(t) for t, _ in sample]
    steps, at = EPOCHS * len(sample), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(sample)):
            ids, shares = bags[i]
            lr = rate * (1 - at / steps)
            at += 1
            hidden = shares @ vectors[ids]
            z = output @ hidden + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[sample[i][1]] -= 1.0  # the gradient of the loss in z
            back = output.T @ p
            output -= lr * np.outer(p, hidden)
            bias -= 0.05 * lr * p
            vectors[ids] -= lr * shares[:, None] * back * len(ids) ** 0.5
    weight = (output[1] - output[0]).astype(np.float64)
    return QualityModel(vectors.astype(np.float64) @ weight, float(bias[1] - bias[0]))


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> QualityModel:
    """Fit on labelled rows whose crc32(doc_id as text) mod 5 is not 0: a sample of at most ``fit_rows`` whole texts."""
    sample = labelled_sample(docs, labels, "quality", ~is_held_out(F.col("doc_id"), 5, 0), fit_rows)
    return train([(t, int(y == 1)) for t, y in sample])


def score(docs: DataFrame, model: QualityModel) -> DataFrame:
    """(doc_id, score) of each row's whole text: the probability of class 1. Null and empty texts score by the bias alone."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2**17 numbers

    def run(batch: pa.RecordBatch):
        m = shared.value
        return batch.column(0), [m.score(t) for t in strings(batch.column(1))]

    return map_arrow(docs.select(F.col("doc_id").cast("long"), F.col("text")), run, "doc_id long, score double")
