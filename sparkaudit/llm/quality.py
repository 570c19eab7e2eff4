"""Quality by ordinal cumulative-link regression on hashed text.

One weight vector over hashed words and word shapes is shared by all grades; ordered
thresholds turn a document's score into P(grade >= k) for every k, hence an expected
grade and a tail probability to select by.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import add_columns
from .samples import labelled

WORD_BITS, SHAPE_BITS, MEMO, SLICE_BYTES = 17, 12, 200_000, 1_000_000
_SIZE = (1 << WORD_BITS) + (1 << SHAPE_BITS) + 1  # the last one: the same word again
_CLASS = bytes(
    97 if 97 <= c <= 122 or c >= 128 else 65 if 65 <= c <= 90 else 48 if 48 <= c <= 57 else c for c in range(256)
)
_RUN = re.compile(rb"(.)\1+", re.S)


class Codes(dict):
    """Hash codes of words: low bits the lower-cased word, high bits its shape."""

    def __missing__(self, word: bytes) -> int:
        shape = _RUN.sub(rb"\1", word.translate(_CLASS))
        code = zlib.crc32(word.lower()) & ((1 << WORD_BITS) - 1) | (zlib.crc32(shape) & ((1 << SHAPE_BITS) - 1)) << WORD_BITS
        if len(self) >= MEMO:
            self.clear()
        if len(word) < 64:
            self[word] = code
        return code


def features(texts: list[str], codes: Codes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(feature, document, weight) triples; a document's weights of each family sum to at most 1."""
    found = [
        np.fromiter((codes[w] for w in text.encode("utf-8", "surrogatepass").split()), np.int64) for text in texts
    ]
    code, n = np.concatenate([*found, np.zeros(0, np.int64)]), np.array([len(c) for c in found], dtype=np.int64)
    doc = np.repeat(np.arange(len(texts)), n)
    same = np.flatnonzero((code[1:] == code[:-1]) & (doc[1:] == doc[:-1])) + 1 if len(code) else code
    index = np.concatenate([
        code & ((1 << WORD_BITS) - 1), (1 << WORD_BITS) + (code >> WORD_BITS), np.full(len(same), _SIZE - 1)
    ])
    docs = np.concatenate([doc, doc, doc[same]])
    return index, docs, 1.0 / np.maximum(n, 1)[docs]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * np.clip(x, -60, 60)))


@dataclass
class OrdinalModel:
    """Grades in order, weights and ascending thresholds (one fewer than grades)."""

    grades: list[int]
    weights: np.ndarray
    thresholds: np.ndarray

    @classmethod
    def fit(cls, texts: list[str], grades: list[int], steps: int = 250, rate: float = 0.3, ridge: float = 1e-6) -> OrdinalModel:
        """Maximum likelihood by full-batch Adam; with fewer than two grades nothing is learned."""
        levels = sorted(set(grades))
        k = len(levels)
        if k < 2:
            return cls(levels, np.zeros(_SIZE, np.float32), np.zeros(0))
        index, doc, value = features(texts, Codes())
        y = np.searchsorted(levels, grades)
        share = np.array([(y >= g).mean() for g in range(1, k)])
        first = -np.log(share / (1 - share))
        gaps = np.log(np.maximum(np.diff(first), 1e-2))
        params = np.concatenate([np.zeros(_SIZE), first[:1], gaps])
        m, v, n = np.zeros_like(params), np.zeros_like(params), len(y)
        for step in range(1, steps + 1):
            w, cut = params[:_SIZE], np.cumsum(np.concatenate([params[_SIZE : _SIZE + 1], np.exp(params[_SIZE + 1 :])]))
            score = np.bincount(doc, w[index] * value, minlength=n)
            reach = _sigmoid(score[:, None] - np.concatenate([[-np.inf], cut, [np.inf]])[None, :])
            high, low = reach[np.arange(n), y], reach[np.arange(n), y + 1]
            mass = np.maximum(high - low, 1e-9)
            by_score = 1 - high - low
            slope = np.zeros((n, k + 1))
            slope[np.arange(n), y] -= high * (1 - high) / mass
            slope[np.arange(n), y + 1] += low * (1 - low) / mass
            by_cut = slope[:, 1:k].sum(0)
            tail = np.cumsum(by_cut[::-1])[::-1]  # a gap moves every later threshold
            by_gap = tail[1:] * np.exp(params[_SIZE + 1 :])
            grad = np.concatenate([
                -np.bincount(index, by_score[doc] * value, minlength=_SIZE) / n + ridge * w, [-tail[0] / n], -by_gap / n
            ])
            m = 0.9 * m + 0.1 * grad
            v = 0.99 * v + 0.01 * grad * grad
            params = params - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        cut = np.cumsum(np.concatenate([params[_SIZE : _SIZE + 1], np.exp(params[_SIZE + 1 :])]))
        return cls(levels, params[:_SIZE].astype(np.float32), cut)

    def reach(self, texts: list[str], codes: Codes) -> np.ndarray:
        """P(grade >= k-th grade) for k = 1 .. per text."""
        index, doc, value = features(texts, codes)
        score = np.bincount(doc, self.weights[index] * value, minlength=len(texts))
        return _sigmoid(score[:, None] - self.thresholds[None, :])


def fit(
    docs: DataFrame, ratings: DataFrame, rating: str = "quality", rows_per_grade: int = 3000, max_grades: int = 16,
    text: str = "text",
) -> OrdinalModel:
    """A model from at most ``rows_per_grade`` rated documents of each grade (whole texts).

    More than ``max_grades`` different grades are refused. Without ratings the model has
    no grade and keeps every document.
    """
    found = ratings.select(F.col(rating).cast("int").alias("g")).dropna().distinct().limit(max_grades + 1).collect()
    if len(found) > max_grades:
        raise ValueError(f"{rating} has more than {max_grades} grades")
    rows = labelled(docs, ratings, rating, [(F.col("__y") == r["g"], rows_per_grade) for r in sorted(found)], text=text)
    return OrdinalModel.fit([t for t, _ in rows], [y for _, y in rows])


def grade(docs: DataFrame, model: OrdinalModel, text: str = "text", keep=None) -> DataFrame:
    """Adds ``expected_grade`` and ``tail_probability`` (that the grade is above the lowest).

    Null and empty texts have no words and get the score 0, the answer of the thresholds
    alone. A model of one grade expects that grade with tail probability 1, a model
    without grades expects null. Repeated rows are graded alike; columns called like the
    new ones are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        own, codes = shared.value, Codes()

        def mapper(texts):
            if len(own.grades) < 2:
                return [own.grades[0] if own.grades else None] * len(texts), [1.0] * len(texts)
            reach = own.reach(texts, codes)
            steps = np.diff(own.grades)
            return own.grades[0] + reach @ steps, reach[:, 0]

        return mapper

    return add_columns(docs, make, "expected_grade double, tail_probability double", text, keep, SLICE_BYTES)


def select(docs: DataFrame, model: OrdinalModel, least: float = 0.5, text: str = "text") -> DataFrame:
    """The documents whose tail probability is at least ``least``, columns unchanged."""
    plain = docs.toDF(*[f"__c{i}" for i in range(len(docs.columns))])  # no name can clash
    graded = grade(plain, model, f"__c{docs.columns.index(text)}")
    return graded.where(F.col("tail_probability") >= least).select(*plain.columns).toDF(*docs.columns)
