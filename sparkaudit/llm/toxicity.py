"""Toxicity by compression distance: window lengths under two zstandard dictionaries.

One dictionary is trained on ordinary text; the other holds, besides it, the words that
toxic text repeats and ordinary text does not. A window that becomes shorter with the
second one carries toxic language; thresholds are calibrated on rows the dictionaries
have not seen.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import add_columns
from .samples import labelled

WINDOW, STEP = 192, 160
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def folded(text: str) -> bytes:
    """Lower-cased words between single spaces."""
    return b" " + b" ".join(text.encode("utf-8", "surrogatepass").translate(_FOLD).split()) + b" "


def windows(data: bytes) -> list[bytes]:
    """Overlapping windows over the whole text."""
    return [data[i : i + WINDOW] for i in range(0, max(1, len(data) - (WINDOW - STEP)), STEP)]


def _stems(data: bytes) -> set[bytes]:
    return {w[:k] for w in set(data.split()) for k in range(4, 11) if len(w) >= k}


def distinctive_words(toxic: list[bytes], ordinary: list[bytes], ratio: float = 30.0, share: float = 0.03) -> list[bytes]:
    """Words of the toxic texts that begin with a stem far more common there, rarest first.

    A stem counts if at least ``share`` of the toxic texts (and four) have it, ``ratio``
    times the share among the ordinary ones.
    """
    least = max(4, int(share * len(toxic)))
    here = Counter(s for t in toxic for s in _stems(t))
    there = Counter(s for t in ordinary for s in _stems(t))
    scale = len(ordinary) / max(1, len(toxic))
    marked = {s for s, c in here.items() if c >= least and c * scale >= ratio * (there[s] + 0.5)}
    stems = {s for s in marked if not any(s[:k] in marked for k in range(4, len(s)))}
    found = Counter(w for t in toxic for w in set(t.split()) if any(w[:k] in stems for k in range(4, 11)))
    return [b" " + w for w, c in sorted(found.items(), key=lambda x: (x[1], x[0])) if c >= 2]


class Lengths:
    """Compressed length of a window under each dictionary."""

    def __init__(self, ordinary: bytes, toxic: bytes) -> None:
        self.both = []
        for content in (ordinary, toxic + ordinary):
            book = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            how = zstandard.ZstdCompressionParameters(
                window_log=14, hash_log=14, chain_log=14, search_log=4, target_length=0,
                strategy=zstandard.STRATEGY_LAZY2, min_match=6, write_content_size=0,
            )
            book.precompute_compress(compression_params=how)
            self.both.append(zstandard.ZstdCompressor(dict_data=book, compression_params=how).compress)

    def gains(self, data: bytes) -> np.ndarray:
        plain, toxic = self.both
        return np.array([len(plain(w)) - len(toxic(w)) for w in windows(data)], dtype=float)


def summary(gains: np.ndarray) -> list[float]:
    """Of a document's windows: largest and mean gain, shares above two levels, how many windows."""
    return [gains.max(), gains.mean(), (gains >= 2).mean(), (gains >= 4).mean(), np.log(len(gains))]


@dataclass
class ToxicityModel:
    ordinary: bytes
    toxic: bytes
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # the last one is the constant

    @classmethod
    def fit(cls, texts: list[str], labels: list[int], toxic_bytes: int = 1000, ordinary_bytes: int = 1500) -> ToxicityModel:
        """Dictionaries from every other row, calibration by logistic regression on the rest."""
        data = [folded(t) for t in texts]
        y = np.array(labels, dtype=int)
        rest = [np.flatnonzero(y == c) for c in (0, 1)]
        base = (len(rest[1]) + 0.5) / (len(y) + 1)
        flat = cls(b" ", b"", np.zeros(5), np.ones(5), np.array([0.0] * 5 + [np.log(base / (1 - base))]))
        if min(map(len, rest)) < 8:
            return flat
        fit_on = np.concatenate([r[::2] for r in rest])
        check_on = np.concatenate([r[1::2] for r in rest])
        common, marked = [data[i] for i in fit_on if not y[i]], [data[i] for i in fit_on if y[i]]
        words = b"".join(distinctive_words(marked, common))[-toxic_bytes:]
        try:
            trained = zstandard.train_dictionary(16384, [w for t in common for w in windows(t)], k=64, d=8).as_bytes()
        except zstandard.ZstdError:  # too little text to train on
            trained = b" ".join(common)
        model = cls(trained[-ordinary_bytes:], words, flat.mean, flat.scale, flat.weights)
        lengths = Lengths(model.ordinary, model.toxic)
        x = np.array([summary(lengths.gains(data[i])) for i in check_on])
        model.mean, model.scale = x.mean(0), np.maximum(x.std(0), 1e-6)
        z = np.column_stack([(x - model.mean) / model.scale, np.ones(len(x))])
        w, target = np.zeros(z.shape[1]), y[check_on]
        for _ in range(50):  # Newton steps with a small ridge
            p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
            hessian = (z * (p * (1 - p))[:, None]).T @ z + 1e-2 * np.eye(z.shape[1])
            w = w + np.linalg.solve(hessian, z.T @ (target - p) - 1e-2 * w)
        model.weights = w
        return model

    def scores(self, texts: list[str], lengths: Lengths) -> np.ndarray:
        x = np.array([summary(lengths.gains(folded(t))) for t in texts]).reshape(len(texts), 5)
        z = (x - self.mean) / self.scale @ self.weights[:-1] + self.weights[-1]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", toxic_rows: int = 3000, ordinary_rows: int = 5000,
    text: str = "text",
) -> ToxicityModel:
    """A model from a bounded draw of labelled documents (whole texts).

    With fewer than eight rows of a class nothing can be trained; every score is then the
    share of toxic rows.
    """
    rows = labelled(docs, labels, label, [(F.col("__y") == 1, toxic_rows), (F.col("__y") == 0, ordinary_rows)], text=text)
    return ToxicityModel.fit([t for t, _ in rows], [y for _, y in rows])


def score(docs: DataFrame, model: ToxicityModel, text: str = "text", keep=None) -> DataFrame:
    """Adds ``toxicity``, 0 to 1, from the windows of each whole text.

    Null and empty texts have one empty window. Repeated rows score alike; a column
    called ``toxicity`` is replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        own = shared.value
        lengths = Lengths(own.ordinary, own.toxic)
        return lambda texts: [own.scores(texts, lengths)]

    return add_columns(docs, make, "toxicity double", text, keep)
