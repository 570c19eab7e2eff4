"""Runs of words that repeat with a period, by Kruskal over descending common prefixes.

The suffixes of a text, in order, form a path whose edges weigh the longest common prefix
(LCP) of neighbours. Edges are taken by descending weight; union-find joins the classes of
suffixes at their ends, each with its positions in order. Where a union makes two
positions ``i < j`` neighbours and their distance is at most the weight, the words repeat
with period ``j - i`` from ``i`` to the end of the common prefix: a seed. The seeds with
one period and one end belong to one run, which starts at the first of them.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .batches import add_columns

SLICE_BYTES, BLOCK = 4_000_000, 1024
_ODD = np.uint64(0x9E3779B97F4A7C15)


class Positions:
    """An ordered set of positions in blocks, so that an insertion moves one block at most."""

    __slots__ = ("blocks", "tops", "size")

    def __init__(self, first: int):
        self.blocks, self.tops, self.size = [[first]], [first], 1

    def __iter__(self):
        return (x for block in self.blocks for x in block)

    def add(self, x: int) -> None:
        at = min(bisect_left(self.tops, x), len(self.tops) - 1)
        block = self.blocks[at]
        block.insert(bisect_left(block, x), x)
        self.size += 1
        if len(block) > 2 * BLOCK:
            self.blocks[at : at + 1] = [block[:BLOCK], block[BLOCK:]]
            self.tops[at : at + 1] = [block[BLOCK - 1], block[-1]]
        else:
            self.tops[at] = block[-1]

    def around(self, x: int) -> tuple[int, int]:
        """The positions before and after a member, -1 where there is none."""
        at = bisect_left(self.tops, x)
        block = self.blocks[at]
        i = bisect_left(block, x)
        before = block[i - 1] if i else self.blocks[at - 1][-1] if at else -1
        after = block[i + 1] if i + 1 < len(block) else self.blocks[at + 1][0] if at + 1 < len(self.blocks) else -1
        return before, after


def suffix_neighbours(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array by doubling, and the LCP of each suffix with the next in order."""
    n = len(words)
    rank = np.unique(words, return_inverse=True)[1].astype(np.int64)
    ranks, width = [rank], 1
    while width < n and rank.max() < n - 1:
        after = np.zeros(n, np.int64)
        after[:-width] = rank[width:] + 1
        rank = np.unique(rank * (n + 1) + after, return_inverse=True)[1]
        ranks.append(rank)
        width *= 2
    order = np.argsort(rank, kind="stable")
    a, b = order[:-1].copy(), order[1:].copy()
    common = np.zeros(max(n - 1, 0), np.int64)
    for k in range(len(ranks) - 1, -1, -1):
        step = 1 << k
        # equal ranks of `step` words may stand for two text ends only if the suffixes are equal, which they are not
        inside = (a + step <= n) & (b + step <= n)
        same = np.zeros(len(a), bool)
        same[inside] = ranks[k][a[inside]] == ranks[k][b[inside]]
        common[same] += step
        a[same] += step
        b[same] += step
    return order, common


def least_common(min_length: int, min_exponent: int) -> int:
    """The least LCP of two positions one period apart at the start of a wanted run."""
    return max(1, min_length - min_length // min_exponent)


def find_runs(words: np.ndarray, min_length: int = 24, min_exponent: int = 3) -> list[tuple[int, int, int]]:
    """(start, length, smallest period) of all maximal runs of at least ``min_length`` words and ``min_exponent`` periods.

    A run of length L and period q has suffixes with L - q common words q apart, and
    L - q is at least L (1 - 1 / min_exponent): lighter edges are never needed. Exponents
    below 2 are refused, as the seeds are complete from two periods on.
    """
    if min_exponent < 2:
        raise ValueError("min_exponent is at least 2")
    if len(words) < max(min_length, min_exponent):
        return []
    least = least_common(min_length, min_exponent)
    order, common = suffix_neighbours(words)
    heavy = np.flatnonzero(common >= least)
    heavy = heavy[np.argsort(-common[heavy], kind="stable")]
    above: dict[int, int] = {}
    members: dict[int, Positions] = {}

    def top(x: int) -> int:
        root = x
        while (up := above.get(root, root)) != root:
            root = up
        while above.get(x, x) != root:
            above[x], x = root, above.get(x, x)
        return root

    first_of: dict[tuple[int, int], int] = {}
    for i, j, weight in zip(order[heavy].tolist(), order[heavy + 1].tolist(), common[heavy].tolist()):
        small, large = top(i), top(j)
        small_set = members.pop(small, None) or Positions(small)
        large_set = members.pop(large, None) or Positions(large)
        if small_set.size > large_set.size:
            small, large, small_set, large_set = large, small, large_set, small_set
        above[small] = large
        members[large] = large_set
        moved = list(small_set)
        for x in moved:
            large_set.add(x)
        own = set(moved)
        for x in moved:
            before, after = large_set.around(x)
            for low, high in ((before, x), (x, after)):
                other = low if high == x else high
                if other < 0 or other in own:
                    continue
                if high - low <= weight:
                    key = (high - low, high + weight)
                    first_of[key] = min(first_of.get(key, low), low)
    found = []
    for (period, end), start in first_of.items():
        length = end - start
        if length >= max(min_length, min_exponent * period):
            found.append((start, length, period))
    return sorted(found, key=lambda r: (r[0], r[2]))


def kept_words(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which words stay when every run is cut to its first period."""
    change = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change[:-1]) == 0


def with_repeats(words: np.ndarray, sizes: np.ndarray, window: int) -> np.ndarray:
    """Numbers of the texts that may hold one window of words twice (by hash: never too few)."""
    if len(words) < window:
        return np.zeros(0, np.int64)
    keys, width = (words.astype(np.uint64) + np.uint64(1)) * _ODD, 1
    while 2 * width <= window:
        keys = _joined(keys[:-width], keys[width:])
        width *= 2
    if width < window:
        keys = _joined(keys[: len(words) - window + 1], keys[window - width : len(words) - width + 1])
    text = np.repeat(np.arange(len(sizes)), sizes)
    inside = text[: len(keys)] == text[window - 1 :]
    keys, text = keys[inside], text[: len(inside)][inside]
    keys = _joined(keys, text.astype(np.uint64))
    order = np.argsort(keys, kind="stable")
    return np.unique(text[order[1:]][keys[order[1:]] == keys[order[:-1]]])


def _joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = (a ^ (a >> np.uint64(29))) * _ODD + b
    return (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def periodic_runs(
    docs: DataFrame, min_length: int = 24, min_exponent: int = 3, text: str = "text", keep=None,
) -> DataFrame:
    """Adds ``n_words``, ``runs`` (start, length, period in words, by start, then period) and ``collapsed``.

    Words are what stands between ASCII white space; a run is a maximal stretch of words
    with its smallest period. ``collapsed`` is the text's words, single spaces between,
    without those that any run holds after its first period. Null and empty texts have no
    words, no runs and an empty ``collapsed``; repeated rows get equal results; columns
    called like the new ones are replaced. A map without shuffle: memory follows one slice
    of texts, or one text that is longer. Only texts that hold a window of words twice, as
    every run must, are given a suffix array.
    """
    window = least_common(min_length, min_exponent)
    spans = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def make():
        def mapper(texts):
            numbers = _Numbers()
            words = [t.encode("utf-8", "surrogatepass").split() for t in texts]
            sizes = np.array([len(w) for w in words], np.int64)
            flat = np.array([numbers[w] for own in words for w in own], np.int64)
            ends = np.cumsum(sizes)
            runs: list = [[]] * len(texts)
            for i in with_repeats(flat, sizes, window).tolist():
                runs[i] = find_runs(flat[ends[i] - sizes[i] : ends[i]], min_length, min_exponent)
            left = [
                b" ".join([w for w, stays in zip(own, kept_words(len(own), r)) if stays] if r else own)
                for own, r in zip(words, runs)
            ]
            return (
                sizes,
                pa.array([[{"start": s, "length": n, "period": p} for s, n, p in r] for r in runs], type=spans),
                [t.decode("utf-8", "surrogatepass") for t in left],
            )

        return mapper

    fields = "n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"
    return add_columns(docs, make, fields, text, keep, SLICE_BYTES)
