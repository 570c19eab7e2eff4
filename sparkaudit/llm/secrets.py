"""Secrets by pattern, and by the guess cost of values in a credential context.

The cost of a value is the cheapest way to write it as dictionary words, dates, repeats,
keyboard walks, sequences and brute-force characters, found by dynamic programming over its
prefixes. A value that follows a credential word and costs enough is a secret.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .batches import add_columns

#: The base patterns. Matches that fail the length test are dropped, not retried.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # runs are maximal, so this equals long [0-9a-f]+ matches
KINDS = ("assign", "access", "hex", "guess")

#: Words that announce a credential; what links them to a value; the value.
CONTEXT = re.compile(
    r"""(?<![A-Za-z])(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|api[ _-]?key|access[ _-]?key|private[ _-]?key"""
    r"""|credentials?|auth|bearer|login)["']?(?:[ \t]{0,3}(?::=|=>|->|[:=])|[ \t]{1,3}(?:is|was)[ \t]*:?|(?<=bearer))"""
    r"""[ \t]{0,3}["'<(]?([^\s"'<>()\[\]{},;]{6,})""",
    re.I | re.A,
)
CONTEXT_WORDS = ("pass", "pwd", "secret", "token", "key", "credential", "auth", "bearer", "login")
ROWS = ("`1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./")
LEET = str.maketrans("@4310$57", "aaeiosst")
_DATE = re.compile(r"(?:19|20)\d\d(?:[-/.]?[01]\d(?:[-/.]?[0-3]\d)?)?|[0-3]?\d[-/.][01]?\d[-/.](?:19|20)?\d\d")


def _neighbours() -> set[tuple[str, str]]:
    """Keys next to each other in a row or in the row below."""
    near = set()
    for r, row in enumerate(ROWS):
        for i, key in enumerate(row):
            for other in (row[i + 1 : i + 2], *(ROWS[r + 1][j : j + 1] for j in (i - 1, i) if r + 1 < len(ROWS) and j >= 0)):
                if other:
                    near |= {(key, other), (other, key)}
    return near


_NEAR = _neighbours()


def _brute(char: str) -> float:
    """Bits of one character guessed inside its class."""
    if char.isdigit():
        return math.log2(10)
    if char.isascii() and char.isalpha():
        return math.log2(26)
    return math.log2(33) if char.isascii() else 10.0


class GuessCost:
    """Bits to guess a value, given the ranks of known words."""

    def __init__(self, words: list[str], longest: int = 24) -> None:
        self.rank = {w: i + 1 for i, w in reversed(list(enumerate(words)))}
        self.longest = longest

    def _word(self, part: str) -> float | None:
        low = part.lower()
        plain = low.translate(LEET)
        rank = self.rank.get(low) or self.rank.get(plain)
        if rank is None:
            return None
        case = 0.0 if part == low else 1.0 if part[1:] == low[1:] or part == part.upper() else float(len(part))
        return math.log2(rank + 1) + case + (plain != low) * 2.0

    def _run(self, value: str, start: int) -> list[tuple[int, float]]:
        """Ends and bits of the repeats, sequences and keyboard walks that begin here."""
        out, n = [], len(value)
        for unit in (1, 2, 3, 4):
            piece, end = value[start : start + unit], start + unit
            while len(piece) == unit and value.startswith(piece, end):
                end += unit
                if end - start >= 3:
                    out.append((end, sum(map(_brute, piece)) + math.log2((end - start) // unit) + 1))
        for step in (1, -1):
            end = start + 1
            while end < n and value[end - 1].isalnum() and value[end].isalnum() and ord(value[end]) - ord(value[end - 1]) == step:
                end += 1
                if end - start >= 3:
                    out.append((end, _brute(value[start]) + math.log2(end - start) + 2))
        low, end, turns, last = value.lower(), start + 1, 1, None
        while end < n and (low[end - 1], low[end]) in _NEAR:
            way = ord(low[end]) - ord(low[end - 1])
            turns, last, end = turns + (last is not None and way != last), way, end + 1
            if end - start >= 4:
                out.append((end, math.log2(47) + math.log2(end - start) + 2.0 * turns))
        return out

    def bits(self, value: str) -> float:
        """Cheapest segmentation; every further segment costs one bit for the way they are combined."""
        n = len(value)
        best = [0.0] + [math.inf] * n
        for start in range(n):
            here = best[start] + (1.0 if start else 0.0)
            best[start + 1] = min(best[start + 1], best[start] + _brute(value[start]))
            for end in range(start + 3, min(n, start + self.longest) + 1):
                cost = self._word(value[start:end])
                if cost is not None:
                    best[end] = min(best[end], here + cost)
            for end, cost in self._run(value, start):
                best[end] = min(best[end], here + cost)
            for date in (_DATE.match(value, start),):
                if date:
                    best[date.end()] = min(best[date.end()], here + math.log2(365.25 * 120))
        return best[n]


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the base patterns by start, then kind; end exclusive, in code points."""
    low, out = text.lower(), []
    if any(w in low for w in ASSIGN_WORDS) or not text.isascii():
        out += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        out += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def find(text: str, cost: GuessCost, least_bits: float) -> list[tuple[str, int, int, bool, float]]:
    """Base spans and costly credential values: (kind, start, end, base, bits of the value)."""
    out = []
    for kind, start, end in base_spans(text):
        value = ASSIGN.match(text, start)[2] if kind == "assign" else text[start:end]
        out.append((kind, start, end, True, cost.bits(value)))
    low = text.lower()
    if any(w in low for w in CONTEXT_WORDS):
        taken = [(s[1], s[2]) for s in out]
        for m in CONTEXT.finditer(text):
            start, end = m.span(1)
            end -= len(m[1]) - len(m[1].rstrip(".!?:"))
            value = text[start:end]
            kinds = len({("d" if c.isdigit() else "l" if c.islower() else "u" if c.isupper() else "s") for c in value})
            if len(value) < 6 or kinds < 2 or any(a < end and start < b for a, b in taken):
                continue
            bits = cost.bits(value)
            if bits >= least_bits:
                out.append(("guess", start, end, False, bits))
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def common_words(docs: DataFrame, n: int = 30_000, text: str = "text") -> list[str]:
    """The ``n`` most frequent lower-case words of three letters or more, over all texts.

    Words are counted inside each batch first, so a frequent word is one row per batch. Words
    with less than a millionth of all counts are no common words; this bounds the last sort.
    """
    letters = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 else 32 for c in range(256))

    def count(parts):
        for part in parts:
            found = Counter()
            for t in part.column(0).to_pylist():
                found.update((t or "").encode("utf-8", "surrogatepass").translate(letters).split())
            kept = [(w.decode(), c) for w, c in found.items() if 3 <= len(w) <= 24]
            yield pa.RecordBatch.from_arrays(
                [pa.array([w for w, _ in kept], pa.string()), pa.array([c for _, c in kept], pa.int64())], names=["w", "c"]
            )

    counted = docs.select(text).mapInArrow(count, "w string, c bigint").groupBy("w").agg(F.sum("c").alias("c"))
    counted = cut_lineage(counted.where("c > 1"))
    total = counted.agg(F.sum("c")).first()[0] or 0
    often = counted.where(F.col("c") >= F.lit(total / 1e6))  # at most a million words
    return [r["w"] for r in often.orderBy(F.desc("c"), "w").limit(n).collect()]


def find_secrets(docs: DataFrame, words: list[str], least_bits: float = 45.0, text: str = "text", keep=None) -> DataFrame:
    """Adds ``secrets``: spans (kind, start, end, base, bits), by start, then kind.

    Base kinds are ``assign``, ``access`` and ``hex``; ``guess`` marks further values in
    a credential context of at least two character classes whose guess cost reaches
    ``least_bits``. Positions are code points, the end exclusive. Null and empty texts have no
    spans; repeated rows get equal ones; a column called ``secrets`` is replaced.
    ``words`` is the ranked dictionary (bounded by ``common_words``).
    """
    shared = docs.sparkSession.sparkContext.broadcast(words)

    def make():
        cost = GuessCost(shared.value)
        return lambda texts: [[
            [dict(zip(("kind", "start", "end", "base", "bits"), s)) for s in find(t, cost, least_bits)] for t in texts
        ]]

    span = "struct<kind:string,start:int,end:int,base:boolean,bits:double>"
    return add_columns(docs, make, f"secrets array<{span}>", text, keep)
