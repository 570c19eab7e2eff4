"""Personal data by pattern and by a character-level BiLSTM-CRF.

Patterns give the base spans. The tagger adds spans written in other ways; it is trained on
labelled spans that are made here (values of each kind in several spellings, in contexts
from a bounded draw of the documents, with look-alikes that are no personal data). Every
stretch of text around a digit or an at sign is cut into overlapping windows; the
posteriors of the windows are merged and decoded by one path over the whole stretch.
"""

from __future__ import annotations

import random
import re
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import add_columns, without
from .samples import drawn
from .tagger import Tagger, best_path, char_codes, pad

KINDS = ("email", "ip", "card", "phone")
#: The base patterns. A match that fails its test is dropped, not retried.
LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")  # a match begins where a run of digits does
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

#: Tagger: window and step in characters, characters of context around a trigger, posterior an added span needs.
WINDOW, STEP, CONTEXT, CERTAIN = 96, 64, 32, 0.95
TRIGGER = re.compile(r"[0-9@]|[\[({]\x20?(?:at|AT)\x20?[\])}]|\x20at\x20(?=\S{1,40}\x20dot\x20)")
_TAG = {(k, part): 1 + 2 * i + part for i, k in enumerate(KINDS) for part in (0, 1)}  # first character, further ones


def _luhn(digits: str) -> bool:
    doubled = [int(d) * 2 for d in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(d - 9 if d > 9 else d for d in doubled)) % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _valid(kind: str, text: str) -> bool:
    """The test a match of the kind must pass."""
    digits = _digits(text)
    if kind == "card":
        return 12 <= len(digits) <= 19 and _luhn(digits)
    if kind == "phone":
        return 9 <= len(digits) <= 15
    if kind == "ip":
        parts = re.findall(r"[0-9]+", text)
        return len(parts) == 4 and all(int(p[-9:]) <= 255 and len(p.lstrip("0")) <= 3 for p in parts)
    return bool(re.search(r"(?i)@|\bat\b", text) and re.search(r"(?i)\.|\bdot\b", text))


def _emails(text: str):
    """The part left of an at sign is found backwards, so long words without one cost nothing."""
    at, free = text.find("@"), 0
    while at >= 0:
        start = at
        while start > free and LOCAL.match(text[start - 1]):
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
        free = domain.end() if domain else at + 1
        at = text.find("@", free)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by start, then kind; code points, end exclusive."""
    out = [("email", a, b) for a, b in _emails(text)] if "@" in text else []
    for kind, pattern in (("ip", IP), ("card", CARD), ("phone", PHONE)):
        out += [(kind, *m.span()) for m in pattern.finditer(text) if _valid(kind, m[0])]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def _value(rng: random.Random, kind: str) -> str:
    """A made-up value in one of the spellings of its kind."""
    def number(n):
        return "".join(rng.choice("0123456789") for _ in range(n))

    def word(n=9):
        return "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, n)))

    if kind == "email":
        name = word() + rng.choice(["", "." + word(), "_" + number(2), "." + number(2), number(2)])
        host, top = rng.choice([word(), "mail" + number(1) + "." + word()]), rng.choice(["com", "org", "net", "de", "fr", "es", "io"])
        at = rng.choice(["@"] * 5 + [" @ ", "[at]", " [at] ", "(at)", " (at) ", " at "])
        dot = "." if at == "@" else rng.choice([".", " . ", "[dot]", " [dot] ", "(dot)", " (dot) ", " dot "] if at != " at " else [" dot "])
        return name + at + host + dot + top
    if kind == "ip":
        return rng.choice([".", ".", ".", " . ", "[.]", "(.)"]).join(str(rng.randint(0, 255)) for _ in range(4))
    if kind == "card":
        body = rng.choice("3456") + number(rng.choice([14, 14, 14, 13, 11]))
        digits = next(body + d for d in "0123456789" if _luhn(body + d))
        gap = rng.choice(["", "", " ", "-", ".", "  ", " - ", "_"])
        return gap.join(digits[i : i + 4] for i in range(0, len(digits), 4))
    area, left, right = number(3), number(3), number(4)
    return rng.choice([
        f"+1 ({area}) {left}-{right}", f"+{number(2)} {number(2)} {number(4)} {number(4)}", f"({area}) {left}-{right}",
        f"{area}-{left}-{right}", f"{area}.{left}.{right}", f"001 {area} {left} {right}", f"00{number(2)} {area} {number(7)}",
        f"+{number(1)}.{area}.{left}.{right}", f"({area}) {left} {right}",
    ])


def _decoy(rng: random.Random) -> str:
    """Digits and at signs that are no personal data."""
    def number(n):
        return "".join(rng.choice("0123456789") for _ in range(n))

    a, b, c = rng.randint(1, 12), rng.randint(1, 28), rng.randint(1900, 2099)
    return rng.choice([
        f"{c}-{a:02d}-{b:02d}", f"{b}/{a}/{c}", f"{a}:{b:02d}", f"v{a}.{b}.{a}", f"${number(3)},{number(3)}.{number(2)}",
        number(rng.randint(1, 8)), f"{number(2)}.{number(2)}", f"{a} at {b}", f"@{number(2)}", f"section {a}.{b}",
        "".join(rng.choice("0123456789abcdef") for _ in range(rng.choice([16, 24, 32, 40]))), f"{c}", f"x{number(9)}y{number(6)}",
        f"{number(4)}-{number(2)}", f"{number(3)} - {number(3)} - {number(2)}", f"version {a}.{b}", f"GPL {a}.0", f"CC BY {a}.0", "look at this",
    ])


def training_rows(contexts: list[str], n: int, seed: int = 3) -> list[tuple[np.ndarray, np.ndarray]]:
    """``n`` windows of (character codes, tags) with values, and decoys, set into contexts."""
    rng, rows = random.Random(seed), []
    words = [w for t in contexts for w in t.split() if not TRIGGER.search(w)] or ["a"]
    for _ in range(n):
        text, tags = "", []
        for _ in range(rng.randint(1, 3)):
            lead = " ".join(rng.choice(words) for _ in range(rng.randint(0, 4)))
            lead += rng.choice([" ", " ", " ", "\n", ": ", ", ", " | ", " ("]) if lead else ""
            kind = rng.choice(KINDS) if rng.random() < 0.6 else None
            value = _value(rng, kind) if kind else _decoy(rng)
            own = [_TAG[kind, 0]] + [_TAG[kind, 1]] * (len(value) - 1) if kind else [0] * len(value)
            tail = rng.choice([" ", " ", ". ", ", ", "\n", ") ", " | "])
            text += lead + value + tail
            tags += [0] * len(lead) + own + [0] * len(tail)
        rows.append((char_codes(text)[:WINDOW], np.array(tags[:WINDOW])))
    return rows


@lru_cache(maxsize=4)
def _trained(contexts: tuple[str, ...], rows: int, epochs: int) -> Tagger:
    tagger = Tagger.new(1 + 2 * len(KINDS))
    tagger.fit(training_rows(list(contexts), rows), epochs)
    return tagger


def fit(docs: DataFrame, contexts: int = 200, rows: int = 4000, epochs: int = 8, key: str = "doc_id", text: str = "text") -> Tagger:
    """A tagger trained on ``rows`` windows; ``contexts`` documents, drawn by hash, lend their words.

    The draw is bounded; an empty table gives windows without context.
    """
    texts = docs.select(F.col(key).alias("k"), F.col(text).alias("t")).where(F.col("t").isNotNull())
    some = drawn(texts, F.col("k"), contexts, 23).orderBy("__draw", "t").limit(contexts)
    return _trained(tuple(r["t"] for r in some.collect()), rows, epochs)


def stretches(text: str) -> list[tuple[int, int]]:
    """Pieces of text around triggers; a span of any kind has one, so no other text can hold a span."""
    out: list[list[int]] = []
    for m in TRIGGER.finditer(text):
        start, end = max(0, m.start() - CONTEXT), min(len(text), m.end() + CONTEXT)
        if out and start <= out[-1][1]:
            out[-1][1] = end
        else:
            out.append([start, end])
    return [(a, b) for a, b in out]


def _spans(tags: np.ndarray, sure: np.ndarray) -> list[tuple[int, int, int, float]]:
    """(kind number, start, end, mean posterior) of the spans of a tag path."""
    out, start = [], None
    for i, tag in enumerate([*tags.tolist(), 0]):
        goes_on = start is not None and tag == tags[start] + 1 if start is not None and tags[start] % 2 else False
        if start is not None and not goes_on:
            out.append(((int(tags[start]) - 1) // 2, start, i, float(sure[start:i].mean())))
            start = None
        if start is None and tag % 2:
            start = i
    return out


def tagged_spans(texts: list[str], tagger: Tagger, batch: int = 512) -> list[list[tuple[str, int, int, float]]]:
    """Spans the tagger finds in whole texts, windows merged by how far inside them a character lies."""
    found: list[list] = [[] for _ in texts]
    pending: list[tuple[int, int, int]] = [(d, a, b) for d, t in enumerate(texts) for a, b in stretches(t)]
    windows = [
        (s, w, min(w + WINDOW, b))
        for s, (d, a, b) in enumerate(pending)
        for w in range(a, max(a + 1, b - (WINDOW - STEP)), STEP)
    ]
    windows.sort(key=lambda x: (x[2] - x[1], x[0], x[1]))
    codes = {d: char_codes(texts[d]) for d in {d for d, _, _ in pending}}
    merged = [np.zeros((b - a, tagger.tags)) for _, a, b in pending]
    weight = [np.zeros((b - a, 1)) for _, a, b in pending]
    for start in range(0, len(windows), batch):
        part = windows[start : start + batch]
        own, _, lengths = pad([(codes[pending[s][0]][a:b], codes[pending[s][0]][a:b]) for s, a, b in part])
        for (s, a, b), p in zip(part, tagger.posteriors(own, lengths)):
            inner = np.minimum(np.arange(b - a) + 1, np.arange(b - a)[::-1] + 1)[:, None].astype(float)
            at = a - pending[s][1]
            merged[s][at : at + b - a] += inner * p[: b - a]
            weight[s][at : at + b - a] += inner
    # Posteriors already carry the transition scores; the last path only has to be a possible one.
    move = np.zeros((tagger.tags, tagger.tags))
    for tag in range(2, tagger.tags, 2):
        move[:, tag] = -1e9
        move[[tag - 1, tag], tag] = 0
    for (d, a, _), p, w in zip(pending, merged, weight):
        p = p / w
        scores = np.log(np.maximum(p, 1e-9))
        scores[0, 2::2] = -1e9
        tags = best_path(scores, move)
        for kind, start, end, sure in _spans(tags, p[np.arange(len(p)), tags]):
            value = texts[d][a + start : a + end]
            end -= len(value) - len(value.rstrip(" \n\t,;:.!?|-"))
            start += len(value) - len(value.lstrip(" \n\t,;:.!?|-"))
            if start < end:
                found[d].append((KINDS[kind], a + start, a + end, sure))
    return found


def find(texts: list[str], tagger: Tagger) -> list[list[tuple[str, int, int, bool]]]:
    """Base spans plus certain, valid tagged spans that touch no base span."""
    base = [base_spans(t) for t in texts]
    out = []
    for text, own, more in zip(texts, base, tagged_spans(texts, tagger)):
        added = [
            (k, a, b) for k, a, b, sure in more
            if sure >= CERTAIN and _valid(k, text[a:b]) and not any(x < b and a < y for _, x, y in own)
        ]
        spans = [(*s, True) for s in own] + [(*s, False) for s in added]
        out.append(sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]))))
    return out


def find_pii(docs: DataFrame, tagger: Tagger, text: str = "text", keep=None) -> DataFrame:
    """Adds ``pii``: spans (kind, start, end, base), by start, then kind.

    Positions are code points, the end exclusive. Null and empty texts have no spans;
    repeated rows get equal ones; a column called ``pii`` is replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tagger)

    def make():
        own = shared.value
        return lambda texts: [[[dict(zip(("kind", "start", "end", "base"), s)) for s in spans] for spans in find(texts, own)]]

    return add_columns(docs, make, "pii array<struct<kind:string,start:int,end:int,base:boolean>>", text, keep)


def masked(text: str, spans: list[tuple[str, int, int, bool]]) -> str:
    """Each span, or chain of overlapping spans, replaced by the upper-case kind of its first in angle brackets."""
    out, at = [], 0
    for kind, start, end, _ in spans:
        if start >= at:
            out += [text[at:start], f"<{kind.upper()}>"]
        at = max(at, end)
    return "".join(out) + text[at:]


def mask_pii(docs: DataFrame, tagger: Tagger, text: str = "text") -> DataFrame:
    """The documents with personal data masked in ``text``; columns, their order and null texts stay."""
    shared = docs.sparkSession.sparkContext.broadcast(tagger)

    def make():
        own = shared.value
        return lambda texts: [[masked(t, s) for t, s in zip(texts, find(texts, own))]]

    kept = without(docs, ["__masked"])
    made = add_columns(docs, make, "__masked string", text, kept)
    return made.select(*[
        F.when(F.col(c).isNotNull(), F.col("__masked")).alias(c) if c == text else F.col(c) for c in docs.columns
    ])
