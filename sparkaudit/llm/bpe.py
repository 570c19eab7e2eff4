"""Byte-level BPE by per-prefix dynamic programming, and the way back.

The encoding of a prefix has exactly one last token. For every prefix of a
pre-token the tokens that end there come from a suffix automaton over the vocabulary; the
one whose predecessor is *compatible* (the pair is what BPE makes of the joined bytes)
is stored, and back-pointers give the ids. No merge loop runs over the text.
"""

from __future__ import annotations

import json
import re
import struct
from array import array
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import regex
from pyspark.sql import DataFrame

from .batches import add_columns

#: White space of the Unicode property and the public pre-token pattern of this vocabulary.
SPACE = "\\t\\n\\x0b\\x0c\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
PRE_TOKEN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"

#: Pieces up to this many characters are remembered, up to this many at a time (those not asked for go first); as many pairs, too.
MEMO_CHARS, MEMO_PIECES = 48, 300_000
#: Two ids, or a rank and an id, are one number, the first above so many bits: every worker holds tens of thousands of them.
PAIR = 24
_SECOND = (1 << PAIR) - 1


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in the vocabulary file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in plain}
    rest = [b for b in range(256) if b not in set(plain)]
    letters.update({chr(256 + i): b for i, b in enumerate(rest)})
    return letters


@dataclass
class Vocabulary:
    """Token bytes by id, rank and merged id by pair of ids (see PAIR), and special strings."""

    tokens: list[bytes]
    merges: dict[int, int]
    special: dict[str, int] = field(default_factory=dict)

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        """From a byte-level BPE file of the public tokenizers."""
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters, ids = byte_letters(), spec["model"]["vocab"]
        special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        tokens = [b""] * (1 + max([*ids.values(), *special.values()]))
        for word, i in ids.items():
            tokens[i] = bytes(letters[c] for c in word)
        for word, i in special.items():
            tokens[i] = word.encode()
        if len(tokens) > _SECOND:
            raise ValueError(f"more than {_SECOND} token ids")
        merges = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            merges[ids[left] << PAIR | ids[right]] = rank << PAIR | ids[left + right]
        return cls(tokens, merges, special)


class Encoder:
    """Exact ids of texts; memory is bounded by the vocabulary and the memo limits."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        self.lengths = [len(t) for t in vocabulary.tokens]
        self.single = {t: i for i, t in enumerate(vocabulary.tokens) if len(t) == 1}
        self.halves = {merged & _SECOND: pair for pair, merged in reversed(vocabulary.merges.items())}
        special = set(vocabulary.special.values())
        usable = [i for i, t in enumerate(vocabulary.tokens) if t and i not in special]
        self.alone = {i for i in usable if i not in self.halves} | {i for i in self.halves if self._holds(i)}
        self.whole = {vocabulary.tokens[i]: i for i in self.alone}
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for i in usable:
            self.automaton.add_word(vocabulary.tokens[i].decode("latin-1"), i)
        self.automaton.make_automaton()
        self.pre_token = regex.compile(PRE_TOKEN)
        self.piece = re.compile(rf"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
        self.split = re.compile("(" + "|".join(map(re.escape, vocabulary.special)) + ")") if vocabulary.special else None
        self.fits: dict[int, dict[int, bool]] = {}
        self.n_fits = 0
        self.edges: tuple[dict[int, array], dict[int, array]] = ({}, {})
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def forget(self) -> None:
        """Drops what was remembered, so that an idle worker holds the vocabulary alone."""
        self.memo.clear()
        self.older.clear()
        self.fits.clear()
        self.n_fits = 0
        for edges in self.edges:
            edges.clear()

    def merged(self, data: bytes) -> list[int]:
        """Plain merging by rank; only ever applied to the bytes of one token."""
        ids = [self.single[data[i : i + 1]] for i in range(len(data))]
        merges = self.vocabulary.merges
        while len(ids) > 1:
            pairs = [a << PAIR | b for a, b in zip(ids, ids[1:])]
            found = [(merges[p], i) for i, p in enumerate(pairs) if p in merges]
            if not found:
                break
            new, at = min(found)
            ids[at : at + 2] = [new & _SECOND]
        return ids

    def _holds(self, token: int) -> bool:
        return self.merged(self.vocabulary.tokens[token]) == [token]

    def edge(self, token: int, right: bool) -> array:
        """Nodes along the left or right side of a token's merge tree, each followed by the rank that ends it."""
        found = self.edges[right].get(token)
        if found is None:
            found, node, ends = array("q"), token, 1 << 30
            while True:
                found.append(node)
                found.append(ends)
                pair = self.halves.get(node)
                if pair is None:
                    break
                ends = self.vocabulary.merges[pair] >> PAIR
                node = pair & _SECOND if right else pair >> PAIR
            self.edges[right][token] = found
        return found

    def compatible(self, left: int, right: int) -> bool:
        """Whether BPE of the joined bytes is exactly these two tokens.

        Both grow on their own until some merge joins a node of the left token's right
        edge with one of the right token's left edge while both still stand; of equal
        ranks the one further left comes first.
        """
        merges = self.vocabulary.merges
        of_left, of_right = self.edge(left, True), self.edge(right, False).tolist()
        nodes, ends = of_right[::2], of_right[1::2]
        for x, x_ends in zip(of_left[::2], of_left[1::2]):
            first = x << PAIR
            for y, y_ends in zip(nodes, ends):
                joined = merges.get(first | y)
                if joined is not None and joined >> PAIR < x_ends and joined >> PAIR <= y_ends:
                    return False
        return True

    def pre_token_ids(self, data: bytes) -> list[int]:
        """Last token of every prefix, then the back-pointers from the end."""
        last = [-1] * (len(data) + 1)
        fits, alone, lengths, solved = self.fits, self.alone, self.lengths, -1
        for end, token in self.automaton.iter(data.decode("latin-1")):
            if end == solved:
                continue
            start = end + 1 - lengths[token]
            if start:
                left = last[start]
                if left < 0:
                    continue
                after = fits.get(left)
                if after is None:
                    after = fits[left] = {}
                fit = after.get(token)
                if fit is None:
                    if self.n_fits >= MEMO_PIECES:
                        fits.clear()
                        self.n_fits, after = 0, {}
                        fits[left] = after
                    self.n_fits += 1
                    fit = after[token] = self.compatible(left, token)
                if not fit:
                    continue
            elif token not in alone:
                continue
            last[end + 1], solved = token, end
        ids, end = [], len(data)
        while end:
            token = last[end]
            ids.append(token)
            end -= lengths[token]
        return ids[::-1]

    def word_ids(self, word: str) -> bytes:
        """Packed ids of a pre-token, which may be a token as it stands."""
        packed = self.older.get(word)
        if packed is None:
            data = word.encode()
            token = self.whole.get(data)
            ids = self.pre_token_ids(data) if token is None else [token]
            packed = struct.pack(f"<{len(ids)}I", *ids)
        return self.remember(word, packed)

    def remember(self, piece: str, packed: bytes) -> bytes:
        if len(piece) <= MEMO_CHARS:
            if len(self.memo) >= MEMO_PIECES // 2:
                self.memo, self.older = {}, self.memo
            self.memo[piece] = packed
        return packed

    def piece_ids(self, piece: str) -> bytes:
        """A run of white space with the run of other characters behind it.

        A pre-token never reaches from a visible character into white space, so pieces
        can be encoded, and remembered, on their own. A pre-token is a piece of itself, so the
        words of a piece are remembered beside it: before a comma and before a full stop they are the same.
        """
        packed = self.older.get(piece)
        if packed is None:
            words = self.pre_token.findall(piece)
            if len(words) == 1:
                return self.word_ids(words[0])
            packed = b"".join([self.memo.get(word) or self.word_ids(word) for word in words])
        return self.remember(piece, packed)

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        out = []
        for part in self.split.split(text) if self.split else [text]:
            if self.split and part in self.vocabulary.special:
                out.append(np.array([self.vocabulary.special[part]], dtype="<u4").tobytes())
                continue
            for piece in self.piece.findall(part):
                ids = self.memo.get(piece)
                out.append(self.piece_ids(piece) if ids is None else ids)
        return b"".join(out)


def decode(packed: bytes, tokens: list[bytes]) -> str:
    """The text of packed ids; ids outside the vocabulary are left out."""
    ids = np.frombuffer(packed, dtype="<u4")
    if len(ids) and ids.max() >= len(tokens):
        ids = ids[ids < len(tokens)]
    return b"".join(map(tokens.__getitem__, ids.tolist())).decode("utf-8", "replace")


_ENCODERS: dict[int, Encoder] = {}


def _encoder(shared) -> Encoder:
    """One encoder per worker process; only its memos go at the end of a task."""
    key = shared._jbroadcast.id() if getattr(shared, "_jbroadcast", None) else id(shared)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(shared.value)
    return _ENCODERS[key]


def encode_texts(docs: DataFrame, path: str, text: str = "text", keep=None) -> DataFrame:
    """Adds ``token_ids`` (binary, 32-bit little-endian) and ``n_tokens``.

    A null text counts as empty and gets empty ids. Row count, repeated rows and other
    columns stay; columns called like the new ones are replaced. The vocabulary file
    (bounded: one tokenizer) is read on the driver and broadcast.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary.read(path))

    def make():
        encoder = _encoder(shared)

        def mapper(texts):
            ids = [encoder.encode(t) for t in texts]
            return ids, [len(i) // 4 for i in ids]

        mapper.done = encoder.forget
        return mapper

    return add_columns(docs, make, "token_ids binary, n_tokens bigint", text, keep)


def decode_ids(docs: DataFrame, path: str, ids: str = "token_ids", out: str = "decoded", keep=None) -> DataFrame:
    """Adds the text of packed ids; null ids count as empty."""
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary.read(path).tokens)

    def make():
        tokens = shared.value
        return lambda packed: [[decode(p or b"", tokens) for p in packed]]

    return add_columns(docs, make, f"{out} string", ids, keep)
