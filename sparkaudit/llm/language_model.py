"""A probabilistic suffix tree over the words of a corpus, and unigram base scores.

A context is the one to DEPTH words before a symbol; its oldest may be the start of the text. It
is kept where it passes a divergence test: its counts, leave-one-out and smoothed, must
predict its symbols better than its longest kept suffix does. A token is scored in the state
of the longest kept context. Every word, context and successor seen LEAST times in the training
texts takes part, whatever the size of the corpus: they are tables keyed by the hash of their
words, and tokens are joined to them. Only the frequent part is broadcast, as a cache.

The log probability of a text is a sum over its word sequences, which makes that join a
plain one: a sequence adds the back-off weight it has as a context, and what it gains as a
context and its successor over backing off.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, release, shuffles_freed, small_batches, write_work, written
from .batches import add_columns, without
from .packed import bucket_of, buckets, fields, mixed, pack, pack_table, runs, small, sums, unpack

#: Words of the longest context; occurrences that a word, a context and a successor need.
DEPTH, LEAST = 4, 2
#: Words and sequences of this share of all training tokens are broadcast (at most 1 000 000 of each length), others joined.
HOT_SHARE = 1e-6
#: Divergence test: nats gained in all, and per symbol.
MIN_GAIN, MIN_DIVERGENCE = 12.0, 0.003
#: Symbol numbers of the frequent part: 0 none, 1 any other word, 2 the start; words and the end from 3 on.
RARE, START = 1, 2
END_KEY, START_KEY = 0, -1
#: Most bits of the field that tells which keys a table may have; characters of texts read at once.
MARKS, SLICE_CHARS = 1 << 28, 2_000_000
#: Symbols counted at once; bytes hashed at once.
SLICE_SYMBOLS, BLOCK = 1 << 19, 1 << 17
#: Most bytes of a file's dictionary of words.
DICTIONARY = 16_000_000
#: Most turns in which sequences are counted and tested, each with its share of the buckets (keys are looked up in twice as many,
#: since a turn there costs less), and tokens that are worth a turn.
TURNS, TURN_TOKENS = 2, 10_000_000
#: Bytes of a word from which on its key is a digest.
LONG = 64
_FACTORS = np.random.default_rng(3).integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)
_LETTERS = np.random.default_rng(5).integers(1, 1 << 63, 256, dtype=np.uint64)[np.frombuffer(bytes(range(256)).lower(), np.uint8)]
_IS_WORD = np.array([not bytes([i]).isspace() for i in range(256)], np.int8)
_BASE = 0x5851F42D4C957F2D
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """base ** i modulo 2 ** 64 for i < n; those for a usual block are kept."""
    held = _POWERS.get(base)
    if held is None or len(held) < n:
        held = np.full(max(n, 2 * BLOCK), base, np.uint64)
        held[0] = 1
        held = np.cumprod(held, dtype=np.uint64)
        if len(held) == 2 * BLOCK:
            _POWERS[base] = held
    return held[:n]


def _block_keys(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Of every word: non-zero 63-bit keys of its bytes in lower case, and where it begins."""
    letters = np.frombuffer(data, np.uint8)
    edges = np.diff(np.concatenate([[0], _IS_WORD[letters], [0]]).astype(np.int8))
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    totals = np.append(np.uint64(0), np.cumsum(_LETTERS[letters] * _powers(_BASE, len(letters)), dtype=np.uint64))
    keys = mixed((totals[ends] - totals[starts]) * _powers(_INVERSE, len(letters))[starts]) >> np.uint64(1)
    for i in np.flatnonzero(ends - starts >= LONG).tolist():  # sums of powers are for short words
        keys[i] = xxhash.xxh3_64_intdigest(data[starts[i] : ends[i]].lower()) >> 1
    return np.maximum(keys, np.uint64(1)).astype(np.int64), starts


def _word_keys(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Keys and beginnings of all words, block by block; no block ends inside a word."""
    made, at = [(np.zeros(0, np.int64), np.zeros(0, np.int64))], 0
    while at < len(data):
        end = at + BLOCK
        while end < len(data) and _IS_WORD[data[end]]:
            end += 1
        keys, starts = _block_keys(data[at:end])
        made.append((keys, starts + at))
        at = end
    return tuple(np.concatenate(x) for x in zip(*made))


def _slices(texts: list[str]):
    """Runs of texts of at most SLICE_CHARS characters, single longer texts apart."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > SLICE_CHARS:
            yield texts[start:i]
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield texts[start:]


def _read(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, words and end of every text in a row: keys, places in the text; and where each text begins."""
    parts = [t.encode("utf-8", "surrogatepass") for t in texts]
    keys, starts = _word_keys(b" ".join(parts))
    before = np.searchsorted(starts, np.cumsum([0, *[len(x) + 1 for x in parts]]))  # words before each text
    sizes = np.diff(before) + 2
    first = np.cumsum(sizes) - sizes
    flat = np.full(sizes.sum(), END_KEY, np.int64)
    flat[first] = START_KEY
    flat[np.arange(len(keys)) + np.repeat(2 * np.arange(len(texts)) + 1, sizes - 2)] = keys
    return flat, np.arange(len(flat)) - np.repeat(first, sizes), first


def _longer(shorter: np.ndarray, keys: np.ndarray, length: int) -> np.ndarray:
    """Keys of the ``length`` symbols up to each place, from the keys of one symbol less."""
    older = np.zeros(len(keys), np.uint64)
    older[length - 1 :] = keys[: max(0, len(keys) - length + 1)].view(np.uint64)
    return mixed((shorter.view(np.uint64) * _FACTORS[0]) ^ mixed(older + _FACTORS[length])).view(np.int64)


def _lookup(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of keys in a sorted table, and whether they are there."""
    if not len(table):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return at, table[at] == keys


def _marks(rows: DataFrame, most: int) -> bytes:
    """A bit field set at the column ``key`` of ``most`` rows at most; it may tell too many keys, never too few."""
    bits = min(MARKS, 1 << max(16, most.bit_length()))
    spot = rows.select(F.col("key").bitwiseAND(F.lit(bits - 1)).alias("h"))
    found = spot.groupBy(F.shiftright("h", 6).alias("at")).agg(
        F.expr("bit_or(shiftleft(1L, cast(h & 63 as int)))").alias("bits")
    ).toArrow()  # bounded by MARKS / 64 rows
    field = np.zeros(bits // 64, np.int64)
    field[found.column("at").to_numpy()] = found.column("bits").to_numpy()
    return field.tobytes()


def _field_of(keys: np.ndarray) -> np.ndarray:
    """The bit field of few keys: most of the others are told apart by it, without a search."""
    bits = 1 << min(25, max(16, (16 * len(keys)).bit_length()))
    spots = np.zeros(bits, np.uint8)
    spots[keys & (bits - 1)] = 1
    return np.packbits(spots, bitorder="little").view(np.int64)


def _marked(field: np.ndarray, keys: np.ndarray) -> np.ndarray:
    h = keys & (64 * len(field) - 1)
    return ((field[h >> 6] >> (h & 63)) & 1).astype(bool)


def read_symbols(docs: DataFrame, text: str = "text") -> DataFrame:
    """(symbols) of each text: 64-bit keys of its start, words and end, read once for all counts."""

    def read(parts):
        for part in parts:
            for texts in _slices([t or "" for t in part.column(0).to_pylist()]):
                keys, _, first = _read(texts)
                rows = pa.ListArray.from_arrays(pa.array(np.append(first, len(keys)).astype(np.int32)), pa.array(keys))
                rows = rows.cast(pa.list_(pa.field("element", pa.int64())))
                yield pa.RecordBatch.from_arrays([rows], names=["symbols"])

    # Words repeat: a dictionary of many keys, as a task may have, takes less than the keys.
    rows = docs.select(text).mapInArrow(read, "symbols array<bigint>")
    return docs.sparkSession.read.schema(rows.schema).parquet(write_work(rows, options={"parquet.dictionary.page.size": DICTIONARY}))


def _symbols(parts):
    """Arrays of about SLICE_SYMBOLS symbols (or one longer batch) from batches of ``read_symbols``."""
    held, size = [], 0
    for part in parts:
        held.append(part.column(0).flatten().to_numpy(zero_copy_only=False))
        size += len(held[-1])
        if size >= SLICE_SYMBOLS:
            yield np.concatenate(held)
            held, size = [], 0
    if size:
        yield np.concatenate(held)


def count_words(symbols: DataFrame) -> DataFrame:
    """(key, c) of every word, and of END_KEY for the ends; counted by batch before the shuffle."""

    def count(parts):
        for keys in _symbols(parts):
            key, c = np.unique(keys[keys != START_KEY], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(c)], names=["key", "c"])

    rows = symbols.mapInArrow(count, "key bigint, c bigint")
    return cut_lineage(rows.groupBy("key").agg(F.sum("c").alias("c")))


def _turns(total: int) -> int:
    """Turns for so many tokens: only the share of one is in shuffle files at a time."""
    return max(1, min(TURNS, total // TURN_TOKENS))


def _sequences(symbols: DataFrame, marks, length: int, parts: int, whole: bool, turn: int = 0, turns: int = 1) -> DataFrame:
    """Packed sequences of what ``marks`` may have, counted by slice: (key, c, context, suffix) by key if ``whole``,
    of those whose suffix has its bucket in this turn.

    Else (key, c), with counts up to LEAST, of sequences with both parts marked, by the place of the key in the bit field.
    """

    def count(batches):
        field = np.frombuffer(marks.value, np.int64)
        bits = 64 * len(field)
        for keys in _symbols(batches):
            starts = np.flatnonzero(keys == START_KEY)
            place = np.arange(len(keys)) - np.repeat(starts, np.diff(np.append(starts, len(keys))))
            suffix = keys
            for k in range(2, length):
                suffix = _longer(suffix, keys, k)
            own = _longer(suffix, keys, length)
            often = _marked(field, own if whole else suffix)
            use = np.flatnonzero(often[1:] & (True if whole else often[:-1]) & (place[1:] >= length - 1)) + 1
            if not whole:
                key, c = np.unique(own[use], return_counts=True)
                yield from small(pack((key & (bits - 1)) // (bits // parts), parts, key=key, c=np.minimum(c, LEAST).astype(np.uint8)))
                continue
            if turns > 1:
                use = use[bucket_of(suffix[use], parts) % turns == turn]
            order, first = runs(own[use])
            at, c = use[order[first]], np.diff(np.append(first, len(use)))
            yield from small(pack(
                bucket_of(own[at], parts), parts, key=own[at], c=c.astype(np.int32), context=suffix[at - 1], suffix=suffix[at]
            ))

    return symbols.mapInArrow(count, fields("key", "c", *["context", "suffix"][: 2 * whole]))


def _often(symbols: DataFrame, known, length: int, parts: int, bits: int) -> bytes:
    """The bit field of the sequences of ``length`` symbols that occur LEAST times; each bucket makes its own stretch of it."""

    def fill(rows):
        key, c = unpack(rows, key=np.int64, c=np.uint8)
        order, first = runs(key)
        stretch = np.zeros(bits // parts, np.uint8)
        stretch[key[order[first[sums(c[order].astype(np.int64), first) >= LEAST]]] & (bits // parts - 1)] = 1
        made = [rows.column("bucket").to_pylist()[:1], [np.packbits(stretch, bitorder="little").tobytes()]]
        return pa.table([pa.array(made[0], pa.int32()), pa.array(made[1], pa.binary())], names=["bucket", "field"])

    found = _sequences(symbols, known, length, parts, False).groupBy("bucket").applyInArrow(fill, "bucket int, field binary").toArrow()
    field = np.zeros((parts, bits // parts // 8), np.uint8)  # bounded by MARKS / 8 bytes
    for at, stretch in zip(found.column("bucket").to_pylist(), found.column("field").to_pylist()):
        field[at] = np.frombuffer(stretch, np.uint8)
    return field.tobytes()


def count_sequences(symbols: DataFrame, known, length: int, parts: int, turns: int = 1, then=None):
    """Packed (key, c, context, suffix), by suffix, of the sequences of ``length`` symbols that occur LEAST times; their marks.

    ``context`` is the sequence without its last symbol, ``suffix`` the one without its first; only where both
    are in ``known``, the marks of one symbol less, can it be frequent enough. Most sequences occur once, so keys
    are counted alone first, and whole rows move for the marked ones only. Marks are broadcast; the caller destroys them.
    With ``then`` the table of each turn is replaced by what ``then(table, turn)`` writes from it.
    """
    marks = symbols.sparkSession.sparkContext.broadcast(_often(symbols, known, length, parts, 8 * len(known.value)))

    def total(rows):
        key, c, context, suffix = unpack(rows, key=np.int64, c=np.int32, context=np.int64, suffix=np.int64)
        order, first = runs(key)
        c = sums(c[order].astype(np.int64), first)
        at, c = order[first[c >= LEAST]], c[c >= LEAST]
        return pack_table(bucket_of(suffix[at], parts), parts, key=key[at], c=c, context=context[at], suffix=suffix[at])

    names = ["key", "c", "context", "suffix"]
    made = []
    for turn in range(turns):
        rows = _sequences(symbols, marks, length, parts, True, turn, turns)
        found = cut_lineage(rows.groupBy("bucket").applyInArrow(total, fields(*names)))  # its shuffle goes here
        made.append(then(found, turn) if then else found)
        if then:
            release(found)
    return written(made), marks


def _in_turn(rows: DataFrame, turn: int, turns: int):
    return rows.where(F.col("bucket") % turns == turn).groupBy("bucket")


def _sorted(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    key, c, p = unpack(rows, key=np.int64, c=np.int64, p=np.float64)
    order = np.argsort(key)
    return key[order], c[order], p[order]


def back_off(found: DataFrame, shorter: DataFrame, parts: int, turn: int = 0, turns: int = 1) -> DataFrame:
    """Packed (key, c, context, below), by context: with the probability of the last symbol after the suffix's context.

    ``found`` are the sequences by suffix, of one turn, ``shorter`` (key, c, p) those of one symbol less, with the
    probability of the last symbol in the state of the longest kept context.
    """

    def backed(left, right):
        key, c, context, suffix = unpack(left, key=np.int64, c=np.int64, context=np.int64, suffix=np.int64)
        table, _, p = _sorted(right)
        at, hit = _lookup(table, suffix)
        key, c, context = key[hit], c[hit], context[hit]
        return pack_table(bucket_of(context, parts), parts, key=key, c=c, context=context, below=p[at[hit]])

    both = _in_turn(found, turn, turns).cogroup(_in_turn(shorter, turn, turns))
    return cut_lineage(both.applyInArrow(backed, fields("key", "c", "context", "below")))


def keep_contexts(asked: DataFrame, shorter: DataFrame, parts: int, turns: int = 1) -> tuple[DataFrame, DataFrame]:
    """All sequences (key, c, p) of a length, packed by key, and (key, c, back, gain) of what has a value.

    ``asked`` are the sequences of ``back_off``, ``shorter`` those of one symbol less. Kept contexts have ``back``,
    the log10 of their back-off weight; the sequences they begin have ``gain``, the log10 of p over the probability by
    backing off. The sequences of one context meet in one group: as many as words that often follow it.
    """

    def tested(left, right):
        key, c, context, below = unpack(left, key=np.int64, c=np.int64, context=np.int64, below=np.float64)
        table, counts, _ = _sorted(right)
        at, hit = _lookup(table, context)
        order, first = runs(context[hit])
        key, c, context, below, n = (x[order] for x in (key[hit], c[hit], context[hit], below[hit], counts[at[hit]]))
        kinds, held, n = np.diff(np.append(first, len(key))), sums(c, first), n[first]
        back, which = 1 - held / (n + kinds), np.repeat(np.arange(len(first)), kinds)
        left_out = (c - 1) / (n - 1 + kinds)[which] + back[which] * below
        gain = sums(c * np.log(left_out / below), first) + (n - held) * np.log(back)
        kept = (gain >= MIN_GAIN) & (gain >= MIN_DIVERGENCE * n)
        own, own_kept = c / (n + kinds)[which] + back[which] * below, kept[which]
        level = pack(bucket_of(key, parts), parts, key=key, c=c, p=np.where(own_kept, own, below), gain=np.zeros(len(key), np.int8))
        gains = np.log10(own / (back[which] * below))[own_kept]
        values = pack(
            np.zeros(kept.sum() + own_kept.sum(), np.int64), 1, key=np.append(context[first][kept], key[own_kept]),
            c=np.append(n[kept], c[own_kept]), p=np.append(np.log10(back[kept]), np.zeros(len(gains))),
            gain=np.append(np.zeros(kept.sum()), gains),
        )
        made = pa.Table.from_batches([*small(level), values])
        return made.append_column("valued", pa.array(np.arange(made.num_rows) >= level.num_rows))

    levels, values = [], []
    for turn in range(turns):
        both = _in_turn(asked, turn, turns).cogroup(_in_turn(shorter, turn, turns))
        made = cut_lineage(both.applyInArrow(tested, fields("key", "c", "p", "gain") + ", valued boolean"))
        levels.append(cut_lineage(made.where("not valued").select("bucket", "key", "c", "p")))
        values.append(_values(made))
        release(made)
    return written(levels), written(values)


def _values(level: DataFrame) -> DataFrame:
    """(key, c, back, gain) as rows."""

    def spread(parts):
        for part in parts:
            made = unpack(part, key=np.int64, c=np.int64, p=np.float64, gain=np.float64)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in made], names=["key", "c", "back", "gain"])

    rows = level.where("valued").select("key", "c", "p", "gain")
    return cut_lineage(rows.mapInArrow(spread, "key bigint, c bigint, back double, gain double"))


def _packed(rows: DataFrame, parts: int, **kinds: type) -> DataFrame:
    """Rows with a column ``key``, packed by it; a null is a 0."""

    def gather(batches):
        for part in batches:
            made = {x: part.column(x).fill_null(0).to_numpy(zero_copy_only=False).astype(kind) for x, kind in kinds.items()}
            yield pack(bucket_of(made["key"], parts), parts, **made)

    return rows.select(*kinds).mapInArrow(gather, fields(*kinds))


def _cold_sums(read: DataFrame, known: DataFrame, parts: int, turns: int) -> DataFrame:
    """(at, more, extra, rest) by row of ``read``: sums over its keys in ``cold``, joined to the packed (key, c, v) of ``known``."""

    def asked(turn):
        def ask(batches):
            for whole in batches:
                for start in range(0, whole.num_rows, 1024):
                    part = whole.slice(start, 1024)
                    key = part.column(1).flatten().to_numpy(zero_copy_only=False)
                    row = np.repeat(part.column(0).to_numpy(), part.column(1).value_lengths().to_numpy())
                    bucket = bucket_of(key, parts)
                    use = bucket % turns == turn
                    yield from small(pack(bucket[use], parts, key=key[use], row=row[use]))

        return ask

    def by_row(row, *values):
        order, first = runs(row)
        return row[order[first]], *[sums(x[order], first) for x in values]

    def found(left, right):
        key, row = unpack(left, key=np.int64, row=np.int64)
        table, c, v = unpack(right, key=np.int64, c=np.int64, v=np.float64)
        order, first = runs(table)  # a sequence has a value as such, and one as a context
        table, c, v = table[order[first]], sums(c[order], first), sums(v[order], first)
        at, hit = _lookup(table, key)
        c, v = c[at[hit]], v[at[hit]]
        row, more, extra, rest = by_row(row[hit], (c > 0).astype(np.int64), np.log10(c + 1.0), np.log10(np.maximum(c, 1)) + v)
        return pack_table(bucket_of(row, parts), parts, row=row, more=more, extra=extra, rest=rest)

    def total(rows):
        made = by_row(*unpack(rows, row=np.int64, more=np.int64, extra=np.float64, rest=np.float64))
        return pa.table([pa.array(x) for x in made], names=["at", "more", "extra", "rest"])

    made = []
    for turn in range(turns):  # so that only a part of the keys is in shuffle files at a time
        wanted = read.select("row", "cold").mapInArrow(asked(turn), fields("key", "row"))
        both = wanted.groupBy("bucket").cogroup(_in_turn(known, turn, turns))
        partial = both.applyInArrow(found, fields("row", "more", "extra", "rest"))
        made.append(cut_lineage(partial.groupBy("bucket").applyInArrow(total, "at bigint, more bigint, extra double, rest double")))
    return written(made).groupBy("at").agg(*[F.sum(x).alias(x) for x in ("more", "extra", "rest")])


class SuffixTree:
    """The frequent part of the tree: probabilities and keys by symbol, and by depth sequences with two logs.

    The logs are the back-off weight of a context and the gain of a context with its successor, the other
    one being 0. ``contexts`` has the kept contexts by depth: symbols of those of one word, else keys.
    """

    def __init__(self, root: np.ndarray, keys: np.ndarray) -> None:
        self.root, self.keys = root, keys
        self.contexts: list[np.ndarray] = []
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []

    def add_level(self, keys: np.ndarray, c: np.ndarray) -> None:
        """Sequences of the next depth with their (back, gain)."""
        order = np.argsort(keys)
        keys, c = keys[order], c[order]
        kept = keys[c[:, 0] != 0]
        self.contexts.append(kept if self.levels else np.flatnonzero(_lookup(kept, self.keys)[1]))
        self.levels.append((keys, c))

    def probabilities(self, symbols: np.ndarray) -> np.ndarray:
        """Of every symbol in the state of its longest kept context, with what is frequent."""
        keys = self.keys[symbols]
        p, before = self.root[symbols], keys
        for depth, (table, c) in enumerate(self.levels, 1):
            own = _longer(before, keys, depth + 1)
            at, hit = _lookup(table, before[:-1])
            use = hit & (np.arange(1, len(keys)) >= depth)
            p[1:][use] *= 10 ** c[at[use], 0]
            at, hit = _lookup(table, own)
            use = hit & (np.arange(len(keys)) >= depth)
            p[use] *= 10 ** c[at[use], 1]
            before = own
        return p

    def table(self) -> tuple[np.ndarray, np.ndarray]:
        """Sorted keys of all depths and the sum of their logs."""
        if not self.levels:
            return np.zeros(0, np.int64), np.zeros(0)
        keys, at = np.unique(np.concatenate([k for k, _ in self.levels]), return_inverse=True)
        return keys, np.bincount(at, np.concatenate([c.sum(1) for _, c in self.levels]), minlength=len(keys))


def score(docs: DataFrame, train: DataFrame, text: str = "text", keep=None) -> DataFrame:
    """Adds ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score`` to ``docs``.

    Both models learn from ``train``. ``score`` is the suffix tree's log10 probability of the
    whole text as words and end; the unknown word has the probability of words seen once
    (plus one), which is what unseen words cost, and known words share the rest by count.
    ``base_score`` sums log10((c + 1) / (N + V + 1)) over the tokens. Null and empty texts
    have the end only. Words and sequences of at least HOT_SHARE are looked up in broadcast tables
    of bounded size, all others by a join; repeated rows are scored alike; with an empty
    training table every token is unknown. Columns called like the new ones are replaced.
    """
    with shuffles_freed(docs.sparkSession), small_batches(docs.sparkSession):
        scored = _score(docs, train, text, keep)
    return scored.select("*")  # planned anew, so its own shuffles stay as long as it does


def _score(docs: DataFrame, train: DataFrame, text: str, keep) -> DataFrame:
    spark, made = docs.sparkSession, ["n_tokens", "n_known", "train_tokens", "base_score", "score"]
    context = spark.sparkContext
    symbols = read_symbols(train, text)
    counts = count_words(symbols)
    n, v, once, ends = counts.agg(
        F.sum("c"), F.count(F.when(F.col("c") > 0, 1)), F.count(F.when(F.col("c") == 1, 1)), F.max(F.when(F.col("key") == END_KEY, F.col("c")))
    ).first()
    n, ends = n or 0, ends or 0
    is_hot = (F.col("c") >= max(1.0, HOT_SHARE * n)) | F.col("key").isin(END_KEY, START_KEY)
    hot = counts.where(is_hot).select("key", "c").toArrow()  # bounded by 1 / HOT_SHARE rows
    key, c = hot.column("key").to_numpy(), hot.column("c").to_numpy()
    order = np.argsort(key)
    key, c = key[order], c[order]

    unknown = (once + 1) / (n + 2)
    known = (1 - unknown) / max(1, n)
    root = np.concatenate([np.zeros(START + 1), known * c])
    root[RARE] = max(1e-12, 1 - root.sum())  # unknown and all other words
    tree = SuffixTree(root, np.concatenate([[-3, -2, START_KEY], key]).astype(np.int64))
    starts = spark.createDataFrame([(START_KEY, ends, None)], "key bigint, c bigint, p double")
    shorter = counts.where(F.col("c") >= LEAST).select("key", "c", (F.col("c") * F.lit(known)).alias("p")).unionByName(starts)
    parts = buckets(n)
    marks = context.broadcast(_marks(shorter, n))
    turns, shorter = _turns(n), cut_lineage(_packed(shorter, parts, key=np.int64, c=np.int64, p=np.float64))
    values = starts.where(F.lit(False)).select("key", "c", F.col("p").alias("back"), F.col("p").alias("gain"))
    for depth in range(1, DEPTH + 1):
        known_marks = marks
        asked, marks = count_sequences(
            symbols, known_marks, depth + 1, parts, turns, lambda found, turn: back_off(found, shorter, parts, turn, turns)
        )
        known_marks.destroy()
        level, own = keep_contexts(asked, shorter, parts, turns)
        release(asked)
        release(shorter)
        shorter = level
        if not level.limit(1).count():
            break
        often = own.where(is_hot).select("key", "back", "gain").toArrow()  # bounded by 2 / HOT_SHARE rows
        tree.add_level(often.column("key").to_numpy(), np.column_stack([often.column("back").to_numpy(), often.column("gain").to_numpy()]))
        values = values.unionByName(own)
    marks.destroy()
    release(shorter)
    release(symbols)
    lookups = counts.where(~is_hot).select("key", "c", F.lit(0.0).alias("v")).unionByName(
        values.where(~is_hot).select("key", F.lit(None).cast("bigint").alias("c"), (F.col("back") + F.col("gain")).alias("v"))
    )
    longest = len(tree.levels) + 1
    # A successor has a value only after a kept context, frequent or not: most tokens follow none and ask for nothing.
    model = context.broadcast((key, c, *tree.table(), _marks(lookups, n), _marks(values.where("back != 0"), n)))
    packed = cut_lineage(_packed(lookups, parts, key=np.int64, c=np.int64, v=np.float64))
    release(lookups)  # all counts and values: later steps read the packed ones
    log_known, log_unknown = math.log10(known), math.log10(unknown)

    def make():
        hot_keys, hot_counts, tree_keys, tree_logs, *marks = model.value
        field, begun = (np.frombuffer(x, np.int64) for x in marks)
        frequent = _field_of(tree_keys)
        plus_one, plain = np.log10(hot_counts + 1.0), np.log10(np.maximum(hot_counts, 1.0))

        def piece(texts):
            keys, place, first = _read(texts)
            text_of = np.repeat(np.arange(len(texts)), np.diff(np.append(first, len(keys))))
            at, hit = _lookup(hot_keys, keys)
            hit &= place > 0
            if len(hot_counts):
                hit &= hot_counts[at] > 0
            sums = [np.bincount(text_of[hit], x[at[hit]], minlength=len(texts)) for x in (plus_one, plain)]
            tree_sum = np.zeros(len(texts))
            own, asked = keys, []
            for length in range(1, longest + 1):
                before = own
                if length > 1:
                    own = _longer(own, keys, length)
                there = np.flatnonzero(place >= length - 1)
                maybe = there[_marked(frequent, own[there])]
                at, found = _lookup(tree_keys, own[maybe])
                tree_sum += np.bincount(text_of[maybe[found]], tree_logs[at[found]] if len(tree_logs) else None, minlength=len(texts))
                cold = there[_marked(field, own[there])]
                if length > 1:
                    cold = cold[_marked(begun, own[cold]) | _marked(begun, before[cold - 1])]
                asked.append((text_of[cold], own[cold]))
            which, wanted = (np.concatenate(x) for x in zip(*asked))
            return (
                np.diff(np.append(first, len(keys))) - 1, np.bincount(text_of[hit], minlength=len(texts)), *sums, tree_sum,
                np.bincount(which, minlength=len(texts)), wanted[np.argsort(which, kind="stable")],
            )

        def mapper(texts):
            pieces = [piece(x) for x in _slices(texts)]
            if not pieces:
                return [[] for _ in range(5)]
            sizes, hits, logs, plains, trees, asked, wanted = (np.concatenate(x) for x in zip(*pieces))
            ends = pa.array(np.concatenate([[0], np.cumsum(asked)]).astype(np.int32))
            cold = pa.ListArray.from_arrays(ends, pa.array(wanted)).cast(pa.list_(pa.field("element", pa.int64())))
            return sizes, hits, logs, cold, plains + hits * log_known + trees

        return mapper

    names = without(docs.select(*keep) if keep is not None else docs, made)
    read = add_columns(
        docs.select(*[docs[c].alias(f"__c{i}") for i, c in enumerate(names)], docs[text].alias("__t")), make,
        "tokens bigint, known bigint, logs double, cold array<bigint>, tree double", "__t",
        [f"__c{i}" for i in range(len(names))],
    )
    read = cut_lineage(read.withColumn("row", F.monotonically_increasing_id()))  # fixed once written
    model.destroy()
    cold = _cold_sums(read, packed, parts, 2 * turns)
    release(packed)
    joined = read.drop("cold").join(cold, F.col("row") == F.col("at"), "left")
    more, unseen = F.coalesce("more", F.lit(0)), F.col("tokens") - F.col("known") - F.coalesce("more", F.lit(0))
    return joined.select(
        *[F.col(f"__c{i}").alias(c) for i, c in enumerate(names)],
        F.col("tokens").alias("n_tokens"), (F.col("known") + more).alias("n_known"), F.lit(n).cast("bigint").alias("train_tokens"),
        (F.col("logs") + F.coalesce("extra", F.lit(0.0)) - F.col("tokens") * F.lit(math.log10(n + v + 1))).alias("base_score"),
        (F.col("tree") + F.coalesce("rest", F.lit(0.0)) + more * F.lit(log_known) + unseen * F.lit(log_unknown)).alias("score"),
    )
