"""Benchmark decontamination by binary search in suffix arrays of the training text.

Every Arrow batch of documents is a shard with its own suffix array over words. All test
suffixes are looked up in it by binary search, which yields every verbatim occurrence of
a test window, its place and, from neighbouring windows, the longest matches.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import add_columns, without
from ..session import cut_lineage

#: Bytes of test text that one broadcast index covers; larger test sets are searched in blocks.
BLOCK_BYTES = 16_000_000
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
MATCHES = "array<struct<item_id:string,start:int,n_words:int>>"


def words(text: str) -> list[bytes]:
    """ASCII letters lower-cased, ASCII digits and letters and everything beyond ASCII are word characters."""
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split()


class TestIndex:
    """Sorted windows of the test items of one block, with the items of each."""

    __test__ = False

    def __init__(self, items: list[tuple[str | None, str]], width: int) -> None:
        self.width, self.vocabulary = width, {}
        windows: dict[tuple[int, ...], set] = {}
        self.items = []
        for item, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words(text)]
            if not ids:
                continue
            size = min(width, len(ids))
            for i in range(len(ids) - size + 1):
                windows.setdefault(tuple(ids[i : i + size]), set()).add(len(self.items))
            self.items.append(item)
        self.windows: dict[int, tuple[np.ndarray, list[np.ndarray]]] = {}
        for size in sorted({len(w) for w in windows}):
            own = sorted(w for w in windows if len(w) == size)
            self.windows[size] = (np.array(own, dtype=">u4"), [np.array(sorted(windows[w])) for w in own])
        n = len(self.vocabulary) + 1
        self.starts = np.zeros(n, dtype=bool)  # single words that are a window, or begin one
        for size, (own, _) in self.windows.items():
            self.starts[own[:, 0].astype(np.int64)] = True
        pairs = [own[:, :2].astype(np.int64) for size, (own, _) in self.windows.items() if size > 1]
        self.pairs = np.unique(np.concatenate([p[:, 0] * n + p[:, 1] for p in pairs])) if pairs else np.zeros(0, np.int64)
        self.singles = self.windows[1][0][:, 0].astype(np.int64) if 1 in self.windows else np.zeros(0, np.int64)

    def occurrences(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(position, words, window's number within its size) of every test window in the shard.

        ``ids`` holds the shard's words, 0 for words no item has and between documents.
        Suffixes that share their first two words with no window cannot contain one, so
        the suffix array leaves them out.
        """
        none = np.zeros(0, np.int64)
        n, reach = len(self.vocabulary) + 1, self.width
        at = np.flatnonzero(self.starts[ids])
        if not len(at):
            return none, none, none
        padded = np.concatenate([ids, np.zeros(reach, ids.dtype)])
        pair = ids[at] * n + padded[at + 1]
        keep = np.isin(ids[at], self.singles) if len(self.singles) else np.zeros(len(at), bool)
        if len(self.pairs):
            slot = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
            keep |= self.pairs[slot] == pair
        at = at[keep]
        if not len(at):
            return none, none, none
        suffix = padded[at[:, None] + np.arange(reach)].astype(">u4")
        # Beyond a 0 nothing can match; equal bytes there keep the order a plain prefix order.
        suffix[np.cumsum(suffix == 0, axis=1) > 0] = 0
        keys = np.ascontiguousarray(suffix).view(f"S{4 * reach}").ravel()
        order = np.argsort(keys, kind="stable")
        keys, at = keys[order], at[order]
        places, sizes, numbers = [], [], []
        for size, (own, _) in self.windows.items():
            low, high = np.zeros((len(own), reach), ">u4"), np.full((len(own), reach), 0xFFFFFFFF, ">u4")
            low[:, :size] = high[:, :size] = own
            first = np.searchsorted(keys, low.view(f"S{4 * reach}").ravel(), "left")
            after = np.searchsorted(keys, high.view(f"S{4 * reach}").ravel(), "right")
            found = np.flatnonzero(after > first)
            for w in found:
                places.append(at[first[w] : after[w]])
                numbers.append(np.full(after[w] - first[w], w))
            sizes += [np.full(after[w] - first[w], size) for w in found]
        if not places:
            return none, none, none
        return np.concatenate(places), np.concatenate(sizes), np.concatenate(numbers)

    def search(self, texts: list[str]) -> tuple[list, list, list]:
        """Per text: number of words, hit words, matches (item, first word, words)."""
        lookup, flat, ends = self.vocabulary.get, [], []
        for text in texts:
            flat += [lookup(w, 0) for w in words(text)]
            flat.append(0)
            ends.append(len(flat))
        ids, ends = np.array(flat, dtype=np.int64), np.array(ends, dtype=np.int64)
        starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
        counts = (ends - starts - 1).tolist()
        matches: list[list] = [[] for _ in texts]
        at, size, number = self.occurrences(ids)
        cover = np.zeros(len(ids) + 1, np.int64)
        np.add.at(cover, at, 1)
        np.add.at(cover, at + size, -1)
        hit = np.concatenate([[0], np.cumsum(np.cumsum(cover)[: len(ids)] > 0)])
        hits = (hit[ends] - hit[starts]).tolist() if len(ends) else []
        runs: dict[tuple[int, int], list[list[int]]] = {}  # neighbouring windows of an item make one match
        for i in np.argsort(at, kind="stable").tolist():
            place, length = int(at[i]), int(size[i])
            for item in self.windows[length][1][number[i]].tolist():
                doc = int(np.searchsorted(ends, place, "right"))
                own = runs.setdefault((doc, item), [])
                if own and own[-1][0] + own[-1][1] - length + 1 >= place:
                    own[-1][1] = max(own[-1][1], place + length - own[-1][0])
                else:
                    own.append([place, length])
        for (doc, item), own in runs.items():
            matches[doc] += [(self.items[item], p - int(starts[doc]), n) for p, n in own]
        return counts, hits, [sorted(m, key=lambda x: (x[1], x[2], x[0] or "")) for m in matches]


def _blocks(benchmark: DataFrame, item: str, text: str, block_bytes: int):
    """Lists of (item, text), each of about ``block_bytes`` at most."""
    rows = benchmark.select(
        F.col(item).cast("string").alias("item"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    total = rows.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    n = 1 + 2 * total // block_bytes
    for block in range(n):
        part = rows if n == 1 else rows.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == block)
        yield [(r["item"], r["text"]) for r in part.collect()]


def find_matches(
    docs: DataFrame, benchmark: DataFrame, width: int = 10, text: str = "text", item: str = "item_id",
    keep=None, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Adds ``n_words``, ``n_hit`` and ``matches`` (item, first word, number of words).

    A window is ``width`` consecutive words of an item, or a shorter item as a whole; a
    word is hit inside any occurrence of a window. Null and empty texts have no words and
    no matches, items without words match nothing, an empty test set hits nothing, equal
    items match together, an item without id is hit but carries a null name. Repeated
    rows each get their own result. A test set beyond ``block_bytes`` is searched block
    by block, each block a pass over the documents.
    """
    made = ["n_words", "n_hit", "matches"]
    names = without(docs.select(*keep) if keep is not None else docs, made)
    done = None
    for items in _blocks(benchmark, item, text, block_bytes):
        shared = docs.sparkSession.sparkContext.broadcast(TestIndex(items, width))

        def make(shared=shared):
            index = shared.value
            return index.search

        if done is None:
            done = add_columns(docs, make, f"n_words bigint, n_hit bigint, matches {MATCHES}", text, list(dict.fromkeys([*names, text])), None)
            continue
        done = cut_lineage(done)
        done = add_columns(done, make, f"__w bigint, __h bigint, __m {MATCHES}", text, None, None)
        done = done.withColumn("matches", F.concat("matches", "__m")).drop("__w", "__h", "__m")
        done = done.withColumn("n_hit", _covered(F.col("matches")))
    return done.select(*names, *made)


def _covered(matches):
    """Words inside any of the matches."""
    ordered = F.array_sort(F.transform(matches, lambda m: F.struct(m["start"].alias("s"), (m["start"] + m["n_words"]).alias("e"))))
    zero = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).alias("to"))
    return F.aggregate(
        ordered, zero,
        lambda a, m: F.struct(
            (a["n"] + F.greatest(F.lit(0), m["e"] - F.greatest(a["to"], m["s"]))).cast("bigint").alias("n"),
            F.greatest(a["to"], m["e"]).alias("to"),
        ),
        lambda a: a["n"],
    )


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, width: int = 10, text: str = "text", item: str = "item_id"
) -> DataFrame:
    """The documents in which no window of the benchmark occurs, columns unchanged."""
    plain = docs.toDF(*[f"__c{i}" for i in range(len(docs.columns))])  # no name can clash
    probe = f"__c{docs.columns.index(text)}"
    tests = benchmark.select(F.col(item).alias("item_id"), F.col(text).alias(probe))
    found = find_matches(plain, tests, width, probe)
    return found.where(F.col("n_hit") == 0).select(*plain.columns).toDF(*docs.columns)
