"""Near-duplicate documents by a chosen-path set similarity join.

A document is the set of its word shingles; equal sets are one class from the start. In
each of several independent trees a class follows the path of its minwise shingles: node
by node it is branched by the next minwise token until the node is small, and classes of a
small node are compared exhaustively by sketch. Nodes that stay large (many near copies)
are compared with the member closest to their consensus. Every candidate is confirmed on the
full sets. Large nodes that hold more than one component go on, deeper; what a second
round leaves mixed is compared exhaustively, the classes outside a node's main component
against the others.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .batches import add_columns, without
from .components import components

TREES, LEVELS, LEAF = 16, 6, 32
#: Share of agreeing sketch bytes a pair needs to be confirmed: four standard deviations below 0.8.
SIMILAR, LIKELY = 80, 0.64
SLICE_CHARS, MEMO = 2_000_000, 300_000
_HASHES = TREES * LEVELS
_FACTORS = np.random.default_rng(20).integers(1, 1 << 63, 64 + _HASHES, dtype=np.uint64) | np.uint64(1)


#: Bits of the field that marks the texts of candidate pairs.
MARKS = 1 << 25


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


class Words(dict):
    """64-bit hashes of words, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) >= MEMO:
            self.clear()
        if len(word) < 64:
            self[word] = value
        return value


def shingle_sets(texts: list[str], width: int, memo: Words) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's shingles; a shorter text is one shingle, none without words."""
    flat, counts = [], []
    for text in texts:
        own = [memo[w] for w in text.encode("utf-8", "surrogatepass").lower().split()]
        flat += own
        counts.append(len(own))
    words = np.array(flat, dtype=np.uint64)
    sums = np.zeros(max(0, len(words) - width + 1), np.uint64)
    for i in range(width):
        sums += words[i : i + len(sums)] * _FACTORS[i]
    hashed = _mixed(sums)
    out, start = [], 0
    for n in counts:
        if n >= width:
            out.append(np.unique(hashed[start : start + n - width + 1]))
        elif n:
            out.append(_mixed((words[start : start + n] * _FACTORS[32 : 32 + n]).sum(keepdims=True) + np.uint64(n)))
        else:
            out.append(np.zeros(0, np.uint64))
        start += n
    return out


def _slices(texts: list[str]):
    """Index ranges of at most SLICE_CHARS characters, single longer texts apart."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > SLICE_CHARS:
            yield start, i
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)


def _minima(sets: list[np.ndarray]) -> np.ndarray:
    """(set, hash function) minima as 32-bit numbers; sets are not empty."""
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    low = np.concatenate(sets) >> np.uint64(32)
    out = np.empty((len(sets), _HASHES), np.uint32)
    for f in range(_HASHES):
        out[:, f] = np.minimum.reduceat((low * _FACTORS[64 + f]) >> np.uint64(32), starts)
    return out


def _describe(width: int):
    """Mapper: size, class and paths (tree by tree, level by level) of each text's set."""
    memo = Words()

    def mapper(texts):
        sizes, classes, paths = [], [], []
        for a, b in _slices(texts):
            sets = shingle_sets(texts[a:b], width, memo)
            full = [s for s in sets if len(s)]
            minima = iter(_minima(full)) if full else iter(())
            for s in sets:
                sizes.append(len(s))
                classes.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                paths.append(next(minima).astype(">u4").tobytes() if len(s) else None)
        return sizes, classes, paths

    return mapper


def _sketch_pairs(parts, every: bool):
    """Candidate pairs of neighbouring rows of the same node, rows sorted by node.

    Leaves are bounded, so comparing each row with the next LEAF - 1 is exhaustive; the
    last rows of a batch are kept for the next one. At first the pairs that would span a
    leaf suffice; with ``every`` all likely pairs of different components come out.
    """
    held = None
    for part in parts:
        table = pa.Table.from_batches([part])
        if held is not None:
            table = pa.concat_tables([held, table])
        node = table.column("node").to_numpy()
        n = len(node)
        yield from _compared(table, node, held.num_rows if held is not None else 0, every)
        held = table.slice(max(0, n - LEAF))


def _compared(table: pa.Table, node: np.ndarray, old: int, every: bool):
    n = len(node)
    size = table.column("n").to_numpy()
    own = table.column("class").to_pylist()
    root = table.column("root").to_pylist()
    sketch = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint8).reshape(n, _HASHES)
    found = []
    for off in range(1, min(LEAF, n)):
        i = np.flatnonzero(node[:-off] == node[off:])
        i = i[i + off >= old]  # earlier pairs came out with the batch before
        if not len(i):
            continue
        low, high = np.minimum(size[i], size[i + off]), np.maximum(size[i], size[i + off])
        i = i[100 * low >= SIMILAR * high]
        alike = (sketch[i] == sketch[i + off]).sum(1)
        keep = alike >= LIKELY * _HASHES
        found += zip((-alike[keep]).tolist(), i[keep].tolist(), (i[keep] + off).tolist())
    above: dict[int, int] = {}

    def top(x):
        while above.get(x, x) != x:
            x = above[x]
        return x

    a, b = [], []
    for _, i, j in sorted(found):
        if root[i] == root[j]:
            continue
        if not every:
            x, y = top(i), top(j)
            if x == y:
                continue
            above[x] = y
        a.append(min(own[i], own[j]))
        b.append(max(own[i], own[j]))
    if a:
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])


def _consensus(parts):
    """(node, sketch) of the most frequent byte at every place, over rows sorted by node."""
    node, rows = None, []

    def mode(rows):
        m = np.frombuffer(b"".join(rows), np.uint8).reshape(len(rows), _HASHES)
        return bytes(np.bincount(m[:, c], minlength=256).argmax().item() for c in range(_HASHES))

    for part in parts:
        made = []
        for here, sketch in zip(part.column("node").to_pylist(), part.column("sketch").to_pylist()):
            if here != node:
                if rows:
                    made.append((node, mode(rows)))
                node, rows = here, []
            rows.append(sketch)
        yield pa.RecordBatch.from_arrays(
            [pa.array([x for x, _ in made], pa.int64()), pa.array([x for _, x in made], pa.binary())], names=["at", "mode"]
        )
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array([node], pa.int64()), pa.array([mode(rows)], pa.binary())], names=["at", "mode"])


def _agreement(left: str, right: str, out: str):
    """Mapper over batches: number of equal bytes of two sketches of a row, added as a column."""
    def run(parts):
        for part in parts:
            a, b = (np.frombuffer(b"".join(part.column(c).to_pylist()), np.uint8).reshape(-1, _HASHES) for c in (left, right))
            names = [n for n in part.schema.names if n not in (left, right)]
            yield pa.RecordBatch.from_arrays(
                [part.column(n) for n in names] + [pa.array((a == b).sum(1), pa.int32())], names=[*names, out]
            )

    return run


class Join:
    """The steps of one join; tables that several steps read are written to the shared folder."""

    def __init__(self, docs: DataFrame, width: int, key: str, text: str) -> None:
        self.docs, self.width, self.key, self.text = docs, width, key, text
        rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
        self.rows = cut_lineage(
            add_columns(rows, lambda: _describe(width), "n bigint, class binary, path binary", "text", ["key"])
        )
        sketch = F.expr("unhex(concat_ws('', transform(sequence(4, length(path), 4), i -> hex(substring(path, i, 1)))))")
        self.classes = cut_lineage(
            self.rows.where("class is not null").groupBy("class").agg(
                F.min("key").alias("key"), F.first("n").alias("n"), F.first("path").alias("path")
            ).withColumn("sketch", sketch)
        )

    def branches(self, depth: int):
        """Rows (tree, class, way): the path of a class in each tree, LEVELS tokens a round.

        A further round goes on with the tokens of other trees, so a path never repeats one.
        """
        per_tree = 4 * LEVELS
        ways = F.transform(
            F.sequence(F.lit(0), F.lit(TREES - 1)),
            lambda t: F.struct(t.alias("tree"), F.concat(*[
                F.substring(F.col("path"), (t + 5 * r) % TREES * per_tree + 1, F.lit(per_tree)) for r in range(depth)
            ]).alias("way")),
        )
        return self.classes.select("class", F.explode(ways).alias("b")).select("class", "b.tree", "b.way")

    def first_branching(self) -> tuple[DataFrame, DataFrame]:
        """Leaves (node, class) of the first level, and the rows (class, tree, way) of larger nodes."""
        at = self.branches(1).withColumn("node", F.xxhash64("tree", F.substring("way", 1, 4)))
        sizes = at.groupBy("node").agg(F.count("*").alias("size")).where("size > 1").withColumnRenamed("node", "at")
        shared = cut_lineage(at.join(sizes, F.col("node") == F.col("at")).drop("at"))
        return shared.where(F.col("size") <= LEAF).select("node", "class"), shared.where(F.col("size") > LEAF)

    def recursion(self, rows: DataFrame, first: int, last: int) -> tuple[DataFrame, DataFrame]:
        """Leaves (node, class) and the rows (class, tree, way, node, size) still in large nodes.

        All levels are counted in one pass: a class follows its way and stops in the first
        node that is small enough.
        """
        ways = rows.select("class", "tree", "way", F.explode(F.sequence(F.lit(first), F.lit(last))).alias("level"))
        steps = ways.withColumn("node", F.xxhash64("tree", F.expr("substring(way, 1, 4 * level)")))
        sizes = steps.groupBy("node").agg(F.count("*").alias("size")).withColumnRenamed("node", "at")
        here = F.struct("level", "node", "size")
        ends = cut_lineage(steps.join(sizes, F.col("node") == F.col("at")).groupBy("class", "tree", "way").agg(
            F.min(F.when(F.col("size") <= LEAF, here)).alias("leaf"), F.max(here).alias("last")
        ))
        return (
            ends.where("leaf.size > 1").select(F.col("leaf.node").alias("node"), "class"),
            ends.where("leaf is null").select("class", "tree", "way", F.col("last.node").alias("node"), F.col("last.size").alias("size")),
        )

    def leaf_pairs(self, leaves: DataFrame, roots: DataFrame | None, every: bool) -> DataFrame:
        """Likely pairs (a, b) inside leaves, between different components where these are known."""
        known = self.classes.select("class", "n", "sketch")
        known = known.withColumn("root", F.col("class")) if roots is None else self.rooted(known, roots)
        rows = leaves.join(known, "class")
        if roots is not None:
            mixed = rows.groupBy("node").agg(F.min("root").alias("r0"), F.max("root").alias("r1")).where("r0 <> r1")
            rows = rows.join(mixed.select("node"), "node", "left_semi")
        rows = rows.select("node", "class", "n", "sketch", "root").repartition("node").sortWithinPartitions("node", "class")
        return rows.mapInArrow(lambda parts: _sketch_pairs(parts, every), "a binary, b binary").distinct()

    def star_pairs(self, big: DataFrame) -> DataFrame:
        """Members of each large node, paired with the member closest to the node's consensus."""
        rows = big.select("node", "class", "size").join(self.classes.select("class", "n", "sketch"), "class")
        # The consensus is read off about 256 members; every member is then compared with it.
        draw = F.pmod(F.xxhash64("class"), F.lit(1 << 20)) * F.col("size") < F.lit(256 << 20)
        drawn = rows.where(draw).select("node", "sketch").repartition("node").sortWithinPartitions("node")
        modes = drawn.mapInArrow(_consensus, "at bigint, mode binary")
        scored = rows.join(modes, F.col("node") == F.col("at")).select("node", "class", "n", "sketch", "mode")
        scored = scored.mapInArrow(_agreement("sketch", "mode", "alike"), "node bigint, class binary, n bigint, alike int")
        centre = scored.groupBy("node").agg(F.max(F.struct("alike", "class", "n")).alias("c"))
        centre = centre.select(F.col("node").alias("at"), F.col("c.class").alias("hub"), F.col("c.n").alias("hub_n"))
        centre = centre.join(self.classes.select(F.col("class").alias("hub"), F.col("sketch").alias("hub_sketch")), "hub")
        pairs = rows.join(centre, F.col("node") == F.col("at")).where(
            (F.col("class") != F.col("hub"))
            & (100 * F.least("n", "hub_n") >= SIMILAR * F.greatest("n", "hub_n"))
        ).select("class", "hub", "sketch", "hub_sketch")
        alike = pairs.mapInArrow(_agreement("sketch", "hub_sketch", "alike"), "class binary, hub binary, alike int")
        return alike.where(F.col("alike") >= LIKELY * _HASHES).select(
            F.least("class", "hub").alias("a"), F.greatest("class", "hub").alias("b")
        ).distinct()

    def block_pairs(self, big: DataFrame, roots: DataFrame) -> DataFrame:
        """What no round could separate: every member outside a node's main component against all its members."""
        rows = self.rooted(big.select("node", "class").join(self.classes.select("class", "n", "sketch"), "class"), roots)
        counts = rows.groupBy("node", "root").agg(F.count("*").alias("c"))
        main = counts.groupBy("node").agg(F.max(F.struct("c", "root")).alias("m")).select(F.col("node").alias("at"), F.col("m.root").alias("main"))
        minor = rows.join(main, F.col("node") == F.col("at")).where("root <> main").select(
            F.col("node").alias("at"), F.col("class").alias("hub"), F.col("n").alias("hub_n"), F.col("sketch").alias("hub_sketch"), F.col("root").alias("hub_root")
        )
        pairs = rows.join(minor, F.col("node") == F.col("at")).where(
            (F.col("root") != F.col("hub_root")) & (100 * F.least("n", "hub_n") >= SIMILAR * F.greatest("n", "hub_n"))
        ).select("class", "hub", "sketch", "hub_sketch")
        alike = pairs.mapInArrow(_agreement("sketch", "hub_sketch", "alike"), "class binary, hub binary, alike int")
        return alike.where(F.col("alike") >= LIKELY * _HASHES).select(
            F.least("class", "hub").alias("a"), F.greatest("class", "hub").alias("b")
        ).distinct()

    def rooted(self, rows: DataFrame, roots: DataFrame) -> DataFrame:
        named = roots.select(F.col("node").alias("__member"), F.col("root").alias("__root"))
        return rows.join(named, F.col("class") == F.col("__member"), "left").withColumn(
            "root", F.coalesce("__root", "class")
        ).drop("__member", "__root")

    def confirmed(self, pairs: DataFrame) -> DataFrame:
        """The pairs whose full sets reach the similarity. Only sets that are in a pair are built again and moved.

        A bit field of fixed size, set at the hashed keys of these classes, tells which texts to
        look at; a text it lets through by chance is dropped by the join on the class.
        """
        width = self.width
        wanted = pairs.select(F.col("a").alias("class")).unionByName(pairs.select(F.col("b").alias("class"))).distinct()
        spot = F.pmod(F.xxhash64("key"), F.lit(MARKS))
        marks = self.classes.join(wanted, "class", "left_semi").select(spot.alias("h")).groupBy(
            F.shiftright("h", 5).alias("at")
        ).agg(F.expr("bit_or(shiftleft(1L, cast(h & 31 as int)))").alias("bits")).toArrow()  # bounded by MARKS / 32 rows
        field = np.zeros(MARKS // 32, np.uint32)
        field[marks.column("at").to_numpy()] = marks.column("bits").to_numpy().astype(np.uint32)
        shared = self.docs.sparkSession.sparkContext.broadcast(field.tobytes())
        rows = self.docs.select(F.col(self.key).alias("key"), F.col(self.text).alias("text")).select(spot.alias("h"), "text")

        def build(parts):
            field, memo = np.frombuffer(shared.value, np.uint32), Words()
            for part in parts:
                h = part.column(0).to_numpy()
                marked = (field[h >> 5] >> (h & 31).astype(np.uint32)) & np.uint32(1)
                texts = [t or "" for t in part.column(1).filter(pa.array(marked.astype(bool))).to_pylist()]
                for i, j in _slices(texts):
                    sets = [s.tobytes() for s in shingle_sets(texts[i:j], width, memo) if len(s)]
                    names = [xxhash.xxh3_128_digest(s) for s in sets]
                    yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(sets, pa.binary())], names=["class", "members"])

        sets = rows.mapInArrow(build, "class binary, members binary")
        sets = cut_lineage(sets.join(wanted, "class", "left_semi").dropDuplicates(["class"]))
        both = pairs.join(sets.select(F.col("class").alias("a"), F.col("members").alias("x")), "a").join(
            sets.select(F.col("class").alias("b"), F.col("members").alias("y")), "b"
        ).select("a", "b", "x", "y")

        def check(parts):
            for part in parts:
                a, b, x, y = (part.column(c).to_pylist() for c in ("a", "b", "x", "y"))
                ok = []
                for p, q in zip(x, y):
                    p, q = np.frombuffer(p, np.uint64), np.frombuffer(q, np.uint64)
                    if len(p) > len(q):
                        p, q = q, p
                    at = np.minimum(np.searchsorted(q, p), len(q) - 1)
                    common = int((q[at] == p).sum())
                    ok.append(100 * common >= SIMILAR * (len(p) + len(q) - common))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a, pa.binary()), pa.array(b, pa.binary()), pa.array(ok, pa.bool_())], names=["a", "b", "ok"]
                )

        return cut_lineage(both.mapInArrow(check, "a binary, b binary, ok boolean"))

    def run(self, rounds: int = 2) -> DataFrame | None:
        """(node, root) of all linked classes, or None without links."""
        tested = links = roots = None

        def test(pairs):
            nonlocal tested, links, roots
            pairs = cut_lineage(pairs if tested is None else pairs.distinct().join(tested, ["a", "b"], "left_anti"))
            if not pairs.limit(1).count():
                return
            found = self.confirmed(pairs)
            tested = found.select("a", "b") if tested is None else tested.unionByName(found.select("a", "b"))
            good = found.where("ok").select("a", "b")
            if good.limit(1).count():
                # What is connected already counts as a star of its root.
                links = good if roots is None else good.unionByName(roots.select(F.col("node").alias("a"), F.col("root").alias("b")))
                roots = cut_lineage(components(links))

        small, big = self.first_branching()
        for depth in range(1, rounds + 1):
            more, big = self.recursion(big, 2 if depth == 1 else (depth - 1) * LEVELS + 1, depth * LEVELS)
            small = small.unionByName(more)
            pairs = self.leaf_pairs(small, roots, every=depth > 1)
            test(pairs.unionByName(self.star_pairs(big)).distinct() if big.limit(1).count() else pairs)
            big = self.mixed(big, self.known(roots))
            if not big.limit(1).count():
                break
            if depth < rounds:
                longer = self.branches(depth + 1).withColumnRenamed("class", "__c").withColumnRenamed("tree", "__t")
                big = big.select("class", "tree").join(
                    longer, (F.col("class") == F.col("__c")) & (F.col("tree") == F.col("__t"))
                ).select("class", "tree", "way")
            else:
                test(self.block_pairs(big, self.known(roots)))
        if tested is not None:  # likely pairs that a failed one was to stand for
            test(self.leaf_pairs(small, self.known(roots), every=True))
        return roots

    def known(self, roots: DataFrame | None) -> DataFrame:
        """The roots so far; an empty table before the first link."""
        if roots is not None:
            return roots
        return self.classes.where(F.lit(False)).select(F.col("class").alias("node"), F.col("class").alias("root"))

    def mixed(self, big: DataFrame, roots: DataFrame) -> DataFrame:
        """Rows of the large nodes that hold more than one component."""
        rows = self.rooted(big, roots)
        nodes = rows.groupBy("node").agg(F.min("root").alias("r0"), F.max("root").alias("r1")).where("r0 <> r1")
        return cut_lineage(rows.join(nodes.select("node"), "node", "left_semi").drop("root"))


def find_duplicates(docs: DataFrame, width: int = 5, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: key, n_shingles, component_id, kept, group.

    Documents are linked at a Jaccard similarity of 0.8 or more between their distinct
    shingles of ``width`` lower-cased (A-Z) words; ``component_id`` is the smallest key that
    links reach, ``kept`` marks the rows that carry it and ``group`` names equal sets. A text
    with fewer words is one shingle; null, empty and blank texts have none and are linked
    with nothing. Equal texts are linked. Repeated rows stay, each with its result; a null
    key is never the smallest unless a whole component has no key. Keys need an order and
    may repeat.
    """
    join = Join(docs, width, key, text)
    roots = join.run()
    classes = join.classes.select("class", "key")
    rooted = join.rooted(classes, join.known(roots))
    least = rooted.groupBy("root").agg(F.min("key").alias("component_id"))
    named = rooted.select("class", "root").join(least, "root").select(F.col("class").alias("__c"), "component_id")
    rows = join.rows.join(named, F.col("class") == F.col("__c"), "left")
    component = F.when(F.col("class").isNull(), F.col("key")).otherwise(F.col("component_id"))
    return rows.select(
        F.col("key").alias(key), F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.col("key").eqNullSafe(component).alias("kept"), F.hex("class").alias("group"),
    )


def drop_duplicates(docs: DataFrame, width: int = 5, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each group of near copies, the one with the smallest key; columns unchanged.

    Rows without words are no copies of anything and all stay.
    """
    found = find_duplicates(docs, width, key, text)
    keep = found.where("kept and n_shingles > 0").select(F.col(key).alias("__k"), F.col("group").alias("__g")).distinct()

    def make():
        memo = Words()

        def mapper(texts):
            sets = [s for a, b in _slices(texts) for s in shingle_sets(texts[a:b], width, memo)]
            return [[xxhash.xxh3_128_hexdigest(s.tobytes()).upper() if len(s) else None for s in sets]]

        return mapper

    plain = docs.toDF(*[f"__c{i}" for i in range(len(docs.columns))])
    own = [f"__c{docs.columns.index(c)}" for c in (key, text)]
    marked = add_columns(plain, make, "__group string", own[1], without(plain, ["__group"]))
    twice = marked.where("__group is not null").join(
        keep, (F.col(own[0]).eqNullSafe(F.col("__k"))) & (F.col("__group") == F.col("__g")), "left_semi"
    ).dropDuplicates([own[0], "__group"])
    return twice.unionByName(marked.where("__group is null")).select(*plain.columns).toDF(*docs.columns)
