"""Merkle manifest of a table of documents, proven by octopus multiproofs.

Every group of rows (a source) is a tree over its leaves in key order, and the groups'
roots are the leaves of one more tree. Nodes are computed in blocks of ``ARITY ** SPAN``
neighbours, a few rounds for any size. To prove rows, leaves are cut into parts; a part
computes which node coordinates it cannot derive from its own leaves (the arms of the
octopus: the minimal union over all its leaves), fetches each of them once, derives the
inner nodes that its leaves share, and expands every leaf's own proof from them.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ordered import position
from ..session import cut_lineage

ARITY, SPAN, PART, CUTS = 3, 8, 4096, 1024
_STEPS = "array<struct<before:string,after:string>>"


def _hash(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def row_hash(fields: Sequence[Column]) -> Column:
    """SHA-256 over the fields, each as its UTF-8 byte count, a colon and its value, or ``-`` for null."""
    texts = [f.cast("string") for f in fields]
    shown = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.encode(F.concat(*shown), "utf-8"), 256)


@dataclass
class Manifest:
    """``leaves`` (tree, idx, key, leaf, claimed), ``nodes`` (tree, level, idx, h), ``trees`` (tree, n, subroot, path), root."""

    leaves: DataFrame
    nodes: DataFrame
    trees: DataFrame
    root: str | None


def _placed(rows: DataFrame) -> DataFrame:
    """Adds ``idx``, the place of a leaf in its tree by key (nulls first), then by leaf.

    Keys are cut at quantiles, and the rows of one frequent key by their hashes, so that no
    task sorts a whole tree; only rows that are equal in full stay together.
    """
    probes = ", ".join(f"{i / CUTS}D" for i in range(1, CUTS))
    found = rows.agg(F.expr(f"percentile_approx(cast(key as double), array({probes}), {4 * CUTS})")).first()[0]
    cuts = sorted(set(found or [0.0]))
    stage = Bucketizer(
        splits=[float("-inf"), *cuts, float("inf")], inputCol="__value", outputCol="__bucket", handleInvalid="keep"
    )
    cut = stage.transform(rows.withColumn("__value", F.col("key").cast("double")))
    prefix = F.conv(F.substring("leaf", 1, 3), 16, 10).cast("bigint")
    lower = F.element_at(F.array(*map(F.lit, cuts)), F.greatest(F.col("__bucket").cast("int"), F.lit(1)))
    one_key = (F.col("__bucket") > 0) & (F.col("__value") == lower)
    chunk = F.when(F.col("key").isNull(), prefix - 4096).otherwise(
        F.col("__bucket").cast("bigint") * 4097 + F.when(one_key, prefix).otherwise(4096)
    )
    order = [F.col("key").asc_nulls_first(), "leaf", "claimed"]
    return position(cut, ["tree"], chunk, order, "idx").drop("__value", "__bucket")


def _placed_trees(trees: DataFrame) -> DataFrame:
    """Adds ``idx``, the place of a tree by name, with names cut at a bounded hash sample of them."""
    total = max(1, trees.count())
    share = int(min(1.0, 2 * CUTS / total) * (1 << 40))
    sample = trees.where(F.pmod(F.xxhash64("tree"), F.lit(1 << 40)) < share).select("tree").orderBy("tree").collect()
    cuts = [r["tree"] for r in sample][:: max(1, len(sample) // 256)]
    chunk = F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c <= F.col("tree"))) if cuts else F.lit(0)
    return position(trees.withColumn("top", F.lit("")), ["top"], chunk, ["tree"], "idx")


def _groups(parts, keys: int):
    """(key, rows of columns) of each run of equal leading columns in sorted batches; a group is bounded by its maker."""
    key, held = None, []
    for part in parts:
        columns = [c.to_pylist() for c in part.columns]
        lead = list(zip(*columns[:keys]))
        edges = [0, *[i for i in range(1, len(lead)) if lead[i] != lead[i - 1]], len(lead)]
        for a, b in zip(edges, edges[1:]):
            if a == b:
                continue
            if lead[a] != key:
                if held:
                    yield key, held
                key, held = lead[a], []
            held += zip(*[c[a:b] for c in columns[keys:]])
    if held:
        yield key, held


def _nodes(leaves: DataFrame, sizes: DataFrame) -> DataFrame:
    """(tree, level, idx, h) of all nodes, leaves included; each round computes SPAN levels in blocks."""
    block = ARITY**SPAN
    largest = sizes.agg(F.max("n")).first()[0] or 0
    all_nodes = leaves.select("tree", F.lit(0).alias("level"), "idx", "h")
    below, level = all_nodes, 0
    while largest > 1:
        wide = ARITY**level
        heads = sizes.select(
            "tree", ((F.col("n") + (wide - 1)) / wide).cast("bigint").alias("n") if level else F.col("n")
        ).where("n > 1").select(
            "tree", F.explode(F.expr(f"sequence(0L, (n - 1) div {block})")).alias("block"), F.lit(-1).cast("bigint").alias("idx"),
            F.lit(None).cast("string").alias("h"), "n",
        )
        members = below.where(F.col("level") == level).select(
            "tree", F.expr(f"idx div {block}").alias("block"), "idx", "h", F.lit(None).cast("bigint").alias("n")
        )
        met = heads.unionByName(members).repartition("tree", "block").sortWithinPartitions("tree", "block", "idx")

        def run(parts, level=level):
            for (tree, number), rows in _groups(parts, 2):
                if rows[0][2] is None:  # the root of a finished tree
                    continue
                n, own, first, out = rows[0][2], [r[1] for r in rows[1:]], number * block, []
                for up in range(1, SPAN + 1):
                    if n == 1:
                        break
                    own = [_hash("".join(own[i : i + ARITY])) for i in range(0, len(own), ARITY)]
                    n, first = -(-n // ARITY), first // ARITY
                    out += [(level + up, first + i, h) for i, h in enumerate(own)]
                yield pa.RecordBatch.from_arrays([
                    pa.array([tree] * len(out), pa.string()), pa.array([r[0] for r in out], pa.int32()),
                    pa.array([r[1] for r in out], pa.int64()), pa.array([r[2] for r in out], pa.string()),
                ], names=["tree", "level", "idx", "h"])

        below = cut_lineage(met.mapInArrow(run, "tree string, level int, idx bigint, h string"))
        all_nodes = all_nodes.unionByName(below)
        level += SPAN
        largest = -(-largest // ARITY**SPAN)
    return all_nodes


def missing(own: np.ndarray, n: int) -> list[tuple[int, int]]:
    """Coordinates (level, idx) that the leaves ``own`` of a tree of ``n`` need besides what they derive."""
    out, level = [], 0
    while n > 1:
        groups = np.unique(own // ARITY)
        run = (groups[:, None] * ARITY + np.arange(ARITY)).ravel()
        out += [(level, i) for i in np.setdiff1d(run[run < n], own, assume_unique=True).tolist()]
        own, n, level = groups, -(-n // ARITY), level + 1
    return out


def expand(leaves: dict[int, str], fetched: dict[tuple[int, int], str], n: int) -> dict[int, list[tuple[str, str]]]:
    """For each leaf the siblings before and after it, level by level; inner nodes shared by leaves are derived once."""
    steps: dict[int, list[tuple[str, str]]] = {i: [] for i in leaves}
    known, level = dict(leaves), 0
    for (at, i), h in fetched.items():
        if not at:
            known[i] = h
    inside = sorted(leaves)
    while n > 1:
        runs = {}
        for group in {i // ARITY for i in inside}:
            first = group * ARITY
            runs[group] = [known[i] for i in range(first, min(first + ARITY, n))]
        width = ARITY**level
        for leaf, path in steps.items():
            at = leaf // width
            run, spot = runs[at // ARITY], at % ARITY
            path.append(("".join(run[:spot]), "".join(run[spot + 1 :])))
        inside = sorted(runs)
        known = {group: _hash("".join(run)) for group, run in runs.items()}
        n, level = -(-n // ARITY), level + 1
        known |= {i: h for (at, i), h in fetched.items() if at == level}
    return steps


def fold(leaf: str, steps) -> str:
    """The root that a leaf and its siblings give."""
    for before, after in steps:
        leaf = _hash(before + leaf + after)
    return leaf


def _proofs(rows: DataFrame, nodes: DataFrame, trees: DataFrame, root: str | None, with_proofs: bool) -> DataFrame:
    """Proofs of ``rows`` (tree, idx, key, leaf, claimed), continued by each tree's own ``path`` to ``root``."""
    part = F.expr(f"idx div {PART}")
    cells = rows.select("tree", part.alias("part"), "idx").groupBy("tree", "part")
    present = cells.agg(F.count("*").alias("rows")).join(trees, "tree")

    def ask(parts):
        for (tree, number), members in _groups(parts, 2):
            if members[0][1] is None:
                continue
            own = np.unique(np.array([m[0] for m in members[1:]], np.int64))
            found = missing(own, members[0][1])
            yield pa.RecordBatch.from_arrays([
                pa.array([tree] * len(found), pa.string()), pa.array([number] * len(found), pa.int64()),
                pa.array([c[0] for c in found], pa.int32()), pa.array([c[1] for c in found], pa.int64()),
            ], names=["tree", "part", "level", "idx"])

    nothing = F.lit(None)
    heads = present.select("tree", "part", F.lit(-1).cast("bigint").alias("idx"), "n")
    leaves = rows.select("tree", part.alias("part"), "idx", nothing.cast("bigint").alias("n"))
    asked = (
        heads.unionByName(leaves).repartition("tree", "part").sortWithinPartitions("tree", "part", "idx")
        .mapInArrow(ask, "tree string, part bigint, level int, idx bigint")
    )
    fetched = asked.join(nodes, ["tree", "level", "idx"])

    key_type = rows.schema["key"].dataType.simpleString()
    fields = [
        ("key", key_type), ("claimed", "string"), ("n", "bigint"), ("subroot", "string"), ("path", _STEPS),
    ]
    lead = ["tree", "part", "kind", "level", "idx", "h"]

    def shaped(df: DataFrame, kind: int, has: Sequence[str]) -> DataFrame:
        level = F.col("level") if kind == 1 else F.lit(0)
        return df.select(
            "tree", "part", F.lit(kind).alias("kind"), level.alias("level"),
            F.col("idx") if kind else F.lit(0).cast("bigint").alias("idx"),
            F.col("h") if kind else nothing.cast("string").alias("h"),
            *[F.col(c) if c in has else nothing.cast(t).alias(c) for c, t in fields],
        )

    met = (
        shaped(present, 0, ["n", "subroot", "path"])
        .unionByName(shaped(fetched, 1, []))
        .unionByName(shaped(rows.withColumn("part", part).withColumnRenamed("leaf", "h"), 2, ["key", "claimed"]))
        .repartition("tree", "part").sortWithinPartitions(*lead[:5])
    )
    schema = (
        f"tree string, idx bigint, key {key_type}, leaf string, subroot string, proof_sha256 string, folded_root string"
        + (f", proof {_STEPS}" if with_proofs else "")
    )
    names = [f.split()[0] for f in schema.split(", ")]

    def tell(parts):
        for (tree, _), members in _groups(parts, 2):
            head = members[0]
            n, subroot, path = head[6], head[7], [(s["before"], s["after"]) for s in head[8]]
            arms = {(m[1], m[2]): m[3] for m in members if m[0] == 1}
            own = [m for m in members if m[0] == 2]
            steps = expand({m[2]: m[3] for m in own}, arms, n)
            out = []
            for _, _, idx, leaf, key, claimed, *_ in own:
                proof = steps[idx] + path
                siblings = _hash("".join([x for step in proof for x in step]))
                row = (tree, idx, key, leaf, subroot, siblings, fold(claimed, proof))
                out.append((*row, [{"before": b, "after": a} for b, a in proof]) if with_proofs else row)
            yield pa.RecordBatch.from_pydict(dict(zip(names, map(list, zip(*out)))), schema=arrow)

    from pyspark.sql.pandas.types import to_arrow_schema

    from .batches import ddl

    arrow = to_arrow_schema(ddl(schema))
    proven = met.mapInArrow(tell, schema)
    return proven.select("*", F.lit(root).cast("string").alias("root")).withColumn(
        "verified", F.col("folded_root") == F.col("root")
    )


def build(
    docs: DataFrame, fields: Sequence[str], key: str = "doc_id", group: str = "source", claimed: Column | None = None,
) -> Manifest:
    """The manifest of all rows; ``claimed`` is the leaf to be checked later (by default the leaf itself).

    A group's leaves ascend by key (a number; null first), rows with the same key by leaf.
    Null is a group of its own, before all others. Null fields have their own mark, so a null and
    an empty text differ. An empty table has no trees and no root. Further columns are not read.
    """
    leaf = row_hash([docs[f] for f in fields])
    rows = docs.select(
        F.coalesce(F.concat(F.lit("="), docs[group].cast("string")), F.lit("")).alias("tree"), docs[key].alias("key"),
        leaf.alias("leaf"), (leaf if claimed is None else claimed).alias("claimed"),
    )
    leaves = cut_lineage(_placed(cut_lineage(rows)))
    sizes = cut_lineage(leaves.groupBy("tree").agg(F.count("*").alias("n")))
    nodes = _nodes(leaves.select("tree", "idx", F.col("leaf").alias("h")), sizes)
    tops = _tops(nodes, sizes)
    placed = cut_lineage(_placed_trees(tops))
    total = placed.count()
    if not total:
        none = sizes.select("*", F.lit("").alias("subroot"), F.array().cast(_STEPS).alias("path"))
        return Manifest(leaves, nodes, none, None)
    above = placed.select(F.col("top").alias("tree"), "idx", F.col("tree").alias("key"), F.col("h").alias("leaf"), F.col("h").alias("claimed"))
    one = placed.groupBy(F.col("top").alias("tree")).agg(F.count("*").alias("n"))
    upper = _nodes(above.select("tree", "idx", F.col("leaf").alias("h")), one)
    root = _tops(upper, one).first()["h"]
    single = one.select("tree", "n", F.lit(root).alias("subroot"), F.array().cast(_STEPS).alias("path"))
    paths = _proofs(above, upper, single, root, True).select(F.col("key").alias("tree"), F.col("leaf").alias("subroot"), F.col("proof").alias("path"))
    return Manifest(leaves, nodes, cut_lineage(sizes.join(paths, "tree")), root)


def _tops(nodes: DataFrame, sizes: DataFrame) -> DataFrame:
    """(tree, h): the node of each tree's highest level."""
    height = F.lit(0)
    for level in range(40):  # 3 ** 39 leaves are beyond a long
        height = height + (F.col("n") > ARITY**level).cast("int")
    high = sizes.select("tree", height.alias("level"))
    return nodes.where("idx = 0").join(high, ["tree", "level"]).select("tree", "h")


def prove(manifest: Manifest, wanted: DataFrame | None = None, with_proofs: bool = False) -> DataFrame:
    """One row per leaf: key, leaf, subroot, root, ``proof_sha256``, ``folded_root``, ``verified``; all leaves by default.

    ``wanted`` (column ``key``) restricts the rows to prove; parts then fetch what these
    rows need. ``proof_sha256`` hashes the siblings from the leaf to the root, left to
    right; ``folded_root`` is what the claimed leaf and these siblings give. With
    ``with_proofs`` the siblings come along.
    """
    rows = manifest.leaves
    if wanted is not None:
        rows = rows.join(wanted.select("key").distinct(), "key", "left_semi")
    return _proofs(rows, manifest.nodes, manifest.trees, manifest.root, with_proofs)
