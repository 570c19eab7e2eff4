"""Connected components of a link table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage


def _stars(links: DataFrame, large: bool) -> DataFrame:
    """One contraction: neighbours of a node are linked to its smallest neighbour instead.

    The large star moves the neighbours above a node, the small star those below it and the node itself.
    """
    around = links if not large else links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if not large:
        around = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = around.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
    moved = around.join(least, F.col("a") == F.col("u"))
    if large:
        moved = moved.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = moved.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select(F.col("u").alias("a"), F.col("m").alias("b"))
        )
    return moved.where(F.col("a") != F.col("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (columns ``a`` and ``b``); the root is the smallest node.

    The stars shrink in a logarithmic number of rounds; each round is written to the
    shared folder, so no lineage grows and a lost executor costs one round at most. A
    node with very many neighbours is aggregated map-side and split by the skew join.
    Null ends and links of a node to itself are ignored.
    """
    now = cut_lineage(links.select("a", "b").where("a <> b").distinct())
    before = None
    while True:
        now = cut_lineage(_stars(_stars(now, True), False))
        state = now.agg(F.count("*"), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 40)))).first()
        if state == before:
            break
        before = state
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
