"""Shards whose source mixture equals the corpus, by proportional stratified interleaving.

Rows of every source are shuffled by a seeded hash and ranked; a row's place is its
fractional rank inside its source. Cutting the rows sorted by place gives every shard the
same share of every source. DataFrame functions only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .batches import without


def _unit(text: Column) -> Column:
    """A number in [0, 1) from the leading 32 bits of a text's MD5."""
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / F.lit(float(2**32))


def interleave(
    docs: DataFrame, n_shards: int, key: str = "doc_id", stratum: str = "source",
    ties: Sequence[str] = (), seed: int = 17, chunks: int = 4096,
) -> DataFrame:
    """``docs`` with ``shard`` (0 ..) and ``slot`` (0 .. without gaps inside a shard).

    Row counts of shards differ by at most one and every source is spread over the shards
    in proportion. No source, however large, is ranked by one task: the leading bits of
    the shuffle hash cut it into ``chunks`` pieces whose counts are summed first; the
    final sort is cut by place in the same way. A null source is a source of its own, a
    null key hashes like the empty text; rows with the same key are ordered by ``ties``,
    fully equal rows arbitrarily. An empty table stays empty. Columns called ``shard`` or
    ``slot`` are replaced.
    """
    if chunks not in (256, 4096, 65536):
        raise ValueError("chunks is a power of 16 from 256 to 65536")
    digits = {256: 2, 4096: 3, 65536: 4}[chunks]
    kept = without(docs, ["shard", "slot"])
    rows = docs.select(
        *kept,
        F.coalesce(F.concat(F.lit("="), F.col(stratum).cast("string")), F.lit("")).alias("__stratum"),
        F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("")))).alias("__draw"),
    ).withColumn("__chunk", F.substring("__draw", 1, digits))

    before = Window.partitionBy("__stratum").orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy("__stratum", "__chunk").agg(F.count("*").alias("__n")).select(
        F.col("__stratum").alias("__s"), F.col("__chunk").alias("__c"),
        F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"),
        F.sum("__n").over(Window.partitionBy("__stratum")).alias("__all"),
        _unit(F.col("__stratum")).alias("__offset"),
    )
    in_chunk = Window.partitionBy("__stratum", "__chunk").orderBy("__draw", *ties)
    placed = (
        rows.withColumn("__rank", F.row_number().over(in_chunk) - 1)
        .join(starts, (F.col("__stratum") == F.col("__s")) & (F.col("__chunk") == F.col("__c")))
        .withColumn("__place", (F.col("__start") + F.col("__rank") + F.col("__offset")) / F.col("__all"))
        .select(*kept, "__draw", "__place", F.least(F.floor(F.col("__place") * chunks), F.lit(chunks - 1)).alias("__cut"))
    )

    everything = Window.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)  # over `chunks` counts
    cuts = placed.groupBy("__cut").agg(F.count("*").alias("__m")).select(F.col("__cut").alias("__b"), "__m")
    cuts = cuts.select(
        "__b", F.coalesce(F.sum("__m").over(everything), F.lit(0)).alias("__from"),
        F.sum("__m").over(Window.partitionBy()).alias("__total"),
    )
    in_cut = Window.partitionBy("__cut").orderBy("__place", "__draw", *ties)
    return (
        placed.withColumn("__rank", F.row_number().over(in_cut) - 1)
        .join(F.broadcast(cuts), F.col("__cut") == F.col("__b"))
        .withColumn("__pos", F.col("__from") + F.col("__rank"))
        .withColumn("shard", F.expr(f"cast(__pos * {n_shards} div __total as int)"))
        .withColumn("slot", F.expr(f"__pos - (shard * __total + {n_shards - 1}) div {n_shards}"))
        .select(*kept, "shard", "slot")
    )
