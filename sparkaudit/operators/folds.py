"""Fold assignment: repeatable, balanced, and without a global sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import hash32
from ..functions.ordered import hash_position
from ..functions.quantiles import order_statistics

DEFAULT_SEEDS = (0, 1, 7, 42, 123)


def kfold(df: DataFrame, key: str, k: int = 5, seed: int = 42) -> DataFrame:
    """Shuffled K-fold; fold sizes differ by at most one."""
    hashed = df.withColumn("__h", hash32(F.lit(seed), F.col(key)))
    ranked = hash_position(hashed, [], "__h", key, "__p")
    return ranked.withColumn("fold", F.pmod("__p", F.lit(k)).cast("int")).drop("__h", "__p")


def stratified_kfold(df: DataFrame, label: str, key: str, k: int = 5, seed: int = 42) -> DataFrame:
    """K-fold within each class; per class, fold sizes differ by at most one."""
    hashed = df.withColumn("__h", hash32(F.lit(seed), F.col(key)))
    ranked = hash_position(hashed, [label], "__h", key, "__p")
    return ranked.withColumn("fold", F.pmod("__p", F.lit(k)).cast("int")).drop("__h", "__p")


def seeded_folds(
    df: DataFrame, key: str, label: str | None = None, k: int = 5, seeds: Sequence[int] = DEFAULT_SEEDS
) -> DataFrame:
    """One row per (seed, row) with its fold; stratified when a label is given."""
    expanded = df.withColumn("seed", F.explode(F.array(*[F.lit(s) for s in seeds])))
    hashed = expanded.withColumn("__h", hash32(F.col("seed"), F.col(key)))
    by = ["seed"] + ([label] if label else [])
    ranked = hash_position(hashed, by, "__h", key, "__p")
    return ranked.withColumn("fold", F.pmod("__p", F.lit(k)).cast("int")).drop("__h", "__p")


def time_blocks(df: DataFrame, ts: str, key: str, k: int = 5) -> DataFrame:
    """``ordered_blocks`` by a time column; rows without time belong to no block."""
    numbered = df.withColumn("__t", F.unix_micros(F.col(ts).cast("timestamp")))
    return ordered_blocks(numbered, "__t", key, k).drop("__t")


def ordered_blocks(df: DataFrame, order: str, key: str, k: int = 5) -> DataFrame:
    """Expanding-window split: block 0 only trains, block i is tested after training on 0..i-1.

    Test blocks hold ``n // (k + 1)`` rows, the rest goes to the first block. Only the
    k boundary rows are looked up; the table itself is not sorted. Rows without a number
    to order by belong to no block (NULL) and do not count.
    """
    n = df.agg(F.count(order)).first()[0]
    size = n // (k + 1)
    block = F.lit(0)
    edges = order_statistics(df, order, key, [n - (k + 1 - i) * size for i in range(1, k + 1)]) if size else []
    for i, (t, tie) in enumerate(edges, start=1):
        after = (F.col(order) > F.lit(t)) | ((F.col(order) == F.lit(t)) & (F.col(key) >= F.lit(tie)))
        block = F.when(after, i).otherwise(block)
    return df.withColumn("block", F.when(F.col(order).isNotNull(), block))


def membership(folds: DataFrame, k: int = 5) -> DataFrame:
    """(row, split) with its role. Only for models that need the rows themselves;
    additive statistics use total minus fold instead."""
    splits = folds.withColumn("split", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))
    return splits.withColumn("role", F.when(F.col("fold") == F.col("split"), "test").otherwise("train"))


def strategy(is_time_series: Column, task: Column, min_share: Column) -> Column:
    """Which splitter fits a run: time order first, then class balance."""
    return (
        F.when(is_time_series, "TimeSeriesSplit")
        .when((task == "classification") | (min_share < 0.2), "StratifiedKFold")
        .otherwise("KFold")
    )
