"""First look at a table: shape, types, missing values, distribution, task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from ..functions.hashing import hash32
from ..functions.quantiles import quantile_columns


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, NumericType) and f.name not in exclude]


def text_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, StringType) and f.name not in exclude]


def select_features(df: DataFrame, wanted: Sequence[str], target: str) -> list[str]:
    """The wanted columns that exist; if none does, all but the target."""
    found = [c for c in wanted if c in df.columns]
    return found or [c for c in df.columns if c != target]


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows")).withColumn(
        "n_columns", F.lit(len(df.columns)).cast("bigint")
    )


def dtypes(df: DataFrame) -> DataFrame:
    """One row per column, with the share of filled values next to the type."""
    kinds = F.create_map(*[F.lit(x) for name, kind in df.dtypes for x in (name, kind)])
    filled = long_aggregate(df, df.columns, {"n_filled": lambda c: F.count(c)})
    return filled.withColumn("dtype", kinds[F.col("column")])


def long_aggregate(df: DataFrame, columns: Sequence[str], measures: dict) -> DataFrame:
    """Aggregate all columns in one scan, then turn the single row into one per column."""
    wide = df.agg(
        *[
            F.struct(F.lit(c).alias("column"), *[m(F.col(c)).alias(n) for n, m in measures.items()]).alias(f"__{i}")
            for i, c in enumerate(columns)
        ]
    )
    cells = F.explode(F.array(*[F.col(f"__{i}") for i in range(len(columns))])).alias("cell")
    return wide.select(cells).select("cell.*")


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return long_aggregate(df, columns or df.columns, {"n_null": lambda c: F.count_if(c.isNull())})


def null_ratio(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    share = long_aggregate(
        df,
        columns or df.columns,
        {"null_ratio": lambda c: F.avg(F.when(c.isNull(), 1.0).otherwise(0.0))},
    )
    return share.withColumn("null_ratio", F.round("null_ratio", 3))


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, std, min, quartiles and max per numeric column."""
    moments = long_aggregate(
        df,
        columns,
        {
            "n": lambda c: F.count(c),
            "mean": lambda c: F.avg(c),
            "std": lambda c: F.stddev_samp(c.cast("double")),
            "min": lambda c: F.min(c.cast("double")),
            "max": lambda c: F.max(c.cast("double")),
        },
    )
    cuts = quantile_columns(df, columns, [0.25, 0.5, 0.75])
    return moments.join(F.broadcast(cuts), "column", "left").select(
        "column", "n", "mean", "std", "min",
        F.col("q")[0].alias("q25"), F.col("q")[1].alias("q50"), F.col("q")[2].alias("q75"), "max",
    )


def distinct_counts(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> DataFrame:
    """Distinct non-NULL values per column.

    Exact mode shuffles (column, value) pairs after a map-side distinct, so a hot
    value costs one row per task.
    """
    if approximate:
        return long_aggregate(df, columns, {"ndv": lambda c: F.approx_count_distinct(c)})
    pairs = F.explode(
        F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("v")) for c in columns])
    ).alias("p")
    seen = df.select(pairs).select("p.*").distinct()
    return seen.groupBy("column").agg(F.count("v").alias("ndv"))


def infer_task(df: DataFrame, columns: Sequence[str], max_classes: int = 10) -> DataFrame:
    """Task each column would pose as a target: text or few values means classification."""
    is_text = F.col("column").isin(text_columns(df))
    return distinct_counts(df, columns).select(
        "column",
        "ndv",
        F.when(is_text | (F.col("ndv") < max_classes), "classification").otherwise("regression").alias("task"),
    )


def class_shares(df: DataFrame, target: str) -> DataFrame:
    """Rows and share per class; the window runs over one row per class."""
    counts = df.where(F.col(target).isNotNull()).groupBy(target).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("total"))
    return counts.crossJoin(F.broadcast(total)).select(
        F.col(target).alias("label"), "n", (F.col("n") / F.col("total")).alias("share")
    )


def hash_sample(df: DataFrame, key: str, one_in: int) -> DataFrame:
    """A repeatable sample for a scatter plot: about one row in ``one_in``."""
    return df.where(F.pmod(hash32(F.col(key)), F.lit(one_in)) == 0)


def scatter_points(df: DataFrame, key: str, features: Sequence[str], target: str, one_in: int) -> DataFrame:
    cells = F.explode(
        F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("x")) for c in features])
    ).alias("cell")
    sampled = hash_sample(df, key, one_in)
    return sampled.select(key, cells, F.col(target).cast("double").alias("y")).select(
        key, "cell.feature", "cell.x", "y"
    )
