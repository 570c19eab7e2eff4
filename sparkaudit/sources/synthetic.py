"""Tables with a planted signal and a planted leak, of any size, made by Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def classification(spark: SparkSession, n: int = 500, seed: int = 42) -> DataFrame:
    """Target follows feat1 and, less, feat2; feat3 is noise; leak_col is the target."""
    base = spark.range(n).select(
        "id", F.randn(seed).alias("feat1"), F.randn(seed + 1).alias("feat2"), F.randn(seed + 2).alias("feat3")
    )
    target = (F.col("feat1") + 0.4 * F.col("feat2") > 0).cast("int")
    return base.withColumn("target", target).withColumn("leak_col", F.col("target"))


def regression(spark: SparkSession, n: int = 500, seed: int = 42) -> DataFrame:
    """Target is linear in feat1 and feat2 with little noise; leak_col nearly is the target."""
    base = spark.range(n).select(
        "id", F.randn(seed).alias("feat1"), F.randn(seed + 1).alias("feat2"), F.randn(seed + 2).alias("noise"),
        F.randn(seed + 3).alias("__e"),
    )
    target = 2 * F.col("feat1") + 0.5 * F.col("feat2") + 0.1 * F.col("noise")
    return base.withColumn("target", target).withColumn("leak_col", F.col("target") + 0.001 * F.col("__e")).drop("__e")
