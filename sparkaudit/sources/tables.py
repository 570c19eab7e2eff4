"""Tabular sources."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN counts as missing everywhere; only floating columns are touched."""
    floating = [c for c, kind in df.dtypes if kind in ("double", "float")]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floating}) if floating else df


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return nan_to_null(spark.read.parquet(f"{folder}/{name}.parquet"))


def spread(df: DataFrame, key: str) -> DataFrame:
    """The rows dealt out by ``key``, for costly steps per row: a small file is read by a task or two.

    What joins on the key later need not be shuffled again.
    """
    return df.repartition(key)


def read_delimited(
    spark: SparkSession, folder: str, schema: StructType | str, header: bool = True
) -> DataFrame:
    """Every ``*.csv`` below the folder, under one declared schema; NaN is read as NULL."""
    return nan_to_null(
        spark.read.schema(schema)
        .option("header", header)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.csv")
        .csv(folder)
    )


def file_report(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows, column count and NULL counts per source file, in one scan."""
    tagged = df.withColumn("file_path", F.col("_metadata.file_path"))
    return tagged.groupBy("file_path").agg(
        F.count("*").alias("n_rows"),
        F.lit(len(columns)).cast("bigint").alias("n_columns"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns],
    )


def latest_per_key(df: DataFrame, key: str, artifact: str, order: Sequence[str]) -> DataFrame:
    """Newest artifact of each key (last in ``order``), by a combinable aggregate."""
    return df.groupBy(key).agg(F.max_by(F.col(artifact), F.struct(*order)).alias(artifact))
