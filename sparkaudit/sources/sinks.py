"""Writers and text views of results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FINDING_COLUMNS = ("check_id", "severity", "message", "location", "evidence")


def finding_lines(findings: DataFrame, key: str = "run_id") -> DataFrame:
    """The ``FINDING|...`` text view."""
    parts = [F.lit("FINDING"), *[F.coalesce(F.col(c), F.lit("")) for c in FINDING_COLUMNS]]
    return findings.select(key, F.concat_ws("|", *parts).alias("line"))


def result_json(results: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """One JSON document per key."""
    return results.select(key, F.to_json(F.struct(*columns)).alias("result"))


def write_json(df: DataFrame, folder: str) -> None:
    df.write.mode("overwrite").json(folder)


def write_table(df: DataFrame, folder: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(folder)


def score_card(panel: DataFrame, key: str, rows: Sequence[tuple[str, str, str]]) -> DataFrame:
    """A wide trust row as (metric, value, note) rows: label, value column, note column."""
    cells = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(label).alias("metric"),
                    F.col(value).cast("string").alias("value"),
                    F.col(note).cast("string").alias("note"),
                )
                for label, value, note in rows
            ]
        )
    ).alias("cell")
    return panel.select(key, cells).select(key, "cell.*")
