"""Target rates by group, score summaries and plot-ready rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.quantiles import quantile_columns
from ..session import cut_lineage


def overall_rate(df: DataFrame, target: str) -> DataFrame:
    return df.agg(
        F.avg(target).alias("rate"),
        F.sum(target).cast("bigint").alias("positives"),
        F.count("*").alias("n"),
    )


def rate_by(df: DataFrame, dimension: str, target: str) -> DataFrame:
    """Mean target and count per group; rows without a key are left out."""
    return (
        df.where(F.col(dimension).isNotNull())
        .groupBy(dimension)
        .agg(F.avg(target).alias("rate"), F.count(target).alias("n"))
    )


def rate_by_each(df: DataFrame, dimensions: Sequence[str], target: str) -> DataFrame:
    """``rate_by`` for many dimensions from one scan: grouping sets, long form."""
    keyed = df.select(*[F.col(d).cast("string").alias(d) for d in dimensions], target)
    sets = [[F.col(d)] for d in dimensions] + [[]]
    name = F.lit("(all)")
    value = F.lit(None).cast("string")
    for d in reversed(list(dimensions)):
        name = F.when(F.grouping(d) == 0, d).otherwise(name)
        value = F.when(F.grouping(d) == 0, F.col(d)).otherwise(value)
    grouped = keyed.groupingSets(sets, *dimensions).agg(
        name.alias("dimension"),
        value.alias("value"),
        F.avg(target).alias("rate"),
        F.count(target).alias("n"),
    )
    return grouped.select("dimension", "value", "rate", "n").where(
        (F.col("dimension") == "(all)") | F.col("value").isNotNull()
    )


def group_gap(rates: DataFrame) -> DataFrame:
    """Largest minus smallest group rate per dimension: signal of a categorical feature."""
    return (
        rates.where(F.col("dimension") != "(all)")
        .groupBy("dimension")
        .agg((F.max("rate") - F.min("rate")).alias("gap"), F.count("*").alias("n_groups"))
    )


def score_summary(scores: DataFrame, by: Sequence[str], value: str = "score") -> DataFrame:
    """Mean, population std, range, median and quartiles of fold scores."""
    q = F.percentile(F.col(value), F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    return scores.groupBy(*by).agg(
        F.count(value).alias("n"),
        F.avg(value).alias("mean"),
        F.stddev_pop(value).alias("std"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
        q[1].alias("median"),
        q[0].alias("q25"),
        q[2].alias("q75"),
    )


def boxplot_rows(scores: DataFrame, by: Sequence[str], value: str = "score") -> DataFrame:
    """Five numbers and the whiskers that reach at most 1.5 IQR beyond the box.

    Works on distinct values with counts, so repeated scores do not grow the state, and
    quartiles come from sketch-cut buckets, so no group meets in one buffer.
    """
    by = list(by)
    counted = cut_lineage(scores.groupBy(*by, value).agg(F.count("*").alias("__n")))
    box = quantile_columns(counted, [value], [0.25, 0.5, 0.75], by, "__n").select(*by, F.col("q").alias("__q"))
    lo = F.col("__q")[0] - 1.5 * (F.col("__q")[2] - F.col("__q")[0])
    hi = F.col("__q")[2] + 1.5 * (F.col("__q")[2] - F.col("__q")[0])
    return (
        counted.join(box, by)
        .groupBy(*by)
        .agg(
            F.max(F.col("__q")[0]).alias("q1"),
            F.max(F.col("__q")[1]).alias("median"),
            F.max(F.col("__q")[2]).alias("q3"),
            F.min(F.when(F.col(value) >= lo, F.col(value))).alias("whisker_low"),
            F.max(F.when(F.col(value) <= hi, F.col(value))).alias("whisker_high"),
            F.coalesce(
                F.sum(F.when((F.col(value) < lo) | (F.col(value) > hi), F.col("__n"))), F.lit(0)
            ).alias("n_outliers"),
        )
    )


def token_counts(df: DataFrame, by: str, text: str, pattern: str, minimum: int = 1) -> DataFrame:
    """How often each matched token occurs per key; kept from ``minimum`` on."""
    tokens = F.explode(F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(1))).alias("token")
    counted = df.select(by, tokens).groupBy(by, "token").agg(F.count("*").alias("n"))
    return counted.where(F.col("n") >= minimum)


def drop_class(drop_pct: Column) -> Column:
    """Weight of one feature: how far the score falls without it (percent)."""
    return F.when(drop_pct > 25, "CRITICAL").when(drop_pct > 15, "load-bearing").otherwise("")


def bar_rows(df: DataFrame, label: str, value: str, reference: Column) -> DataFrame:
    """Bars with their threshold class and the reference line."""
    return df.select(
        F.col(label).alias("label"),
        F.col(value).alias("value"),
        drop_class(F.col(value)).alias("threshold_class"),
        reference.alias("reference"),
    )


def forest_rows(tests: DataFrame) -> DataFrame:
    """Mean and interval per baseline, placed on the score axis."""
    return tests.select(
        "run_id",
        F.col("baseline").alias("label"),
        (F.col("baseline_mean") + F.col("lift")).alias("mean"),
        (F.col("baseline_mean") + F.col("ci_low")).alias("low"),
        (F.col("baseline_mean") + F.col("ci_high")).alias("high"),
    )
