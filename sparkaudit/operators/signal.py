"""Which columns carry signal: correlation, ranking, descriptive tests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import gram
from ..functions.moments import pearson


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """All pairwise-complete correlations from one scan, long form; the plan does not grow with the columns."""
    found = gram.correlations(gram.pair_sums(df, columns), columns)
    return found.withColumn("r", F.round("r", 3))


def target_correlation(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """|r| of each feature with the target, one scan; value pairs are aggregated in long form."""
    values = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("x")) for c in features])
    pairs = df.select(F.col(target).cast("double").alias("y"), F.explode(values).alias("f")).select("y", "f.*")
    return pairs.groupBy("feature").agg(F.abs(pearson(F.col("x"), F.col("y"))).alias("abs_r"))


def top_features(df: DataFrame, features: Sequence[str], target: str, k: int = 4) -> DataFrame:
    ranked = target_correlation(df, features, target).where(F.col("abs_r").isNotNull())
    return ranked.orderBy(F.desc("abs_r"), "feature").limit(k)


def rank_hypotheses(
    numeric: DataFrame, gaps: DataFrame, k: int = 3, high: float = 0.3, medium: float = 0.1
) -> DataFrame:
    """Numeric |r| and group gaps in one ranking (one row per feature), with priorities."""
    signals = numeric.select("feature", F.col("abs_r").alias("signal"), F.lit("corr").alias("kind")).unionByName(
        gaps.select(F.col("dimension").alias("feature"), F.col("gap").alias("signal"), F.lit("gap").alias("kind"))
    ).where(F.col("signal").isNotNull())
    order = F.row_number().over(Window.orderBy(F.desc("signal"), "feature"))
    return (
        signals.withColumn("rank", order)
        .where(F.col("rank") <= k)
        .withColumn(
            "priority",
            F.when(F.col("signal") >= high, "high").when(F.col("signal") >= medium, "medium").otherwise("low"),
        )
    )


def features_to_use(signals: DataFrame, numeric: Sequence[str], weakest: float = 0.1) -> DataFrame:
    """Ranked features, or all numeric columns when no hypothesis carries signal."""
    best = signals.agg(F.coalesce(F.max("signal"), F.lit(0.0)).alias("best"))
    ranked = signals.select("feature").crossJoin(F.broadcast(best)).where(F.col("best") >= weakest)
    fallback = best.where(F.col("best") < weakest).select(
        F.explode(F.array(*[F.lit(c) for c in numeric])).alias("feature"), "best"
    )
    return ranked.unionByName(fallback.select("feature", "best")).select(
        "feature",
        F.when(F.col("best") >= weakest, "hypothesis").otherwise("all_numeric").alias("source"),
    )


# ---- descriptive tests ---------------------------------------------------

def welch_t(df: DataFrame, group: str, value: str, a, b) -> DataFrame:
    """Two-sample t statistic with unequal variances, and its degrees of freedom."""
    v = F.col(value).cast("double")
    side = {n: F.when(F.col(group) == g, v) for n, g in (("a", a), ("b", b))}
    m = df.agg(
        *[F.count(c).alias(f"n_{s}") for s, c in side.items()],
        *[F.avg(c).alias(f"m_{s}") for s, c in side.items()],
        *[F.var_samp(c).alias(f"v_{s}") for s, c in side.items()],
    )
    ea, eb = F.col("v_a") / F.col("n_a"), F.col("v_b") / F.col("n_b")
    spread = F.nullif(ea + eb, F.lit(0.0))
    return m.select(
        "n_a", "n_b",
        ((F.col("m_a") - F.col("m_b")) / F.sqrt(spread)).alias("t"),
        (
            spread * spread
            / F.nullif(ea * ea / (F.col("n_a") - 1) + eb * eb / (F.col("n_b") - 1), F.lit(0.0))
        ).alias("df"),
    )


def anova(df: DataFrame, group: str, value: str) -> DataFrame:
    """One-way F from group moments (one row per group)."""
    v = F.col(value).cast("double")
    g = df.where(F.col(group).isNotNull() & v.isNotNull()).groupBy(group).agg(
        F.count(v).alias("n"), F.avg(v).alias("m"), F.var_pop(v).alias("v")
    )
    grand = g.agg((F.sum(F.col("n") * F.col("m")) / F.sum("n")).alias("grand"))
    t = g.crossJoin(F.broadcast(grand)).agg(
        F.sum(F.col("n") * (F.col("m") - F.col("grand")) * (F.col("m") - F.col("grand"))).alias("ssb"),
        F.sum(F.col("n") * F.col("v")).alias("ssw"),
        (F.count("*") - 1).alias("df_between"),
        (F.sum("n") - F.count("*")).alias("df_within"),
    )
    f = (F.col("ssb") / F.col("df_between")) / F.nullif(F.col("ssw") / F.col("df_within"), F.lit(0.0))
    return t.select(f.alias("f"), "df_between", "df_within")


def chi_square(df: DataFrame, a: str, b: str) -> DataFrame:
    """Independence of two categoricals from their contingency counts."""
    seen = df.where(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(a, b).agg(F.count("*").alias("n"))
    rows = seen.groupBy(a).agg(F.sum("n").alias("row_n"))
    cols = seen.groupBy(b).agg(F.sum("n").alias("col_n"))
    size = seen.agg(F.sum("n").alias("total"))
    # sum over all cells of (o - e)^2 / e  =  sum over seen cells of o^2 / e  -  total
    parts = seen.join(rows, a).join(cols, b).crossJoin(F.broadcast(size))
    square = F.col("n") * F.col("n") * (F.col("total") / F.col("row_n").cast("double") / F.col("col_n"))
    stat = parts.agg((F.sum(square) - F.max("total")).alias("chi2"))
    dof = rows.agg((F.count("*") - 1).alias("r")).crossJoin(cols.agg((F.count("*") - 1).alias("c")))
    return stat.crossJoin(dof).select("chi2", (F.col("r") * F.col("c")).alias("df"))
