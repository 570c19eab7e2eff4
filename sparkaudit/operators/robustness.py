"""Does the result hold for other seeds, samples, features and slices?"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import hash32, uniform
from ..functions.ordered import hash_position
from ..functions.quantiles import order_statistics, quantile_columns
from ..session import cut_lineage
from . import linear, signal
from .folds import DEFAULT_SEEDS
from .rates import drop_class

MIN_SLICE = 30


# ---- bootstrap over rows --------------------------------------------------

def poisson_bootstrap(
    df: DataFrame, key: str, value: str, replicates: int = 2000, seed: int = 42, blocks: int = 1024
) -> DataFrame:
    """Interval of a row mean by a block bootstrap.

    One scan sums the rows into hash blocks; each replicate then draws a Poisson(1) weight
    for every block. The number of draws does not follow the number of rows.
    """
    # fixed values: cumulative Poisson(1) probabilities for 0 to 7
    steps = (0.36787944117144233, 0.7357588823428847, 0.9196986029286058, 0.9810118431238462,
             0.9963401531726563, 0.9994058151824183, 0.9999167588507119, 0.9999897508033253)
    weight = F.lit(len(steps))
    for w in reversed(range(len(steps))):
        weight = F.when(F.col("__u") < steps[w], w).otherwise(weight)
    block = F.pmod(hash32(F.lit("block"), F.col(key)), F.lit(blocks)).alias("block")
    sums = df.where(F.col(value).isNotNull()).groupBy(block).agg(F.sum(value).alias("x"), F.count("*").alias("n"))
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    reps = sums.repartition(parts, "block").select(
        "block", "x", "n", F.explode(F.sequence(F.lit(0), F.lit(replicates - 1))).alias("rep")
    )
    drawn = reps.select("rep", "x", "n", uniform(F.lit(seed), F.col("rep"), F.col("block")).alias("__u"))
    weighted = drawn.select("rep", "x", "n", weight.alias("__w"))
    means = weighted.groupBy("rep").agg(
        (F.sum(F.col("__w") * F.col("x")) / F.nullif(F.sum(F.col("__w") * F.col("n")), F.lit(0))).alias("m")
    )
    q = F.percentile("m", F.array(F.lit(0.025), F.lit(0.975)))
    return means.agg(q[0].alias("ci_low"), q[1].alias("ci_high"))


# ---- slices ---------------------------------------------------------------

def third_slices(df: DataFrame, column: str) -> DataFrame:
    """Label rows by the 33 % and 67 % quantiles of a column."""
    cuts = quantile_columns(df, [column], [0.33, 0.67]).select("q")  # one row
    joined = df.crossJoin(F.broadcast(cuts))
    label = (
        F.when(F.col(column) <= F.col("q")[0], f"by_{column}_low_33%")
        .when(F.col(column) <= F.col("q")[1], f"by_{column}_mid_33%")
        .when(F.col(column) > F.col("q")[1], f"by_{column}_high_33%")
    )
    return joined.withColumn("slice", label).drop("q").where(F.col("slice").isNotNull())


def half_slices(df: DataFrame, column: str, key: str) -> DataFrame:
    """Upper (head) and lower (tail) half by sorted position, ties ordered by key."""
    filled = df.where(F.col(column).isNotNull())
    n = filled.count()
    v, tie = order_statistics(filled, column, key, [n // 2])[0] if n else (None, None)
    upper = (F.col(column) > F.lit(v)) | ((F.col(column) == F.lit(v)) & (F.col(key) >= F.lit(tie)))
    return filled.withColumn(
        "slice", F.when(upper, f"by_{column}_head_50%").otherwise(f"by_{column}_tail_50%")
    )


def slice_scores(sliced: DataFrame, score: Column, label: str | None = "label") -> DataFrame:
    """Score per slice; slices of fewer than 30 rows or of one class are left out."""
    classes = F.min(label) != F.max(label) if label else F.lit(True)
    return (
        sliced.groupBy("slice")
        .agg(F.count("*").alias("n"), score.alias("score"), classes.alias("__ok"))
        .where((F.col("n") >= MIN_SLICE) & F.col("__ok"))
        .drop("__ok")
    )


def refitted_slices(
    df: DataFrame, key: str, features: Sequence[str], target: str, k: int = 5, seeds: Sequence[int] = DEFAULT_SEEDS,
) -> DataFrame:
    """Ridge cross-validated inside each slice: column, slice, n, neg_root_mean_squared_error, r2 (means over seeds and folds).

    Thirds go by the feature that correlates most with the target, halves by the first
    feature. Moments are additive over (slice, seed, fold), so all refits of all slices cost
    one pass. Slices of fewer than 30 rows are left out.
    """
    rows = cut_lineage(df.select(key, *features, target).na.drop())
    best = signal.top_features(rows, features, target, 1).first()
    chosen = best["feature"] if best else features[0]
    thirds = third_slices(rows, chosen).withColumn("by", F.lit(chosen))
    halves = half_slices(rows, features[0], key).withColumn("by", F.lit(features[0]))
    labelled = thirds.unionByName(halves)
    wide = labelled.withColumn("seed", F.explode(F.array(*[F.lit(s) for s in seeds])))
    hashed = wide.withColumn("__h", hash32(F.col("seed"), F.col(key)))
    ranked = hash_position(hashed, ["slice", "seed"], "__h", key, "__p")
    folds = ranked.withColumn("fold", F.pmod("__p", F.lit(k)).cast("int"))
    split = ["by", "slice", "seed", "fold"]
    moments = cut_lineage(linear.fold_moments(folds, features, target, split))
    sizes = moments.where(F.col("seed") == seeds[0]).groupBy("by", "slice").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_SLICE)
    fits = sizes.select(
        "by", "slice", F.lit("full").alias("fit"), F.lit(target).alias("target"), F.array(*[F.lit(c) for c in features]).alias("features")
    )
    fitted = linear.ridge_fits(moments, fits, [*features, target], split)
    return fitted.join(sizes, ["by", "slice"]).groupBy(F.col("by").alias("column"), "slice", F.col("n")).agg(
        F.avg(-F.col("rmse")).alias("neg_root_mean_squared_error"), F.avg("r2").alias("r2")
    )


def class_recall(preds: DataFrame) -> DataFrame:
    """Recall on the rarest and the most common class."""
    per_class = preds.groupBy("label").agg(
        F.count("*").alias("n"), F.avg((F.col("pred") == F.col("label")).cast("double")).alias("score")
    )
    ends = per_class.agg(
        F.min_by(F.struct("n", "score"), F.struct("n", "label")).alias("rare"),
        F.max_by(F.struct("n", "score"), F.struct(F.col("n"), -F.col("label"))).alias("common"),
    )
    both = F.explode(
        F.array(
            F.struct(F.lit("rare_class").alias("slice"), F.col("rare.n"), F.col("rare.score")),
            F.struct(F.lit("common_class").alias("slice"), F.col("common.n"), F.col("common.score")),
        )
    ).alias("s")
    return ends.select(both).select("s.*").where(F.col("n") >= MIN_SLICE)


# ---- permutation importance -------------------------------------------------

def permuted(
    df: DataFrame, key: str, features: Sequence[str], repeats: int = 10, seeds: Sequence[int] = (42,)
) -> DataFrame:
    """One copy of the rows per (seed, repeat, feature), with that feature's values moved to other rows.

    Every seed ranks the rows once by hash; in a repeat the row at place p takes the value of the
    row a hash-drawn distance ahead, round the end. One narrow join serves all features of a repeat.
    """
    narrow = df.withColumn("seed", F.explode(F.array(*[F.lit(s) for s in seeds])))
    hashed = narrow.withColumn("__h", hash32(F.lit("order"), F.col("seed"), F.col(key)))
    ranked = hash_position(hashed, ["seed"], "__h", key, "__p").drop("__h")
    size = df.agg(F.count("*").alias("__n"))
    givers = ranked.select(F.col("seed").alias("__s"), F.col("__p").alias("__at"), *[F.col(c).cast("double").alias(f"__v_{c}") for c in features])
    shift = F.lit(1) + F.pmod(hash32(F.lit("shift"), F.col("seed"), F.col("repeat")), F.greatest(F.col("__n") - 1, F.lit(1)))
    takers = ranked.crossJoin(F.broadcast(size)).withColumn("repeat", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
    moved = takers.withColumn("__to", F.pmod(F.col("__p") + shift, F.col("__n"))).join(
        givers, (F.col("seed") == F.col("__s")) & (F.col("__to") == F.col("__at"))
    )
    copies = moved.withColumn("feature", F.explode(F.array(*[F.lit(c) for c in features])))
    swapped = {c: F.when(F.col("feature") == c, F.col(f"__v_{c}")).otherwise(F.col(c).cast("double")) for c in features}
    return copies.withColumns(swapped).drop("__p", "__n", "__to", "__s", "__at", *[f"__v_{c}" for c in features])


def permutation_importance(
    df: DataFrame,
    key: str,
    features: Sequence[str],
    predict: Callable[[DataFrame], DataFrame],
    score: Column,
    repeats: int = 10,
    seeds: Sequence[int] = (42,),
) -> DataFrame:
    """Mean loss of score per seed and shuffled feature. ``predict`` adds ``pred`` to any copy."""
    base = predict(df).agg(score.alias("base"))
    shuffled = predict(permuted(df, key, features, repeats, seeds)).groupBy("seed", "feature", "repeat").agg(
        score.alias("s")
    )
    return (
        shuffled.crossJoin(F.broadcast(base))
        .groupBy("seed", "feature")
        .agg(F.avg(F.col("base") - F.col("s")).alias("importance"))
    )


def fitted_importance(
    df: DataFrame, key: str, features: Sequence[str], target: str, repeats: int = 10, seeds: Sequence[int] = (42,),
) -> DataFrame:
    """Loss of R2 per seed and shuffled feature of a ridge model of all rows, fitted once."""
    rows = cut_lineage(df.select(key, *[F.col(c).cast("double").alias(c) for c in features], F.col(target).cast("double").alias("label")).na.drop())
    model = cut_lineage(linear.ridge_all(rows, features, "label"))
    error = F.sum((F.col("label") - F.col("pred")) * (F.col("label") - F.col("pred")))
    score = 1 - error / F.nullif(F.var_pop("label") * F.count("label"), F.lit(0.0))
    return permutation_importance(
        rows, key, features, lambda copies: linear.predict_all(copies, model, features), score, repeats, seeds
    )


def top3_stability(importances: DataFrame) -> DataFrame:
    """Most common ordered top-3 over the seeds, and how many seeds share it.

    Each seed's list holds one entry per feature.
    """
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("importance")).alias("o"), F.col("feature"))))
    lists = importances.groupBy("seed").agg(
        F.concat_ws(",", F.transform(F.slice(ordered, 1, 3), lambda s: s["feature"])).alias("top3")
    )
    counts = lists.groupBy("top3").agg(F.count("*").alias("n_match"), F.min("seed").alias("first_seed"))
    n_seeds = counts.agg(F.sum("n_match").alias("n_seeds"))
    best = F.max_by(F.struct("top3", "n_match"), F.struct(F.col("n_match"), -F.col("first_seed")))
    return counts.agg(best.alias("b")).crossJoin(n_seeds).select("b.top3", "b.n_match", "n_seeds")


# ---- gates ------------------------------------------------------------------

def lofo_classes(drops: DataFrame) -> DataFrame:
    return drops.withColumn("drop_class", drop_class(F.col("drop_pct")))


def gates(summary: DataFrame, ci: DataFrame, baseline: DataFrame, drops: DataFrame, by: str = "run_id") -> DataFrame:
    """Stable over seeds, interval above the baseline, no critical feature; then the verdict.

    A run without interval or baseline fails that gate and stays. Figures meet their limits to twelve digits.
    """
    critical = drops.groupBy(by).agg(F.count_if(F.round("drop_pct", 12) > 25).alias("n_critical"))
    joined = summary.join(ci, by, "left").join(baseline, by, "left").join(critical, by, "left")
    gated = joined.select(
        by,
        F.coalesce(F.round("std", 12) <= 0.03, F.lit(False)).alias("g1_stability"),
        F.coalesce(F.round("ci_low", 12) > F.round("baseline_mean", 12), F.lit(False)).alias("g2_ci_above_baseline"),
        (F.coalesce("n_critical", F.lit(0)) == 0).alias("g3_lofo"),
    )
    n = sum((F.col(c).cast("int") for c in ("g1_stability", "g2_ci_above_baseline", "g3_lofo")), F.lit(0))
    return gated.withColumn("n_pass", n).withColumn(
        "verdict",
        F.when(F.col("n_pass") == 3, "PASS").when(F.col("n_pass") >= 1, "WARN").otherwise("FAIL"),
    )
