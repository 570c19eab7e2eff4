"""Is the best model better than naive baselines? Tests, effect size, gates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import hash32
from ..functions.ordered import position
from ..functions.quantiles import value_buckets
from ..functions.tails import normal_quantile, shapiro_p, shapiro_w, signed_rank_tail, t_tail
from ..session import cut_lineage

PAIR = ("run_id", "baseline")
NORMAL_P = 0.05


def differences(best: DataFrame, baselines: DataFrame) -> DataFrame:
    """Best minus baseline on the same (run, seed, fold)."""
    b = best.select("run_id", "seed", "fold", F.col("score").alias("best"))
    n = baselines.select("run_id", "seed", "fold", F.col("model").alias("baseline"), F.col("score").alias("base"))
    return b.join(n, ["run_id", "seed", "fold"]).withColumn("d", F.col("best") - F.col("base"))


def summary(diffs: DataFrame, by: Sequence[str] = PAIR) -> DataFrame:
    """Size, lift, effect size and t statistic of each comparison, one aggregation."""
    spread = F.nullif(F.stddev_samp("d"), F.lit(0.0))
    base = F.avg("base")
    floor = F.when(F.abs(base) > 1e-9, F.abs(base)).otherwise(1.0)
    return diffs.groupBy(*by).agg(
        F.count("d").alias("n"),
        F.avg("best").alias("best_mean"),
        base.alias("baseline_mean"),
        F.stddev_pop("base").alias("baseline_std"),
        F.avg("d").alias("lift"),
        (F.avg("d") / floor * 100).alias("lift_pct"),
        F.coalesce(F.avg("d") / spread, F.lit(0.0)).alias("cohen_d"),
        (F.avg("d") / (spread / F.sqrt(F.count("d")))).alias("t"),
    )


def paired_t(summaries: DataFrame) -> DataFrame:
    """One-sided (greater) p of the paired t statistic.

    Without spread the sign of the mean decides, as the limit of the statistic does.
    """
    p = t_tail(F.col("t"), (F.col("n") - 1).cast("double"))
    flat = F.when(F.col("lift") > 0, 0.0).when(F.col("lift") < 0, 1.0)
    return summaries.withColumn("p_t", F.when(F.col("n") >= 2, F.coalesce(p, flat)))


def normality(diffs: DataFrame, by: Sequence[str] = PAIR) -> DataFrame:
    """Shapiro-Wilk W and p of each comparison for any number of values, with the Jarque-Bera statistic beside it.

    Ranks come chunk by chunk, chunks cut at sketched quantiles and one frequent value by the hash of
    its rows, so no task sorts a comparison in one piece. A rank's normal score is
    a built-in expression, and W is made of sums over scores and of the values at both ends.
    The approximation of p is published for up to 5 000 values.
    """
    by = list(by)
    known = diffs.where(F.col("d").isNotNull())
    sizes = known.groupBy(*by).agg(
        F.count("d").alias("n"), F.skewness("d").alias("skew"), F.kurtosis("d").alias("kurt"),
        F.avg("d").alias("__mean"), (F.var_pop("d") * F.count("d")).alias("__ss"),
    )
    cut = value_buckets(known.withColumn("__row", F.xxhash64(*known.columns)), ["d"], on_cut=True)
    chunk = F.col("__b_d").cast("bigint") * 4097 + F.when(F.col("__c_d"), F.pmod("__row", F.lit(4096))).otherwise(4096)
    ranked = position(cut.select(*by, "d", chunk.alias("__k")), by, F.col("__k"), ["d"], "__at")
    scored = ranked.join(sizes.select(*by, "n", "__mean"), by).select(
        *by, "n", "__at", (F.col("d") - F.col("__mean")).alias("x"),
        normal_quantile((F.col("__at") + 0.625) / (F.col("n") + 0.25)).alias("m"),
    )
    spot = lambda place, what: F.max(F.when(F.col("__at") == place, F.col(what)))
    sums = scored.groupBy(*by).agg(
        F.sum(F.col("m") * F.col("m")).alias("mm"), F.sum(F.col("m") * F.col("x")).alias("mx"),
        spot(0, "x").alias("low"), F.coalesce(spot(1, "x"), F.lit(0.0)).alias("low2"),
        F.coalesce(spot(F.col("n") - 2, "x"), F.lit(0.0)).alias("high2"), spot(F.col("n") - 1, "x").alias("high"),
        spot(F.col("n") - 1, "m").alias("last"), F.coalesce(spot(F.col("n") - 2, "m"), F.lit(0.0)).alias("second"),
    )
    jb = F.col("n") / 6.0 * (F.pow("skew", F.lit(2.0)) + F.pow("kurt", F.lit(2.0)) / 4.0)
    w = shapiro_w(
        F.col("n").cast("double"), "mm", "mx", F.col("__ss"), "low", "low2", "high2", "high", "last", "second"
    )
    return sizes.join(sums, by).withColumn("w", w).select(
        *by, "n", jb.alias("jarque_bera"), "w", shapiro_p(F.col("w"), F.col("n").cast("double")).alias("p_norm")
    )


def signed_rank(diffs: DataFrame, by: Sequence[str] = PAIR) -> DataFrame:
    """Wilcoxon W+ with averaged ranks; zero differences are dropped.

    Equal sizes collapse to one row with counts, then ranks add up chunk by chunk; chunks
    are cut at sketched quantiles of the sizes.
    """
    by = list(by)
    cells = (
        diffs.where(F.col("d") != 0)
        .groupBy(*by, F.abs("d").alias("size"))
        .agg(F.count("*").alias("c"), F.count_if(F.col("d") > 0).alias("pos"))
    )
    cells = value_buckets(cells, ["size"]).withColumnRenamed("__b_size", "chunk")
    prior = Window.partitionBy(*by).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        cells.groupBy(*by, "chunk").agg(F.sum("c").alias("cc"))
        .select(*by, "chunk", F.coalesce(F.sum("cc").over(prior), F.lit(0)).alias("start"))
    )
    inside = Window.partitionBy(*by, "chunk").orderBy("size").rowsBetween(Window.unboundedPreceding, -1)
    rank = F.col("start") + F.coalesce(F.sum("c").over(inside), F.lit(0)) + (F.col("c") + 1) / 2.0
    ranked = cells.join(starts, [*by, "chunk"]).withColumn("rank", rank)
    sums = ranked.groupBy(*by).agg(
        F.sum(F.col("pos") * F.col("rank")).alias("w_plus"),
        F.sum("c").alias("n_nonzero"),
        F.sum(F.col("c") * F.col("c") * F.col("c") - F.col("c")).cast("double").alias("tie_term"),
    )
    zeros = diffs.groupBy(*by).agg(F.count_if(F.col("d") == 0).alias("n_zero"))
    return zeros.join(sums, by, "left")


def signed_rank_p(ranks: DataFrame) -> DataFrame:
    cols = [F.col(c).cast("double") for c in ("w_plus", "n_nonzero", "tie_term", "n_zero")]
    return ranks.withColumn("p_wilcoxon", signed_rank_tail(*cols))


def bootstrap_ci(
    df: DataFrame, by: Sequence[str], value: str, replicates: int = 2000, seed: int = 42, alpha: float = 0.05
) -> DataFrame:
    """Percentile interval of the mean over hash-drawn resamples.

    A group has one value per seed and fold, so its values travel as a list next to each
    replicate, and a resample is read off the list: no draw is ever shuffled. For values
    by row see ``robustness.poisson_bootstrap``.
    """
    by = list(by)
    order = F.array_sort(F.collect_list(F.struct("seed", "fold", F.col(value).alias("x"))))  # seeds x folds entries
    lists = df.select(*by, "seed", "fold", value).groupBy(*by).agg(F.transform(order, lambda r: r["x"]).alias("xs"))
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    reps = lists.select(*by, "xs", F.explode(F.sequence(F.lit(0), F.lit(replicates - 1))).alias("rep"))
    n = F.size("xs")
    drawn = F.transform(
        F.sequence(F.lit(0), n - 1), lambda i: F.get("xs", F.pmod(hash32(F.lit(seed), F.col("rep"), i), n).cast("int"))
    )
    total = F.aggregate(drawn, F.lit(0.0), lambda t, x: t + x)
    means = reps.repartition(parts, *by, "rep").select(*by, (total / n).alias("m"))
    q = F.percentile("m", F.array(F.lit(alpha / 2), F.lit(1 - alpha / 2)))
    return means.groupBy(*by).agg(q[0].alias("ci_low"), q[1].alias("ci_high"))


def permutation_p(diffs: DataFrame, by: Sequence[str] = PAIR, n_perm: int = 10000, seed: int = 42) -> DataFrame:
    """Share of hash shuffles of the pooled scores whose mean gap reaches the observed one.

    Used for comparisons of fewer than six pairs, so a list holds at most ten scores; each
    shuffle orders the list by its own hashes.
    """
    by = list(by)
    pairs = F.array_sort(F.collect_list(F.struct("seed", "fold", "best", "base")))
    lists = diffs.groupBy(*by).agg(pairs.alias("p")).select(
        *by,
        F.flatten(F.transform("p", lambda r, i: F.array(
            F.struct((2 * i).alias("item"), r["best"].alias("s")), F.struct((2 * i + 1).alias("item"), r["base"].alias("s"))
        ))).alias("pool"),
    )
    parts = int(diffs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    mean = lambda xs: F.aggregate(xs, F.lit(0.0), lambda t, x: t + x["s"]) / F.size(xs)
    even = lambda keep: F.filter("pool", lambda x: F.pmod(x["item"], F.lit(2)) == keep)
    shuffled = F.array_sort(F.transform(
        "pool", lambda x: F.struct(hash32(F.lit(seed), F.col("perm"), x["item"]).alias("h"), x["item"].alias("item"), x["s"].alias("s"))
    ))
    half = (F.size("pool") / 2).cast("int")
    gaps = (
        lists.select(*by, "pool", F.explode(F.sequence(F.lit(0), F.lit(n_perm - 1))).alias("perm"))
        .repartition(parts, *by, "perm")
        .select(*by, "pool", shuffled.alias("mixed"))
        .select(
            *by,
            (mean(F.slice("mixed", F.lit(1), half)) - mean(F.slice("mixed", half + 1, half))).alias("gap"),
            (mean(even(0)) - mean(even(1))).alias("observed"),
        )
    )
    # both gaps are sums in different order; compare to twelve digits
    reached = F.round(F.col("gap"), 12) >= F.round(F.col("observed"), 12)
    return gaps.groupBy(*by).agg(F.avg(reached.cast("double")).alias("p_perm"))


def choose_test(n: Column, p_norm: Column) -> Column:
    return (
        F.when(n < 3, "insufficient")
        .when(p_norm >= NORMAL_P, "paired_t")
        .when(n >= 6, "wilcoxon")
        .otherwise("permutation")
    )


def compare(diffs: DataFrame, by: Sequence[str] = PAIR, replicates: int = 2000, n_perm: int = 10000) -> DataFrame:
    """Full comparison: chosen test with its p, interval, effect size, lift."""
    by = list(by)
    diffs = cut_lineage(diffs)  # one row per fold, read by every test
    base = paired_t(summary(diffs, by)).join(normality(diffs, by).drop("n", "w"), by)
    base = base.withColumn("test", choose_test(F.col("n"), F.col("p_norm")))
    few = base.where(F.col("test") == "permutation").select(*by)
    perm = permutation_p(diffs.join(few, by, "left_semi"), by, n_perm)
    wil = signed_rank_p(signed_rank(diffs, by)).select(*by, "w_plus", "p_wilcoxon")
    ci = bootstrap_ci(diffs, by, "d", replicates)
    joined = base.join(wil, by, "left").join(perm, by, "left").join(ci, by, "left")
    pick = lambda t, w, p: (
        F.when(F.col("test") == "paired_t", t).when(F.col("test") == "wilcoxon", w)
        .when(F.col("test") == "permutation", p)
    )
    return joined.select(
        *by, "n", "best_mean", "baseline_mean", "baseline_std", "lift", "lift_pct", "cohen_d",
        "ci_low", "ci_high", "p_norm", "test",
        pick(F.col("t"), F.col("w_plus"), F.col("lift")).alias("stat"),
        pick(F.col("p_t"), F.col("p_wilcoxon"), F.col("p_perm")).alias("p_value"),
    )


def gates(tests: DataFrame, require: str = "any") -> DataFrame:
    """Four gates per run: open when any (or all) of the baselines is beaten. Figures meet their limits to twelve digits."""
    fold = F.bool_or if require == "any" else F.bool_and
    ask = lambda c: F.coalesce(fold(F.coalesce(c, F.lit(False))), F.lit(False))
    return tests.groupBy("run_id").agg(
        ask(F.round("p_value", 12) < 0.05).alias("g1"),
        ask(F.round("lift_pct", 12) >= 2.0).alias("g2"),
        ask(F.round(F.abs("cohen_d"), 12) >= 0.2).alias("g3"),
        ask(F.round("ci_low", 12) > 0).alias("g4"),
    )


def verdict(gated: DataFrame) -> DataFrame:
    passed = sum((F.col(g).cast("int") for g in ("g1", "g2", "g3", "g4")), F.lit(0))
    return gated.withColumn("n_pass", passed).withColumn(
        "verdict",
        F.when(F.col("n_pass") == 4, "PASS").when(F.col("n_pass") >= 2, "WARN").otherwise("FAIL"),
    )


def run_verdicts(runs: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Every run gets a verdict: N/A for tasks without baselines, FAIL without data."""
    supported = F.col("task").isin("classification", "regression")
    return runs.join(verdicts.select("run_id", "verdict"), "run_id", "left").select(
        "run_id",
        "task",
        F.when(~F.coalesce(supported, F.lit(False)), "N/A")
        .otherwise(F.coalesce("verdict", F.lit("FAIL")))
        .alias("verdict"),
    )
