"""The modelling log: progress, convergence, best runs, re-run checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ordered import running
from .features import normalize_metric

IMPROVING = 0.005


def with_progress(log: DataFrame, run: str, order: Sequence[str], score: str, chunk: Column) -> DataFrame:
    """Number the iterations of each run from 0 and take each score's delta against the
    best one before it (0 for the first).

    ``chunk`` is a coarse prefix of the order (for example the day), so a run with very
    many iterations is spread over tasks.
    """
    one = log.withColumn("__one", F.lit(1).cast("bigint"))
    seen = running(one, [run], chunk, list(order), {"iter": ("sum", "__one"), "best_before": ("max", score)})
    return seen.drop("__one").withColumn(
        "delta", F.coalesce(F.col(score) - F.col("best_before"), F.lit(0.0))
    )


def cap_iterations(log: DataFrame, limit: int, iteration: str = "iter") -> DataFrame:
    """Iterations inside the cap of the loop."""
    return log.where(F.col(iteration) < limit)


def best_iteration(log: DataFrame, run: str, iteration: str, score: str) -> DataFrame:
    """Best non-baseline iteration of each run; the earliest on a tie."""
    pick = F.max_by(F.col(iteration), F.struct(F.col(score), -F.col(iteration)))
    return log.where(F.col(iteration) > 0).groupBy(run).agg(
        pick.alias("best_iter"), F.max(score).alias("best_score")
    )


def convergence(log: DataFrame, run: str, iteration: str, delta: str, score: str, threshold: float) -> DataFrame:
    """State after each iteration from its own and the two previous deltas.

    Every row also reports its delta to the next two iterations, so one grouping by
    (run, iteration) brings the three together: no self-join, no sort of a hot run.
    """
    ahead = F.explode(F.sequence(F.lit(0), F.lit(2))).alias("__k")
    sent = log.select(
        F.col(run).alias("__run"), F.col(iteration).alias("__i"), F.col(delta).alias("__d"), F.struct(*log.columns).alias("__row"), ahead
    ).select(
        "__run", (F.col("__i") + F.col("__k")).alias("__at"), "__k", "__d",
        F.when(F.col("__k") == 0, F.col("__row")).alias("__row"),
    )
    met = sent.groupBy("__run", "__at").agg(
        F.any_value("__row", True).alias("__row"),
        F.max(F.when(F.col("__k") == 1, F.col("__d"))).alias("__d1"),
        F.max(F.when(F.col("__k") == 2, F.col("__d"))).alias("__d2"),
    )
    out = met.where(F.col("__row").isNotNull()).select("__row.*", "__d1", "__d2")
    small = lambda c: (F.col(c) > 0) & (F.col(c) <= IMPROVING)
    flat = lambda c: F.coalesce(F.col(c) <= 0, F.lit(False))
    state = (
        F.when(F.col(score) >= threshold, "converged")
        .when(F.col(delta) > IMPROVING, "improving")
        .when(flat(delta) & flat("__d1") & flat("__d2"), "backtrack")
        .when(small(delta) & F.coalesce(small("__d1"), F.lit(False)), "plateaued")
        .otherwise("continue")
    )
    return out.withColumn("state", state).drop("__d1", "__d2")


def best_per_hypothesis(log: DataFrame, run: str, hypothesis: str, iteration: str, score: str) -> DataFrame:
    """Best score of each hypothesis, and whether it is the best of the run."""
    best = log.groupBy(run, hypothesis).agg(
        F.max(score).alias("best_score"),
        F.max_by(F.col(iteration), F.struct(F.col(score), -F.col(iteration))).alias("best_iter"),
    )
    top = best.groupBy(run).agg(
        F.max_by(F.col(hypothesis), F.struct(F.col("best_score"), -F.col("best_iter"))).alias("__top")
    )
    return best.join(top, run).withColumn("is_global_best", F.col(hypothesis) == F.col("__top")).drop("__top")


def rerun_check(recorded: DataFrame, rerun: DataFrame, run: str) -> DataFrame:
    """OK when the mean of the repeated folds is within 0.01 of the recorded score; a run never repeated is MISSING."""
    mean = rerun.groupBy(run).agg(F.avg("score").alias("rerun_score"))
    diff = F.abs(F.col("rerun_score") - F.col("best_score"))
    status = F.when(F.col("rerun_score").isNull(), "MISSING").when(diff < 0.01, "OK").otherwise("MISMATCH")
    return recorded.join(mean, run, "left").select(run, "best_score", "rerun_score", status.alias("status"))


def retry_action(attempts: DataFrame, run: str) -> DataFrame:
    """First mismatch: check again. Second: stop."""
    n = F.count_if(F.col("status") == "MISMATCH")
    return attempts.groupBy(run).agg(n.alias("n_mismatch")).withColumn(
        "action",
        F.when(F.col("n_mismatch") == 0, "proceed").when(F.col("n_mismatch") == 1, "recheck").otherwise("stop"),
    )


def criterion_met(best: DataFrame, score: str, threshold: str, metric: str) -> DataFrame:
    """Compare with the target in the direction of the metric."""
    lower = normalize_metric(F.col(metric)).isin("RMSE", "MAE", "LOGLOSS", "MSE")
    met = F.when(lower, F.col(score) <= F.col(threshold)).otherwise(F.col(score) >= F.col(threshold))
    return best.withColumn("met", met)


# fixed values: candidate models and tests per kind of analysis
CANDIDATES = {
    "regression": ["Ridge", "RandomForest", "XGBoost", "LightGBM"],
    "classification": ["LogisticRegression", "RandomForest", "XGBoost", "LightGBM"],
    "clustering": ["KMeans", "DBSCAN"],
    "descriptive": ["t-test", "ANOVA", "chi2"],
}


def candidate_grid(hypotheses: DataFrame, task: str = "task") -> DataFrame:
    """Every hypothesis with each model that fits its task."""
    models = F.create_map(*[x for t, ms in CANDIDATES.items() for x in (F.lit(t), F.array(*[F.lit(m) for m in ms]))])
    return hypotheses.select("*", F.explode(F.try_element_at(models, F.col(task))).alias("model"))
