"""Model metrics as aggregates over the prediction table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.quantiles import value_buckets

SPLIT = ("run_id", "model", "seed", "fold")
PROB_FLOOR = 1e-15


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(a / F.nullif(b, F.lit(0)), F.lit(0.0))


def _hit(pred: float, label: float) -> Column:
    return F.count_if((F.col("pred") == pred) & (F.col("label") == label))


def accuracy() -> Column:
    return F.avg((F.col("pred") == F.col("label")).cast("double"))


def precision() -> Column:
    return _ratio(_hit(1, 1), F.count_if(F.col("pred") == 1))


def recall() -> Column:
    return _ratio(_hit(1, 1), F.count_if(F.col("label") == 1))


def f1() -> Column:
    return _ratio(2 * _hit(1, 1), 2 * _hit(1, 1) + _hit(1, 0) + _hit(0, 1))


def _error() -> Column:
    return F.col("label") - F.col("pred")


def mse() -> Column:
    return F.avg(_error() * _error())


def neg_rmse() -> Column:
    return -F.sqrt(mse())


def neg_mae() -> Column:
    return -F.avg(F.abs(_error()))


def neg_log_loss() -> Column:
    p = F.greatest(F.least(F.col("prob"), F.lit(1 - PROB_FLOOR)), F.lit(PROB_FLOOR))
    return F.avg(F.when(F.col("label") == 1, F.ln(p)).otherwise(F.ln(1 - p)))


def r2() -> Column:
    spread = F.var_pop("label") * F.count("label")
    return 1 - F.sum(_error() * _error()) / F.nullif(spread, F.lit(0.0))


ONE_PASS = {
    "accuracy": accuracy,
    "precision": precision,
    "recall": recall,
    "f1": f1,
    "mse": mse,
    "neg_root_mean_squared_error": neg_rmse,
    "neg_mean_absolute_error": neg_mae,
    "neg_log_loss": neg_log_loss,
    "r2": r2,
}


def score_wide(preds: DataFrame, metrics: Sequence[str], by: Sequence[str] = SPLIT) -> DataFrame:
    """All asked metrics of each split from one aggregation."""
    return preds.groupBy(*by).agg(*[ONE_PASS[m]().alias(m) for m in metrics])


def roc_auc(preds: DataFrame, by: Sequence[str] = SPLIT) -> DataFrame:
    """Rank-sum AUC, ties averaged; NULL where a split holds one class only.

    Rows collapse to one per distinct probability first; these are then summed in chunks
    cut at sketched quantiles of the probabilities, so no split is sorted in one piece,
    however narrow its scores lie. Rows without probability are skipped.
    """
    by = list(by)
    cells = preds.where(F.col("prob").isNotNull()).groupBy(*by, "prob").agg(
        F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") == 0).alias("neg")
    )
    chunked = value_buckets(cells, ["prob"]).withColumnRenamed("__b_prob", "chunk")
    sums = chunked.groupBy(*by, "chunk").agg(F.sum("neg").alias("chunk_neg"))
    prior = Window.partitionBy(*by).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(*by, "chunk", F.coalesce(F.sum("chunk_neg").over(prior), F.lit(0)).alias("start"))
    inside = Window.partitionBy(*by, "chunk").orderBy("prob").rowsBetween(Window.unboundedPreceding, -1)
    ranked = chunked.join(starts, [*by, "chunk"]).withColumn(
        "below", F.col("start") + F.coalesce(F.sum("neg").over(inside), F.lit(0))
    )
    wins = F.sum(F.col("pos") * (F.col("below") + F.col("neg") / 2.0))
    pairs = F.sum("pos").cast("double") * F.sum("neg").cast("double")
    return ranked.groupBy(*by).agg((wins / F.nullif(pairs, F.lit(0.0))).alias("roc_auc"))


def scores(preds: DataFrame, metrics: Sequence[str], by: Sequence[str] = SPLIT) -> DataFrame:
    """Long score table: split keys, metric, score."""
    plain = [m for m in metrics if m in ONE_PASS]
    parts = []
    if plain:
        parts.append(
            score_wide(preds, plain, by).unpivot(list(by), plain, "metric", "score")
        )
    if "roc_auc" in metrics:
        parts.append(roc_auc(preds, by).unpivot(list(by), ["roc_auc"], "metric", "score"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
