"""Naive models. Training statistics are additive: train = total - own fold."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import uniform
from ..session import cut_lineage
from .infold import train_quantiles

SPLIT = ("seed", "fold")


def _pairs(left: DataFrame, right: DataFrame, group: Sequence[str]) -> DataFrame:
    """Rows of both sides that share the group keys; the right side has one row per fold or class."""
    return left.join(right, list(group)) if group else left.crossJoin(right)


def train_class_counts(folds: DataFrame, label: str, split: Sequence[str] = SPLIT) -> DataFrame:
    """Class counts outside each fold: split keys, label, n. A table of folds x classes."""
    *group, fold = split
    counts = cut_lineage(folds.groupBy(*group, fold, label).agg(F.count("*").alias("own")))
    cells = _pairs(counts.select(*group, fold).distinct(), counts.select(*group, label).distinct(), group)
    filled = cells.join(counts, [*group, fold, label], "left").fillna(0, ["own"])
    total = F.sum("own").over(Window.partitionBy(*group, label))
    return filled.select(*group, fold, label, (total - F.col("own")).alias("n"))


def majority_class(folds: DataFrame, label: str, split: Sequence[str] = SPLIT) -> DataFrame:
    """Most frequent training class and its share per split; smallest label on a tie."""
    counts = train_class_counts(folds, label, split)
    best = F.max_by(F.col(label), F.struct(F.col("n"), -F.col(label)))
    return counts.groupBy(*split).agg(
        best.alias("majority"), (F.max("n") / F.sum("n")).alias("share")
    )


def predict_majority(folds: DataFrame, label: str, split: Sequence[str] = SPLIT) -> DataFrame:
    fitted = majority_class(folds, label, split)
    scored = folds.join(F.broadcast(fitted), list(split))  # seeds x folds rows
    # a constant model scores every row alike: probability 0 or 1
    pred = F.col("majority").cast("double")
    return scored.withColumn("pred", pred).withColumn("prob", pred).drop("majority", "share")


MAX_CLASSES = 1000


def class_priors(folds: DataFrame, label: str, split: Sequence[str] = SPLIT) -> DataFrame:
    """Majority class and cumulative class prior per split: one row per split.

    The ladder of a split is broadcast, so more than MAX_CLASSES classes are an error.
    """
    counts = train_class_counts(folds, label, split)
    upto = F.sum("n").over(Window.partitionBy(*split).orderBy(label))
    steps = counts.withColumn("hi", upto / F.sum("n").over(Window.partitionBy(*split)))
    priors = steps.groupBy(*split).agg(
        F.max_by(F.col(label), F.struct(F.col("n"), -F.col(label))).alias("majority"),
        F.array_sort(F.collect_list(F.struct("hi", F.col(label).alias("cls")))).alias("ladder"),  # one per class
    )
    many = F.raise_error(F.lit(f"{label} has more than {MAX_CLASSES} classes"))
    return priors.withColumn("ladder", F.when(F.size("ladder") <= MAX_CLASSES, F.col("ladder")).otherwise(many.cast(priors.schema["ladder"].dataType)))


def _drawn_class() -> Column:
    """First class whose cumulative prior exceeds the row's hash draw."""
    return F.filter("ladder", lambda s: F.col("__u") < s["hi"])[0]["cls"].cast("double")


def _draw(split: Sequence[str], key: str) -> Column:
    return uniform(F.lit("strat"), *[F.col(c) for c in split], F.col(key))


def predict_stratified(
    folds: DataFrame, label: str, key: str, split: Sequence[str] = SPLIT
) -> DataFrame:
    """Random class by training prior: a hash draw against the cumulative prior."""
    priors = class_priors(folds, label, split).drop("majority")
    scored = folds.join(F.broadcast(priors), list(split)).withColumn("__u", _draw(split, key))
    pred = _drawn_class()
    return scored.withColumn("pred", pred).withColumn("prob", pred).drop("ladder", "__u")


def predict_classifiers(
    folds: DataFrame, label: str, key: str, rules: Mapping[str, Column], run: str, split: Sequence[str] = SPLIT
) -> DataFrame:
    """Prediction rows of the rules and of both naive classifiers from one pass over the folds."""
    priors = class_priors(folds, label, split)
    scored = folds.join(F.broadcast(priors), list(split)).withColumn("__u", _draw(split, key))
    models = {name: F.coalesce(r, F.lit(False)).cast("double") for name, r in rules.items()}
    models["majority"] = F.col("majority").cast("double")
    models["stratified"] = _drawn_class()
    cells = F.explode(
        F.array(*[F.struct(F.lit(n).alias("model"), p.alias("pred")) for n, p in models.items()])
    ).alias("m")
    return scored.select(
        F.lit(run).alias("run_id"), *split, F.col(key).cast("bigint").alias("row_id"),
        F.col(label).cast("double").alias("label"), cells,
    ).select("run_id", "m.model", *split, "row_id", "label", "m.pred", F.col("m.pred").alias("prob"))


def predict_mean(folds: DataFrame, target: str, split: Sequence[str] = SPLIT) -> DataFrame:
    """Mean of the training target: (total - fold) sums over (total - fold) counts."""
    *group, _ = split
    own = folds.groupBy(*split).agg(
        F.sum(F.col(target).cast("double")).alias("s"), F.count(target).alias("c")
    )
    whole = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    fitted = own.select(
        *split,
        ((F.sum("s").over(whole) - F.col("s")) / (F.sum("c").over(whole) - F.col("c"))).alias("pred"),
    )
    return folds.join(F.broadcast(fitted), list(split)).withColumn("prob", F.lit(None).cast("double"))


def predict_median(folds: DataFrame, target: str, split: Sequence[str] = SPLIT) -> DataFrame:
    """Median of the training target, exact, from counters per training set."""
    found = train_quantiles(cut_lineage(folds.select(*split, target)), [target], [0.5], split)
    fitted = found.select(*split, F.col("value").alias("pred"))
    return folds.join(F.broadcast(fitted), list(split)).withColumn("prob", F.lit(None).cast("double"))


def predict_rule(folds: DataFrame, rule: Column) -> DataFrame:
    """A boolean condition as classifier."""
    pred = F.coalesce(rule, F.lit(False)).cast("double")
    return folds.withColumn("pred", pred).withColumn("prob", pred)


def as_preds(scored: DataFrame, run: str, model: str, key: str, label: str) -> DataFrame:
    """The common prediction table."""
    return scored.select(
        F.lit(run).alias("run_id"),
        F.lit(model).alias("model"),
        "seed",
        "fold",
        F.col(key).cast("bigint").alias("row_id"),
        F.col(label).cast("double").alias("label"),
        F.col("pred").cast("double").alias("pred"),
        F.col("prob").cast("double").alias("prob"),
    )
