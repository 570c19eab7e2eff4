"""Spark ML models: dispatch by name, preprocessing in the fold, importances."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from . import clusters, infold, robustness
from .features import encode_category


def get_estimator(
    name: str | None, task: str, seed: int = 42, trees: int = 100, depth: int = 5, label: str = "label",
    n_rows: int = 1, label_std: float = 1.0,
):
    """Estimator for a model name; unknown names fall back to a random forest.

    Linear models take a unit penalty on the summed loss. Spark averages the loss over
    ``n_rows`` and scales the label of a regression by its spread; the penalty follows.
    """
    key = (name or "").upper()
    # fixed values: parts of model names
    common = {"featuresCol": "features", "labelCol": label}
    boosted = any(k in key for k in ("XGB", "LIGHTGBM", "LGBM", "GRADIENTBOOSTING", "GBT"))
    if task == "classification":
        if "RANDOMFOREST" in key or "RF" in key:
            return RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, **common)
        if boosted:
            return GBTClassifier(maxIter=trees, maxDepth=depth, seed=seed, **common)
        if "LOGISTIC" in key or "LR" in key:
            return LogisticRegression(maxIter=1000, regParam=1.0 / n_rows, standardization=False, **common)
        return RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, **common)
    if "RIDGE" in key:
        return LinearRegression(
            maxIter=1000, regParam=label_std / n_rows, elasticNetParam=0.0, standardization=False, **common
        )
    if boosted:
        return GBTRegressor(maxIter=trees, maxDepth=depth, seed=seed, **common)
    return RandomForestRegressor(numTrees=trees, maxDepth=depth, seed=seed, **common)


def preprocessing(numeric: Sequence[str], text: Sequence[str]) -> list:
    """Stages behind ``infold.apply``: one-hot (unknown levels kept apart) and one vector.

    Filling and scaling are exact statistics of the training rows and come before, so the
    stages learn nothing but the levels.
    """
    stages = []
    parts = []
    if numeric:
        stages.append(VectorAssembler(inputCols=list(numeric), outputCol="__num", handleInvalid="keep"))
        parts.append("__num")
    if text:
        coded = [f"{c}__i" for c in text]
        hot = [f"{c}__h" for c in text]
        stages.append(
            StringIndexer(inputCols=list(text), outputCols=coded, handleInvalid="keep", stringOrderType="alphabetAsc")
        )
        stages.append(OneHotEncoder(inputCols=coded, outputCols=hot, dropLast=False))
        parts.extend(hot)
    stages.append(VectorAssembler(inputCols=parts, outputCol="features"))
    return stages


def feature_names(df: DataFrame, column: str = "features") -> list[str]:
    """Names of the vector slots, from the column's metadata."""
    attrs = df.schema[column].metadata.get("ml_attr", {}).get("attrs", {})
    slots = sorted((a["idx"], a.get("name", str(a["idx"]))) for kind in attrs.values() for a in kind)
    return [n for _, n in slots]


def prepared(df: DataFrame, numeric: Sequence[str], text: Sequence[str], scale: bool = True) -> DataFrame:
    """All rows filled and scaled by their own median, mode, mean and population spread."""
    whole = df.select(F.lit(0).alias("__all"), *numeric, *text)
    learned = infold.fit(whole, numeric, text, ["__all"], lambda test, own: True).collect()  # one row per column
    return infold.apply(df, [r.asDict() for r in learned], numeric, text, scale)


def assemble(df: DataFrame, numeric: Sequence[str], text: Sequence[str], scale: bool = True) -> DataFrame:
    ready = prepared(df, numeric, text, scale)
    return Pipeline(stages=preprocessing(numeric, text)).fit(ready).transform(ready)


def _label_moments() -> list:
    return [F.count("label").alias("n"), F.avg("label").alias("mean"), F.var_pop("label").alias("var")]


def _size_and_spread(parts) -> tuple[int, float]:
    """Rows and population spread of the label over several folds."""
    n = sum(p["n"] for p in parts)
    if n == 0:
        return 1, 1.0
    mean = sum(p["n"] * p["mean"] for p in parts) / n
    var = sum(p["n"] * (p["var"] + (p["mean"] - mean) ** 2) for p in parts) / n
    return n, var**0.5 or 1.0


def out_of_fold(
    folds: DataFrame, key: str, numeric: Sequence[str], text: Sequence[str], label: str,
    model: str, task: str, run: str, splits: Sequence[tuple[int, int]], trees: int = 100, parallelism: int = 4,
    depth: int = 5, earlier: bool = False,
) -> DataFrame:
    """Predictions of every row by a model that did not see its fold, or with ``earlier`` only lower ones.

    Each (seed, fold) is one distributed fit; a small thread pool keeps the cluster busy.
    A text target is coded by the sorted order of its classes; ``prob`` is the probability
    of the second class and NULL with more than two.
    """
    target = "__code" if dict(folds.dtypes)[label] == "string" else label
    coded = encode_category(folds, label, "__code") if target != label else folds
    # written once: every fit and every prediction reads it
    data = cut_lineage(coded.select("seed", "fold", key, *numeric, *text, F.col(target).cast("double").alias("label")))
    moments = data.groupBy("seed", "fold").agg(*_label_moments()).collect()  # seeds x folds rows
    learned: dict[tuple, list] = {}
    trains = infold.earlier_blocks if earlier else infold.other_folds
    for r in infold.fit(data, numeric, text, trains=trains).collect():  # seeds x folds x columns rows
        learned.setdefault((r["seed"], r["fold"]), []).append(r.asDict())

    def one(split: tuple[int, int]) -> DataFrame:
        seed, fold = split
        rows = data.where(F.col("seed") == seed)
        n, std = _size_and_spread([m for m in moments if trains(split, (m["seed"], m["fold"]))])
        estimator = get_estimator(model, task, seed, trees, depth, n_rows=n, label_std=std)
        stages = [*preprocessing(numeric, text), estimator]
        ready = infold.apply(rows, learned.get(split, []), numeric, text)
        fitted = Pipeline(stages=stages).fit(ready.where(F.col("fold") < fold if earlier else F.col("fold") != fold))
        out = fitted.transform(ready.where(F.col("fold") == fold))
        prob = F.lit(None).cast("double")
        if "probability" in out.columns:
            probs = vector_to_array("probability")
            prob = F.when(F.size(probs) == 2, F.get(probs, F.lit(1)))
        return out.select(
            F.lit(run).alias("run_id"), F.lit(model).alias("model"), "seed", "fold",
            F.col(key).cast("bigint").alias("row_id"), "label",
            F.col("prediction").cast("double").alias("pred"), prob.alias("prob"),
        )

    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        parts = list(pool.map(one, splits))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def leave_one_out(
    folds: DataFrame, key: str, numeric: Sequence[str], text: Sequence[str], label: str,
    model: str, task: str, run: str, splits: Sequence[tuple[int, int]], **options,
) -> DataFrame:
    """Out-of-fold predictions of the full model and of one refit without each feature.

    That is (features + 1) x splits fits; ridge gets the same from one scan (``linear``).
    """
    sets = {"full": (list(numeric), list(text))}
    for c in [*numeric, *text]:
        sets[f"-{c}"] = ([n for n in numeric if n != c], [t for t in text if t != c])
    parts = [
        out_of_fold(folds, key, n, t, label, model, task, run, splits, **options).withColumn("feature_set", F.lit(name))
        for name, (n, t) in sets.items()
        if n or t
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _ranked(spark, names: Sequence[str], values, what: str, k: int) -> DataFrame:
    rows = sorted(zip(names, (float(v) for v in values)), key=lambda r: (-abs(r[1]), r[0]))[:k]
    return spark.createDataFrame([(i + 1, n, v) for i, (n, v) in enumerate(rows)], f"rank int, feature string, {what} double")


def _final(model: PipelineModel):
    return model.stages[-1]


def fit(df: DataFrame, numeric: Sequence[str], text: Sequence[str], label: str, model: str, task: str,
        trees: int = 100, depth: int = 5) -> PipelineModel:
    data = df.withColumn("label", F.col(label).cast("double"))
    n, std = _size_and_spread(data.agg(*_label_moments()).collect())
    estimator = get_estimator(model, task, 42, trees, depth, n_rows=n, label_std=std)
    return Pipeline(stages=preprocessing(numeric, text) + [estimator]).fit(prepared(data, numeric, text))


def top_importances(df: DataFrame, fitted: PipelineModel, k: int = 8) -> DataFrame:
    """Tree importances by name; a model holds one number per feature slot."""
    names = feature_names(fitted.transform(df.limit(1)))
    return _ranked(df.sparkSession, names, _final(fitted).featureImportances.toArray(), "importance", k)


def top_coefficients(df: DataFrame, fitted: PipelineModel, k: int = 8) -> DataFrame:
    """Linear coefficients by size."""
    names = feature_names(fitted.transform(df.limit(1)))
    return _ranked(df.sparkSession, names, _final(fitted).coefficients.toArray(), "coefficient", k)


def permutation_importances(
    df: DataFrame, key: str, numeric: Sequence[str], label: str, model: str, task: str, repeats: int = 10,
    seeds: Sequence[int] = (42,), trees: int = 100, depth: int = 5,
) -> DataFrame:
    """Loss of accuracy (or R2) per seed and shuffled feature, one fit per seed on all rows.

    Shuffled copies are scored by that fit; nothing is fitted again for them.
    """
    rows = cut_lineage(df.select(key, *numeric, F.col(label).cast("double").alias("label")).na.drop())
    error = (F.col("label") - F.col("prediction")) * (F.col("label") - F.col("prediction"))
    spread = F.nullif(F.var_pop("label") * F.count("label"), F.lit(0.0))
    score = F.avg((F.col("label") == F.col("prediction")).cast("double")) if task == "classification" else 1 - F.sum(error) / spread
    out = None
    for seed in seeds:
        n, std = _size_and_spread(rows.agg(*_label_moments()).collect())
        stages = [VectorAssembler(inputCols=list(numeric), outputCol="features"), get_estimator(model, task, seed, trees, depth, n_rows=n, label_std=std)]
        fitted = Pipeline(stages=stages).fit(rows)
        part = robustness.permutation_importance(rows, key, numeric, fitted.transform, score, repeats, [seed])
        out = part if out is None else out.unionByName(part)
    return out


def kmeans_scan(df: DataFrame, vector: str, ks: Sequence[int] = range(3, 9), seed: int = 42) -> DataFrame:
    """Silhouette for each k; the best one is marked. All clusterings are judged together (``clusters.silhouettes``)."""
    data = df.select(array_to_vector(F.col(vector).cast("array<double>")).alias("features")).persist()
    centres = {int(k): [c.tolist() for c in KMeans(k=k, seed=seed, featuresCol="features").fit(data).clusterCenters()] for k in ks}
    data.unpersist()
    judged = clusters.silhouettes(df, vector, centres)
    best = judged.agg(F.max_by("k", F.struct("silhouette", -F.col("k"))).alias("__best"))
    return judged.crossJoin(F.broadcast(best)).select("k", "silhouette", "cost", (F.col("k") == F.col("__best")).alias("is_best"))
