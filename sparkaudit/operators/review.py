"""From the notes of many runs to both verdicts, with the model that each run names.

A run's plan and loop notes say which table, target, metric, features and model it ends
with. Runs that ask for the same (table, target, features, model, splitter) share one
*unit*: it is fitted once per seed and fold and once more without each feature, and its
scores go to all runs that asked for it. Ridge units of a table, however many, are solved
from one set of moments; other models are fitted one after the other.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from ..sources import notes
from . import baselines, infold, linear, metrics, models, rates, robustness, significance
from .features import prepare_whole, scorer_for
from .folds import DEFAULT_SEEDS, ordered_blocks, seeded_folds

LINEAR_SCORERS = ("neg_root_mean_squared_error", "r2", "neg_mean_absolute_error")
SPLIT = ("splitter", "seed", "fold")
JUDGE_SEED = 42
MAX_OTHER_FITS = 200


@dataclass(frozen=True)
class Dataset:
    """A table under review: its key (a number), the columns runs may name, and a time column if it has one."""

    rows: DataFrame
    key: str
    columns: Sequence[str]
    time: str | None = None


@dataclass
class Review:
    """All steps of a review, each a table; ``run_id`` of the middle ones names a unit and scorer."""

    requests: DataFrame
    scores: DataFrame
    tests: DataFrame
    drops: DataFrame
    stability: DataFrame
    verdicts: DataFrame


def _family(model: Column, task: Column) -> Column:
    """Kind of model behind a name; unknown names are a random forest. The parts of names are fixed values."""
    name = F.upper(F.coalesce(model, F.lit("")))
    has = lambda *parts: F.greatest(*[name.contains(p).cast("int") for p in parts], F.lit(0)) == 1
    boosted = has("XGB", "LIGHTGBM", "LGBM", "GRADIENTBOOSTING", "GBT")
    return (
        F.when((task == "regression") & has("RIDGE"), "ridge")
        .when((task == "classification") & has("RANDOMFOREST", "RF"), "forest")
        .when(boosted, "boosted")
        .when((task == "classification") & has("LOGISTIC", "LR"), "logistic")
        .otherwise("forest")
    )


def _digest(*parts: Column) -> Column:
    return F.sha2(F.to_json(F.struct(*[p.alias(f"p{i}") for i, p in enumerate(parts)])), 256)


def fit_id(splitter: Column, target: Column, features: Column, family: Column | str = "ridge", dataset: Column | str = "") -> Column:
    as_column = lambda x: F.lit(x) if isinstance(x, str) else x
    return _digest(as_column(dataset), splitter, target, as_column(family), features)


def requests(plans: DataFrame, cycles: DataFrame, datasets: Mapping[str, Dataset]) -> DataFrame:
    """One row per run of ``plans`` (run_id, dataset, text): what is to be fitted and judged, or why not.

    Best features that the table lacks are ignored; without any, all columns but the target
    are used. ``status`` is ``unsupported`` for other tasks than classification and
    regression, ``no_data`` for an unknown table or target, else ``ok``.
    """
    read = notes.plan_info(plans).join(plans.select("run_id", "dataset"), "run_id")
    best = notes.cycle_info(cycles).select("run_id", "best_features_list", "best_model")
    known = [(name, list(d.columns)) for name, d in datasets.items()]
    tables = plans.sparkSession.createDataFrame(known, "dataset string, columns array<string>")
    joined = read.join(best, "run_id", "left").join(F.broadcast(tables), "dataset", "left")  # a row per table
    task, target = F.col("analysis_type"), F.col("target_variable")
    named = F.array_intersect("best_features_list", "columns")
    others = F.filter("columns", lambda c: c != target)
    supported = F.coalesce(task.isin("classification", "regression"), F.lit(False))
    present = F.coalesce(F.array_contains("columns", target), F.lit(False))
    splitter = F.when(F.col("is_time_series"), "time").when(task == "classification", "stratified").otherwise("kfold")
    found = joined.select(
        "run_id", "dataset", task.alias("task"), target.alias("target"), "success_metric",
        scorer_for(F.col("success_metric"), task).alias("scorer"), _family(F.col("best_model"), task).alias("family"),
        splitter.alias("splitter"), F.when(F.coalesce(F.size(named), F.lit(0)) > 0, named).otherwise(others).alias("features"),
        F.when(~supported, "unsupported").when(~present, "no_data").otherwise("ok").alias("status"),
    )
    unit = fit_id(F.col("splitter"), F.col("target"), F.col("features"), F.col("family"), F.col("dataset"))
    return found.withColumn("unit", F.when(F.col("status") == "ok", unit)).withColumn(
        "review", F.when(F.col("status") == "ok", _digest(unit, F.col("scorer")))
    )


def wanted_units(asked: DataFrame) -> DataFrame:
    """The distinct units and scorers of ``requests`` (written, so that no note is read twice), a row each, written once."""
    return cut_lineage(asked.where("status = 'ok'").select(
        "unit", "review", "dataset", "task", "target", "scorer", "family", "splitter", "features"
    ).distinct())


def feature_sets(units: DataFrame) -> DataFrame:
    """Each unit in full (``left_out`` NULL) and without each of its features; a single feature is not left out.

    ``fit`` names the fit, so that equal feature sets of several units are fitted once.
    """
    full = units.withColumn("left_out", F.lit(None).cast("string"))
    less = units.where(F.size("features") > 1).withColumn("left_out", F.explode("features"))
    less = less.withColumn("features", F.filter("features", lambda f: f != F.col("left_out")))
    both = full.unionByName(less)
    return both.withColumn("fit", fit_id(F.col("splitter"), F.col("target"), F.col("features"), F.col("family"), F.col("dataset")))


def folds_of(data: Dataset, splitter: str, target: str | None, k: int, seeds: Sequence[int]) -> DataFrame:
    """Prepared rows with ``splitter``, ``seed`` and ``fold``; for a time split every seed has the same blocks."""
    if splitter == "time":
        order = F.unix_micros(F.col(data.time).cast("timestamp")) if data.time else F.col(data.key)
        blocks = ordered_blocks(data.rows.withColumn("__order", order), "__order", data.key, k).where("block is not null")
        split = blocks.withColumn("seed", F.explode(F.array(*[F.lit(s) for s in seeds]))).withColumn("fold", F.col("block"))
    else:
        split = seeded_folds(data.rows, data.key, target if splitter == "stratified" else None, k, seeds)
    return split.select(
        F.lit(splitter).alias("splitter"), "seed", F.col("fold").cast("int").alias("fold"), data.key, *data.columns
    )


def _prepared(data: Dataset) -> Dataset:
    """Missing values filled by medians, texts coded, everything a number, written once."""
    kinds = dict(data.rows.dtypes)
    text = [c for c in data.columns if kinds[c] == "string"]
    numeric = [c for c in data.columns if c not in text]
    kept = data.rows.select(data.key, *([data.time] if data.time else []), *[
        F.col(c) if c in text else F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(c) for c in data.columns
    ])
    ready = prepare_whole(kept, numeric, text)
    return Dataset(
        cut_lineage(ready.withColumns({c: F.col(c).cast("double") for c in data.columns})), data.key, list(data.columns), data.time
    )


def _target_groups(data: Dataset, targets: Sequence[str]) -> list[tuple[Dataset, list[str]]]:
    """Targets by the rows they can be fitted on: those without gaps share all rows, each other one has its own."""
    gaps = data.rows.agg(*[F.count_if(F.col(t).isNull() | _is_nan(data.rows, t)).alias(f"g{i}") for i, t in enumerate(targets)]).first()
    whole = [t for i, t in enumerate(targets) if not gaps[i]]
    out = [(data, whole)] if whole else []
    for i, t in enumerate(targets):
        if gaps[i]:
            filled = data.rows.where(F.col(t).isNotNull() & ~_is_nan(data.rows, t))
            out.append((Dataset(filled, data.key, data.columns, data.time), [t]))
    return out


def _is_nan(rows: DataFrame, column: str) -> Column:
    return F.isnan(column) if dict(rows.dtypes)[column] in ("double", "float") else F.lit(False)


def _linear(name: str, data: Dataset, fits: DataFrame, targets: Sequence[str], splitters: Sequence[str], k: int, seeds: Sequence[int]) -> DataFrame:
    """Scores (fit, splitter, seed, fold, scorer, score) of ridge fits and of both naive regressors on one table."""
    folds = None
    for splitter in splitters:
        own = folds_of(data, splitter, None, k, seeds)
        folds = own if folds is None else folds.unionByName(own)
    folds = cut_lineage(folds)
    columns = list(data.columns)
    moments = cut_lineage(linear.fold_moments(folds, columns[:-1], columns[-1], SPLIT))  # one row per split
    expanding = F.col("splitter") == "time"
    fitted = cut_lineage(linear.ridge_fits(moments, fits.select("splitter", "fit", "target", "features"), columns, SPLIT, expanding=expanding))
    by_moments = fitted.select(
        "fit", *SPLIT, (-F.col("rmse")).alias("neg_root_mean_squared_error"), "r2"
    ).unpivot(["fit", *SPLIT], ["neg_root_mean_squared_error", "r2"], "scorer", "score")

    def trains(test, own):
        return test[:-1] == own[:-1] and (own[-1] < test[-1] if test[0] == "time" else own[-1] != test[-1])

    middle = infold.train_quantiles(folds, targets, [0.5], SPLIT, trains)
    constant = middle.select(
        *SPLIT, fit_id(F.col("splitter"), F.col("column"), F.array().cast("array<string>"), "median", name).alias("fit"),
        F.col("column").alias("target"), F.array().cast("array<string>").alias("features"), F.col("value").alias("intercept"),
        F.array().cast("array<double>").alias("coefs"),
    )
    absolute = fitted.join(F.broadcast(fits.where("by_rows").select("fit")), "fit", "left_semi")
    by_rows = linear.linear_scores(folds, constant.unionByName(absolute.select(*constant.columns)), columns, SPLIT)
    long = by_rows.unpivot(["fit", *SPLIT], list(LINEAR_SCORERS), "scorer", "score")
    asked = fits.select("fit").distinct().withColumn("moments", F.lit(True))
    rest = long.join(F.broadcast(asked), "fit", "left").where(F.col("moments").isNull() | (F.col("scorer") == "neg_mean_absolute_error"))
    return by_moments.unionByName(rest.select(*by_moments.columns))


def _other(data: Dataset, unit, scorers: Sequence[str], k: int, seeds: Sequence[int], options: dict) -> DataFrame:
    """Scores of one fit by Spark ML."""
    key, splitter = data.key, unit["splitter"]
    plain = {c: f"x{i}" for i, c in enumerate(data.columns)}  # no name of a run's table can clash
    folds = cut_lineage(folds_of(data, splitter, unit["target"], k, seeds).withColumnsRenamed(plain))
    first = 1 if splitter == "time" else 0
    splits = [(s, f) for s in seeds for f in range(first, k + first)]
    kind = {"forest": "RandomForest", "boosted": "XGBoost", "logistic": "LogisticRegression", "ridge": "Ridge"}[unit["family"]]
    preds = models.out_of_fold(
        folds, key, [plain[c] for c in unit["features"]], [], plain[unit["target"]], kind, unit["task"], unit["fit"], splits,
        earlier=splitter == "time", **options,
    )
    return _as_scores(preds, splitter, scorers)


def _naive_classifiers(name: str, data: Dataset, splitter: str, target: str, scorers: Sequence[str], k: int, seeds: Sequence[int]) -> list[DataFrame]:
    """Scores of the majority class and, outside time splits, of draws from the class shares."""
    folds = cut_lineage(folds_of(data, splitter, target, k, seeds))
    none = F.array().cast("array<string>")
    ids = {m: fit_id(F.lit(splitter), F.lit(target), none, m, name) for m in ("majority", "stratified")}
    trains = infold.earlier_blocks if splitter == "time" else infold.other_folds
    modes = infold.train_modes(folds, [target], trains=trains).select("seed", "fold", F.col("mode").cast("double").alias("pred"))
    constant = folds.join(F.broadcast(modes), ["seed", "fold"]).withColumn("prob", F.col("pred"))
    parts = [constant.withColumn("model", ids["majority"])]
    if splitter != "time":
        drawn = baselines.predict_stratified(folds.withColumn(target, F.col(target).cast("int")), target, data.key)
        parts.append(drawn.withColumn("model", ids["stratified"]))
    out = []
    for p in parts:
        cells = p.select(F.col("model").alias("run_id"), "seed", "fold", F.col(target).cast("double").alias("label"), "pred", "prob")
        out.append(_as_scores(cells, splitter, scorers))
    return out


def _as_scores(preds: DataFrame, splitter: str, scorers: Sequence[str]) -> DataFrame:
    scored = metrics.scores(cut_lineage(preds), list(scorers), ["run_id", "seed", "fold"])
    return scored.select(
        F.col("run_id").alias("fit"), F.lit(splitter).alias("splitter"), "seed", "fold", F.col("metric").alias("scorer"), "score"
    )


def score_units(
    wanted: DataFrame, datasets: Mapping[str, Dataset], k: int, seeds: Sequence[int], options: dict | None = None
) -> DataFrame:
    """Scores of all fits that the units need: fit, splitter, seed, fold, scorer, score.

    Only names of tables, targets and splitters reach the driver, and the list of fits that
    are no ridge, which is refused beyond MAX_OTHER_FITS.
    """
    sets = cut_lineage(feature_sets(wanted.select("unit", "dataset", "task", "target", "family", "splitter", "features").distinct()))
    scorers = wanted.select("unit", "scorer").distinct()
    asked = sets.join(scorers, "unit").groupBy("dataset", "splitter", "target", "task", "family").agg(
        F.collect_set("scorer").alias("scorers")
    ).collect()  # at most tables x targets x splitters x kinds of model
    parts: list[DataFrame] = []
    for name in sorted({a["dataset"] for a in asked}):
        mine = [a for a in asked if a["dataset"] == name]
        for data, targets in _target_groups(datasets[name], sorted({a["target"] for a in mine})):
            ready = _prepared(data)
            here = [a for a in mine if a["target"] in targets]
            regression = [a for a in here if a["task"] == "regression"]
            if regression:
                own = sets.where((F.col("dataset") == name) & F.col("target").isin(targets) & (F.col("task") == "regression"))
                absolute = own.join(scorers, "unit").groupBy("fit").agg(F.bool_or(F.col("scorer") == "neg_mean_absolute_error").alias("by_rows"))
                ridge = own.where("family = 'ridge'").select("splitter", "fit", "target", "features").distinct()
                naive = own.select(
                    "splitter", fit_id(F.col("splitter"), F.col("target"), F.array().cast("array<string>"), "mean", name).alias("fit"),
                    "target", F.array().cast("array<string>").alias("features"),
                ).distinct()
                fits = ridge.join(absolute, "fit").unionByName(naive.withColumn("by_rows", F.lit(True)))
                kinds = sorted({a["splitter"] for a in regression})
                parts.append(_linear(name, ready, cut_lineage(fits), sorted({a["target"] for a in regression}), kinds, k, seeds))
            others = sets.where(
                (F.col("dataset") == name) & F.col("target").isin(targets) & (F.col("family") != "ridge")
            ).select("splitter", "target", "task", "family", "features", "fit").distinct().limit(MAX_OTHER_FITS + 1).collect()
            if len(others) > MAX_OTHER_FITS:
                raise ValueError(f"more than {MAX_OTHER_FITS} different fits by Spark ML on {name}")
            for unit in others:
                need = sorted({s for a in here if a["target"] == unit["target"] and a["task"] == unit["task"] for s in a["scorers"]})
                parts.append(_other(ready, unit, need, k, seeds, options or {}))
            for a in {(a["splitter"], a["target"]): a for a in here if a["task"] == "classification"}.values():
                need = sorted({s for b in here if b["target"] == a["target"] and b["task"] == "classification" for s in b["scorers"]})
                parts += _naive_classifiers(name, ready, a["splitter"], a["target"], need, k, seeds)
    if not parts:
        return wanted.sparkSession.createDataFrame([], "fit string, splitter string, seed int, fold int, scorer string, score double")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def review(
    plans: DataFrame, cycles: DataFrame, datasets: Mapping[str, Dataset], k: int = 5, seeds: Sequence[int] = DEFAULT_SEEDS,
    replicates: int = 2000, n_perm: int = 10000, **options,
) -> Review:
    """Both verdicts of every run.

    ``plans`` has run_id, dataset and text, ``cycles`` run_id and text. Significance compares
    the folds of seed 42 with both naive models, robustness all seeds. A scorer that a
    model has no value for (AUC of a regression) leaves no scores, which fails. ``options`` go to
    ``models.out_of_fold`` (trees, depth). Runs with the same unit and scorer share one row until the end.
    """
    if JUDGE_SEED not in seeds:
        raise ValueError(f"the seeds hold {JUDGE_SEED}")
    asked = cut_lineage(requests(plans, cycles, datasets))
    wanted = wanted_units(asked)
    scores = cut_lineage(score_units(wanted, datasets, k, seeds, options).where("score is not null"))

    none = F.array().cast("array<string>")
    naive = lambda kind: fit_id(F.col("splitter"), F.col("target"), none, kind, F.col("dataset"))
    by_task = F.when(
        F.col("task") == "regression", F.array(*[F.struct(F.lit(m).alias("model"), naive(m).alias("fit")) for m in ("mean", "median")])
    ).otherwise(F.array(*[F.struct(F.lit(m).alias("model"), naive(m).alias("fit")) for m in ("majority", "stratified")]))
    own = feature_sets(wanted).select("review", "scorer", "left_out", "fit")
    best = cut_lineage(own.join(scores, ["fit", "scorer"]).select(F.col("review").alias("run_id"), "left_out", "seed", "fold", "score"))
    full = best.where("left_out is null")
    base = cut_lineage(
        wanted.select("review", "scorer", F.explode(by_task).alias("b")).select("review", "scorer", "b.*")
        .join(scores.where(F.col("seed") == JUDGE_SEED), ["fit", "scorer"])
        .select(F.col("review").alias("run_id"), "model", "seed", "fold", "score")
    )
    diffs = significance.differences(full.where(F.col("seed") == JUDGE_SEED), base)
    tests = cut_lineage(significance.compare(diffs, replicates=replicates, n_perm=n_perm))
    judged = significance.verdict(significance.gates(tests))

    means = best.groupBy("run_id", "left_out").agg(F.avg("score").alias("score"))
    whole = means.where("left_out is null").select("run_id", F.col("score").alias("full_score"))
    drop = F.col("full_score") - F.col("score")
    drops = cut_lineage(robustness.lofo_classes(means.where("left_out is not null").join(whole, "run_id").select(
        "run_id", F.col("left_out").alias("feature"), "score", drop.alias("drop"),
        F.coalesce(drop / F.nullif(F.abs("full_score"), F.lit(0.0)) * 100, F.lit(0.0)).alias("drop_pct"),
    )))
    ci = significance.bootstrap_ci(full, ["run_id"], "score", replicates)
    plain = base.where(F.col("model").isin("mean", "majority")).groupBy("run_id").agg(F.avg("score").alias("baseline_mean"))
    spread = rates.score_summary(full, ["run_id"])
    stable = robustness.gates(spread, ci, plain, drops)

    statistical = judged.select(
        F.col("run_id").alias("review"), "g1", "g2", "g3", "g4", F.col("verdict").alias("statistical")
    )
    robust = stable.select(
        F.col("run_id").alias("review"), "g1_stability", "g2_ci_above_baseline", "g3_lofo", F.col("verdict").alias("robust")
    )
    told = asked.join(statistical, "review", "left").join(robust, "review", "left")
    rule = lambda c: F.when(F.col("status") == "unsupported", "N/A").otherwise(F.coalesce(c, F.lit("FAIL")))
    verdicts = told.select(
        "run_id", "dataset", "task", "target", "scorer", "family", "splitter", "features", "status", "g1", "g2", "g3", "g4",
        rule("statistical").alias("statistical_verdict"), "g1_stability", "g2_ci_above_baseline", "g3_lofo",
        rule("robust").alias("robustness_verdict"),
    )
    return Review(asked, scores, tests, drops, spread.join(ci, "run_id", "left"), verdicts)
