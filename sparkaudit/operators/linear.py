"""Ridge regression from per-fold moments: one scan serves every split and every
leave-one-feature-out refit."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from types import SimpleNamespace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.gram import pair_sums

SPLIT = ("seed", "fold")


def fold_moments(
    folds: DataFrame, features: Sequence[str], target: str, split: Sequence[str] = SPLIT
) -> DataFrame:
    """Count, sums and cross products of (features, target) per split, around ``shift``.

    Matrix products per batch (``functions.gram``), so the plan does not grow with the number
    of columns. Rows with a missing value are left out.
    """
    cols, split = [*features, target], list(split)
    width = len(cols)
    rows = folds.select(*split, *[_number(c).alias(f"x{i}") for i, c in enumerate(cols)])
    rows = rows.na.drop(subset=[f"x{i}" for i in range(width)])
    sums = pair_sums(rows, [f"x{i}" for i in range(width)], split)
    upper = np.triu_indices(width)

    def whole(key, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("i")
        shift, n = np.asarray(pdf["centre"].iloc[0], float), float(pdf["n"].iloc[0][0])
        cross = np.empty((width, width))
        for i, (centre, first, other, own) in enumerate(zip(pdf["centre"], pdf["first"], pdf["other"], pdf["cross"])):
            by = np.asarray(centre, float) - shift
            cross[i] = np.asarray(own) + by[i] * np.asarray(other) + by * np.asarray(first) + n * by[i] * by
        by = np.asarray(pdf["centre"].iloc[0], float) - shift
        total = np.asarray(pdf["other"].iloc[0], float) + n * by
        return pd.DataFrame([(*key, int(n), total.tolist(), cross[upper].tolist(), shift.tolist())], columns=[*split, "n", "sums", "cross", "shift"])

    kinds = dict(rows.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in split) + ", n bigint, sums array<double>, cross array<double>, shift array<double>"
    return sums.groupBy(*split).applyInPandas(whole, schema)


def _number(column: str) -> Column:
    return F.nanvl(F.col(column).cast("double"), F.lit(None).cast("double"))


def _with_totals(moments: DataFrame, split: Sequence[str], width: int, expanding: Column | None = None) -> DataFrame:
    """Add training moments next to the test ones: total over the other splits, or over the earlier ones where ``expanding``.

    The splits of a group (folds of a seed) meet in one task, moved to one shift.
    """
    *group, fold = split
    upper = np.triu_indices(width)
    flagged = moments.withColumn("__e", F.lit(False) if expanding is None else expanding).withColumn("__g", F.lit(0))

    def told(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(fold).reset_index(drop=True)
        shift = np.asarray(pdf["shift"].iloc[0], float)
        n = pdf["n"].to_numpy(float)
        sums, cross = [], []
        for count, s, c, own in zip(n, pdf["sums"], pdf["cross"], pdf["shift"]):
            by, s, c = np.asarray(own, float) - shift, np.asarray(s, float), _square(c, width)
            sums.append(s + count * by)
            cross.append((c + np.outer(by, s) + np.outer(s, by) + count * np.outer(by, by))[upper])
        sums, cross = np.array(sums), np.array(cross)
        if pdf["__e"].iloc[0]:
            train = [np.cumsum(x, 0) - x for x in (n, sums, cross)]
        else:
            train = [x.sum(0) - x for x in (n, sums, cross)]
        pdf["sums"], pdf["cross"], pdf["shift"] = list(sums), list(cross), [shift] * len(pdf)
        pdf["train_n"], pdf["train_sums"], pdf["train_cross"] = train[0].astype(int), list(train[1]), list(train[2])
        return pdf.drop(columns=["__e", "__g"])

    kinds = ", ".join(f"`{c}` {t}" for c, t in moments.dtypes)
    schema = f"{kinds}, train_n bigint, train_sums array<double>, train_cross array<double>"
    return flagged.groupBy("__g", *group).applyInPandas(told, schema)


def _square(cross, width: int) -> np.ndarray:
    out = np.zeros((width, width))
    rows, cols = np.triu_indices(width)
    out[rows, cols] = cross
    out[cols, rows] = cross
    return out


class Cell:
    """Moments of one split: test moments around the means of its training set, and the training set's own."""

    def __init__(self, r, width: int):
        self.n, train_n = int(r.n), float(r.train_n)
        sums, cross = np.asarray(r.sums, float), _square(r.cross, width)
        mean = np.asarray(r.train_sums, float) / train_n
        self.mean = mean + np.asarray(r.shift, float)
        self.train = _square(r.train_cross, width) - train_n * np.outer(mean, mean)
        self.test = cross - np.outer(sums, mean) - np.outer(mean, sums) + self.n * np.outer(mean, mean)
        spread = np.diag(cross) - sums**2 / self.n
        self.spread = np.where(spread > 1e-12 * np.diag(cross), spread, 0.0)  # what rounding leaves of a constant

    def ridge(self, features: Sequence[int], target: int, alpha: float) -> tuple[np.ndarray, float, float, float | None]:
        """Coefficients, intercept, RMSE and R2 on the test rows; without features the training mean."""
        k = np.array(features, dtype=int)
        beta = np.linalg.solve(self.train[np.ix_(k, k)] + alpha * np.eye(len(k)), self.train[k, target]) if len(k) else np.zeros(0)
        sse = self.test[target, target] - 2 * beta @ self.test[k, target] + beta @ self.test[np.ix_(k, k)] @ beta
        sse, sst = max(float(sse), 0.0), float(self.spread[target])
        intercept = float(self.mean[target] - beta @ self.mean[k])
        return beta, intercept, float(np.sqrt(sse / self.n)), 1 - sse / sst if sst > 0 else None


def ridge_cv(
    folds: DataFrame,
    features: Sequence[str],
    target: str,
    alpha: float = 1.0,
    leave_out: bool = True,
    split: Sequence[str] = SPLIT,
) -> DataFrame:
    """Out-of-fold RMSE, R2 and coefficients per (split, feature set).

    Feature set ``full``, and one ``-name`` per left-out feature. The linear systems
    are p x p and solved where the moment rows are.
    """
    names = list(features)
    width = len(names) + 1
    moments = _with_totals(fold_moments(folds, names, target, split), split, width)
    sets = [("full", list(range(width - 1)))]
    if leave_out:
        sets += [(f"-{c}", [j for j in range(width - 1) if j != i]) for i, c in enumerate(names)]

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for r in pdf.itertuples(index=False):
                cell = Cell(r, width)
                for label, keep in sets:
                    beta, intercept, rmse, r2 = cell.ridge(keep, width - 1, alpha)
                    coefs = np.zeros(width - 1)
                    coefs[keep] = beta
                    out.append((*[getattr(r, c) for c in split], label, cell.n, rmse, r2, intercept, coefs.tolist()))
            yield pd.DataFrame(
                out, columns=[*split, "feature_set", "n_test", "rmse", "r2", "intercept", "coefs"]
            )

    kinds = dict(moments.dtypes)
    schema = ", ".join(f"{c} {kinds[c]}" for c in split) + (
        ", feature_set string, n_test bigint, rmse double, r2 double, intercept double, coefs array<double>"
    )
    return moments.mapInPandas(solve, schema)


def ridge_fits(
    moments: DataFrame, fits: DataFrame, columns: Sequence[str], split: Sequence[str], alpha: float = 1.0,
    expanding: Column | None = None, per_task: int = 500,
) -> DataFrame:
    """Many ridge fits over the same moments: fit, split keys, n_test, rmse, r2, intercept, coefs (in order of its features).

    ``fits`` has the leading split keys but the last two, ``fit``, ``target`` and ``features`` (an array of
    column names). Fits travel in packs of ``per_task`` next to the moments of each split, so
    the rows of the table are not read again.
    """
    names = list(columns)
    width, group = len(names), list(split)[:-2]
    packs = max(1, -(-fits.count() // per_task))
    packed = (
        fits.withColumn("__p", F.pmod(F.xxhash64("fit"), F.lit(packs)))
        .groupBy(*group, "__p").agg(F.collect_list(F.struct("fit", "target", "features")).alias("f"))
        .select(*group, *[F.col(f"f.{c}").alias(f"__{c}") for c in ("fit", "target", "features")])
    )
    cells = _with_totals(moments, split, width, expanding).where("train_n > 0").join(packed, group)
    parts = int(moments.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at = {c: i for i, c in enumerate(names)}
        for pdf in batches:
            out = []
            for r in pdf.to_dict("records"):
                cell = Cell(SimpleNamespace(**r), width)
                for fit, target, own in zip(r["__fit"], r["__target"], r["__features"]):
                    beta, intercept, rmse, r2 = cell.ridge([at[c] for c in own], at[target], alpha)
                    out.append((*[r[c] for c in split], fit, target, list(own), cell.n, rmse, r2, intercept, beta.tolist()))
            yield pd.DataFrame(out, columns=[*split, "fit", "target", "features", "n_test", "rmse", "r2", "intercept", "coefs"])

    kinds = dict(moments.dtypes)
    schema = ", ".join(f"{c} {kinds[c]}" for c in split) + (
        ", fit string, target string, features array<string>, n_test bigint, rmse double, r2 double, intercept double, coefs array<double>"
    )
    return cells.repartition(parts).mapInPandas(solve, schema)


def ridge_all(df: DataFrame, features: Sequence[str], target: str, alpha: float = 1.0) -> DataFrame:
    """The model of all rows as a table of one row: intercept and coefs."""
    names = list(features)
    width = len(names) + 1
    whole = fold_moments(df.withColumn("__all", F.lit(0)), names, target, ["__all"])
    moments = whole.selectExpr("*", "n AS train_n", "sums AS train_sums", "cross AS train_cross")

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = [Cell(r, width).ridge(range(width - 1), width - 1, alpha) for r in pdf.itertuples(index=False)]
            yield pd.DataFrame([(intercept, beta.tolist()) for beta, intercept, *_ in found], columns=["intercept", "coefs"])

    return moments.mapInPandas(solve, "intercept double, coefs array<double>")


def predict_all(df: DataFrame, model: DataFrame, features: Sequence[str]) -> DataFrame:
    """``df`` with ``pred`` by a model of one row; rows with a missing feature have none."""
    terms = sum((F.col("__coefs")[i] * F.col(c) for i, c in enumerate(features)), F.col("__intercept"))
    one = model.select(F.col("intercept").alias("__intercept"), F.col("coefs").alias("__coefs"))
    return df.crossJoin(F.broadcast(one)).withColumn("pred", terms).drop("__intercept", "__coefs")


def linear_scores(
    folds: DataFrame, fitted: DataFrame, columns: Sequence[str], split: Sequence[str], per_pass: int = 20_000
) -> DataFrame:
    """RMSE, MAE and R2 of linear models on the rows of their split: fit, split keys and the three scores.

    ``fitted`` has the split keys, ``fit``, ``target``, ``features``, ``intercept`` and ``coefs``. At most
    ``per_pass`` models are broadcast at once; more of them take further passes.
    """
    place = F.create_map(*[x for i, c in enumerate(columns) for x in (F.lit(c), F.lit(i))])
    passes = max(1, -(-fitted.count() // per_pass))
    models = fitted.select(
        *[F.col(c).alias(f"__{c}") for c in split], "fit", "intercept", "coefs", F.element_at(place, F.col("target")).alias("__y"),
        F.transform("features", lambda f: F.element_at(place, f)).alias("__at"),
    )
    rows = folds.select(*split, F.array(*[F.col(c).cast("double") for c in columns]).alias("__v"))
    same = F.lit(True)
    for c in split:
        same = same & (F.col(c) == F.col(f"__{c}"))
    error = F.expr("get(__v, __y) - aggregate(zip_with(coefs, __at, (c, p) -> c * get(__v, p)), intercept, (t, x) -> t + x)")
    out = None
    for i in range(passes):
        mine = models.where(F.pmod(F.xxhash64("fit"), F.lit(passes)) == i)
        scored = rows.join(F.broadcast(mine), same).select(*split, "fit", error.alias("e"), F.expr("get(__v, __y)").alias("y"))
        spread = F.nullif(F.var_pop("y") * F.count("y"), F.lit(0.0))
        part = scored.groupBy("fit", *split).agg(
            (-F.sqrt(F.avg(F.col("e") * F.col("e")))).alias("neg_root_mean_squared_error"),
            (-F.avg(F.abs("e"))).alias("neg_mean_absolute_error"), (1 - F.sum(F.col("e") * F.col("e")) / spread).alias("r2"),
        )
        out = part if out is None else out.unionByName(part)
    return out


def ridge_predict(
    folds: DataFrame, fitted: DataFrame, features: Sequence[str], split: Sequence[str] = SPLIT
) -> DataFrame:
    """Out-of-fold predictions of the full model; the fitted side has seeds x folds rows."""
    full = fitted.where(F.col("feature_set") == "full").select(*split, "intercept", "coefs")
    terms = sum((F.col("coefs")[i] * F.col(c) for i, c in enumerate(features)), F.col("intercept"))
    return (
        folds.join(F.broadcast(full), list(split))
        .withColumn("pred", terms)
        .withColumn("prob", F.lit(None).cast("double"))
        .drop("intercept", "coefs")
    )


def lofo(scored: DataFrame, metric: str) -> DataFrame:
    """Score, drop and drop percent per left-out feature, from a (feature_set, metric) table."""
    means = scored.groupBy("feature_set").agg(F.avg(metric).alias("score"))
    full = means.where(F.col("feature_set") == "full").select(F.col("score").alias("full_score"))
    out = means.where(F.col("feature_set") != "full").crossJoin(F.broadcast(full))
    drop = F.col("full_score") - F.col("score")
    return out.select(
        F.expr("substring(feature_set, 2)").alias("feature"),
        "score",
        drop.alias("drop"),
        F.coalesce(drop / F.nullif(F.abs("full_score"), F.lit(0.0)) * 100, F.lit(0.0)).alias("drop_pct"),
    )
