"""Statistics of training sets against numpy on the rows themselves."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkaudit.operators import baselines, infold, models

KEYS = "seed int, fold int, "


def _rows(n, seed=3):
    rng = random.Random(seed)
    pick = lambda: rng.choice([None, float("nan"), 0.0, 0.0, 1e9, 1e9 + 1, rng.gauss(0, 1), float(rng.randrange(5))])
    return [(s, rng.randrange(4), pick(), pick() if rng.random() < 0.3 else None, rng.choice([None, "a", "b", "b", "c"])) for _ in range(n) for s in (0, 42)]


@pytest.fixture(scope="module")
def folds(spark):
    rows = _rows(150)
    return rows, spark.createDataFrame(rows, KEYS + "x double, y double, t string").repartition(5)


def _train(rows, seed, fold, at, earlier=False):
    own = [r[at] for r in rows if r[0] == seed and (r[1] < fold if earlier else r[1] != fold)]
    return own, np.array([v for v in own if v is not None and v == v], dtype=object)


@pytest.mark.parametrize("earlier", [False, True])
def test_train_quantiles(folds, earlier):
    rows, df = folds
    trains = infold.earlier_blocks if earlier else infold.other_folds
    got = infold.train_quantiles(df, ["x", "y"], [0.0, 0.25, 0.5, 0.9], trains=trains).collect()
    assert len(got) == 2 * 2 * 4 * (3 if earlier else 4)
    for r in got:
        _, known = _train(rows, r.seed, r.fold, 2 if r.column == "x" else 3, earlier)
        assert r.value == pytest.approx(np.quantile(known.astype(float), r.prob), rel=1e-12, abs=1e-12)


def test_train_modes(folds):
    rows, df = folds
    for r in infold.train_modes(df, ["t"]).collect():
        _, known = _train(rows, r.seed, r.fold, 4)
        assert r["mode"] == min(set(known), key=lambda v: (-list(known).count(v), v))


def test_fill_and_scale_of_a_split(folds):
    rows, df = folds
    learned = infold.fit(df, ["x", "y"], ["t"]).collect()
    assert len(learned) == 2 * 4 * 3
    for r in learned:
        if r.column == "t":
            continue
        own, known = _train(rows, r.seed, r.fold, 2 if r.column == "x" else 3)
        fill = np.median(known.astype(float))
        filled = np.array([fill if v is None or v != v else v for v in own])
        assert r.fill == pytest.approx(fill)
        assert r["mean"] == pytest.approx(filled.mean(), rel=1e-9) and r.spread == pytest.approx(filled.std(), rel=1e-6)
    one = [r.asDict() for r in learned if (r.seed, r.fold) == (42, 1)]
    ready = infold.apply(df.where("seed = 42"), one, ["x", "y"], ["t"])
    train = ready.where("fold <> 1").agg(F.avg("x").alias("m"), F.stddev_pop("y").alias("s"), F.count_if(F.col("t").isNull()).alias("n")).first()
    assert train.m == pytest.approx(0, abs=1e-6) and train.s == pytest.approx(1, rel=1e-6) and train.n == 0


def test_constant_and_empty_columns(spark):
    df = spark.createDataFrame([(0, i % 2, 5.0, None) for i in range(6)], KEYS + "c double, e double")
    got = {(r.fold, r.column): r for r in infold.fit(df, ["c", "e"]).collect()}
    assert got[0, "c"].fill == 5 and got[0, "c"].spread == 0
    assert got[0, "e"].fill is None
    ready = infold.apply(df, [got[0, "c"].asDict(), got[0, "e"].asDict()], ["c", "e"]).collect()
    assert {(r.c, r.e) for r in ready} == {(0.0, None)}
    assert infold.train_quantiles(df.where("false"), ["c"], [0.5]).count() == 0


def test_median_baseline_reads_the_training_rows_only(folds):
    rows, df = folds
    pred = {(r.seed, r.fold): r.pred for r in baselines.predict_median(df, "x").collect()}
    for (seed, fold), value in pred.items():
        assert value == pytest.approx(np.median(_train(rows, seed, fold, 2)[1].astype(float)))


def test_models_use_exact_statistics(spark):
    rng = random.Random(5)
    rows = [(0, i % 3, i, rng.gauss(0, 1) if i % 7 else None, rng.choice("ab"), i % 2) for i in range(120)]
    df = spark.createDataFrame(rows, "seed int, fold int, id bigint, x double, t string, label int")
    preds = models.out_of_fold(df, "id", ["x"], ["t"], "label", "LogisticRegression", "classification", "r", [(0, f) for f in range(3)])
    assert preds.count() == 120 and preds.where("prob is null").count() == 0
