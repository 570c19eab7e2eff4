"""Reviews from plan to verdict on planted tables."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkaudit.operators import linear, review


def _table(n=240, seed=2):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        signal, noise = rng.gauss(0, 1), rng.gauss(0, 1)
        out.append((
            i, signal, noise, rng.choice("abc"), 2 * signal + rng.gauss(0, 0.3), rng.gauss(0, 1),
            "yes" if signal + rng.gauss(0, 0.3) > 0 else "no", None if i % 5 == 0 else 3 * signal + rng.gauss(0, 0.1),
        ))
    return out


COLUMNS = ["signal", "noise", "level", "y", "nothing", "label", "gappy"]
SCHEMA = "id bigint, signal double, noise double, level string, y double, nothing double, label string, gappy double"


def _plan(run, task="regression", target="y", metric="RMSE", dataset="t", note=""):
    return run, dataset, f"- goal: g{run}\n- analysis_type: {task}\n- target_variable: {target}\n- success_metric: {metric}\n{note}\n"


@pytest.fixture(scope="module")
def data(spark):
    rows = _table()
    return rows, {"t": review.Dataset(spark.createDataFrame(rows, SCHEMA).repartition(3), "id", COLUMNS)}


@pytest.fixture(scope="module")
def ridge(spark, data):
    plans = [
        _plan(1), _plan(2), _plan(3, target="nothing", metric="MAE"), _plan(4, task="clustering"), _plan(5, target="gone"),
        _plan(6, dataset="elsewhere"), _plan(7, note="a time series"), _plan(8, target="gappy", metric="R2"), _plan(9, metric="AUC"), _plan(10),
    ]
    features = {1: "['signal', 'noise']", 2: "['signal', 'gone', 'noise']", 3: "['noise']", 8: "['signal']", 10: "all of them"}
    cycles = [(r, f"best_features: {features.get(r, '[]')}\nbest_model: Ridge\n") for r in range(1, 11)]
    return review.review(
        spark.createDataFrame(plans, "run_id int, dataset string, text string"), spark.createDataFrame(cycles, "run_id int, text string"),
        data[1], replicates=200, n_perm=400,
    )


def test_every_run_gets_both_verdicts(ridge):
    got = {r.run_id: r for r in ridge.verdicts.collect()}
    assert sorted(got) == list(range(1, 11))
    assert got[1].statistical_verdict == "PASS" and got[1].g1 and got[1].g4
    assert got[3].statistical_verdict == "FAIL"
    assert (got[4].statistical_verdict, got[4].robustness_verdict, got[4].status) == ("N/A", "N/A", "unsupported")
    assert got[5].status == got[6].status == "no_data" and got[5].statistical_verdict == got[6].robustness_verdict == "FAIL"
    assert got[7].splitter == "time" and got[7].statistical_verdict in ("PASS", "WARN")
    assert got[8].statistical_verdict == "PASS"
    assert got[9].scorer == "roc_auc" and got[9].statistical_verdict == "FAIL"  # no such score of a regression
    assert got[10].family == "ridge" and len(got[10].features) == 6  # nothing named: all columns but the target


def test_equal_requests_share_a_unit(ridge):
    asked = {r.run_id: r for r in ridge.requests.collect()}
    assert asked[1].features == asked[2].features == ["signal", "noise"]
    assert asked[1].unit == asked[2].unit and asked[1].review == asked[2].review
    assert asked[7].features == ["signal", "noise", "level", "nothing", "label", "gappy"]  # none named: all but the target
    fits = ridge.scores.groupBy("fit", "splitter", "seed", "fold", "scorer").count()
    assert fits.where("count > 1").count() == 0


def test_ridge_scores_equal_numpy(spark, data, ridge):
    rows, datasets = data
    folds = review.folds_of(datasets["t"], "kfold", None, 5, (42,)).select("id", "fold").collect()
    fold = {r.id: r.fold for r in folds}
    x = np.array([r[1:3] for r in rows])
    y, f = np.array([r[4] for r in rows]), np.array([fold[r[0]] for r in rows])
    asked = {r.run_id: r for r in ridge.requests.collect()}
    own = review.feature_sets(ridge.requests.where("run_id = 1").select("unit", "dataset", "task", "target", "family", "splitter", "features"))
    fit = own.where("left_out is null").first().fit
    got = {r.fold: r.score for r in ridge.scores.where((F.col("fit") == fit) & (F.col("seed") == 42) & (F.col("scorer") == asked[1].scorer)).collect()}
    for k in range(5):
        train, test = f != k, f == k
        m, b = x[train].mean(0), y[train].mean()
        beta = np.linalg.solve((x[train] - m).T @ (x[train] - m) + np.eye(2), (x[train] - m).T @ (y[train] - b))
        error = y[test] - b - (x[test] - m) @ beta
        assert got[k] == pytest.approx(-np.sqrt((error**2).mean()), rel=1e-9)


def test_left_out_features(ridge):
    drops = {(r.run_id, r.feature): r for r in ridge.drops.collect()}
    asked = {r.run_id: r.review for r in ridge.requests.collect()}
    assert drops[asked[1], "signal"].drop_class == "CRITICAL" and drops[asked[1], "noise"].drop_class == ""
    assert not [k for k in drops if k[0] == asked[3]]  # one feature is not left out


def test_blocks_train_on_what_came_before(spark, data):
    folds = review.folds_of(data[1]["t"], "time", None, 5, (0, 42))
    edges = {r.fold: (r.lo, r.hi, r.n) for r in folds.where("seed = 42").groupBy("fold").agg(
        F.min("id").alias("lo"), F.max("id").alias("hi"), F.count("*").alias("n")).collect()}
    assert [edges[i][2] for i in range(6)] == [40] * 6
    assert all(edges[i][1] < edges[i + 1][0] for i in range(5))


def test_other_models(spark, data):
    plans = [_plan(1, "classification", "label", "Accuracy"), _plan(2, "classification", "label", "AUC-ROC"), _plan(3, metric="R2")]
    cycles = [(1, "best_features: ['signal']\nbest_model: Logistic\n"), (2, "best_features: ['signal']\nbest_model: Logistic\n"),
              (3, "best_features: ['signal']\nbest_model: RandomForest\n")]
    found = review.review(
        spark.createDataFrame(plans, "run_id int, dataset string, text string"), spark.createDataFrame(cycles, "run_id int, text string"),
        data[1], k=3, seeds=(42,), replicates=100, n_perm=100, trees=4, depth=3,
    )
    got = {r.run_id: r for r in found.verdicts.collect()}
    assert [got[i].family for i in (1, 2, 3)] == ["logistic", "logistic", "forest"]
    assert got[1].splitter == "stratified" and got[2].scorer == "roc_auc"
    assert all(got[i].g2 and got[i].g3 and got[i].statistical_verdict in ("PASS", "WARN") for i in (1, 2, 3))
    tests = found.tests.groupBy("run_id").count().collect()
    assert {r["count"] for r in tests} == {2}


def test_no_supported_run(spark, data):
    found = review.review(
        spark.createDataFrame([_plan(1, task="clustering")], "run_id int, dataset string, text string"),
        spark.createDataFrame([], "run_id int, text string"), data[1],
    )
    assert [r.statistical_verdict for r in found.verdicts.collect()] == ["N/A"]
    with pytest.raises(ValueError):
        review.review(found.requests, found.requests, data[1], seeds=(1, 2))


def test_linear_scores_in_several_passes(spark):
    folds = spark.createDataFrame([(42, i % 2, float(i), 2.0 * i + 1) for i in range(20)], "seed int, fold int, x double, y double")
    models = spark.createDataFrame(
        [(42, f, f"m{j}", "y", ["x"], float(j), [2.0]) for f in (0, 1) for j in range(9)],
        "seed int, fold int, fit string, target string, features array<string>, intercept double, coefs array<double>",
    )
    got = linear.linear_scores(folds, models, ["x", "y"], ("seed", "fold"), per_pass=4).collect()
    assert len(got) == 18
    assert all(r.neg_mean_absolute_error == pytest.approx(-abs(1 - int(r.fit[1:]))) for r in got)
