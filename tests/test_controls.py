"""A real signal must pass, noise must not, and the rules follow their tables."""

import itertools

import pytest
from pyspark.sql import functions as F

from sparkaudit.functions.hashing import uniform
from sparkaudit.operators import (
    baselines, folds, linear, metrics, models, registry, robustness, significance, trust,
)


def scored(spark, signal: bool):
    """Five seeds x five folds of a score that follows the label, or does not."""
    u = lambda tag: uniform(F.lit(tag), F.col("id"))
    df = spark.range(600).select("id", (u("y") < 0.4).cast("int").alias("y"), u("x").alias("noise"))
    x = (F.col("y") * 0.6 + F.col("noise") * 0.7) if signal else F.col("noise")
    f = folds.seeded_folds(df.withColumn("x", x), "id", "y")
    best = baselines.as_preds(f.withColumn("pred", (F.col("x") > 0.6).cast("double")).withColumn("prob", F.col("x")), "r", "best", "id", "y")
    naive = baselines.as_preds(baselines.predict_stratified(f, "y", "id"), "r", "stratified", "id", "y")
    major = baselines.as_preds(baselines.predict_majority(f, "y"), "r", "majority", "id", "y")
    return best, naive.unionByName(major)


@pytest.mark.parametrize("signal", [True, False])
def test_controls(spark, signal):
    best, naive = scored(spark, signal)
    s = metrics.scores(best, ["roc_auc"])
    b = metrics.scores(naive, ["roc_auc"])
    tests = significance.compare(significance.differences(s, b), replicates=300, n_perm=200)
    verdict = significance.verdict(significance.gates(tests)).first()["verdict"]
    assert (verdict == "PASS") is signal


def test_constant_differences(spark):
    rows = [("r", 1, k, 0.9, 0.5) for k in range(5)]
    d = spark.createDataFrame(rows, "run_id string, seed int, fold int, best double, base double")
    d = d.withColumn("baseline", F.lit("b")).withColumn("d", F.col("best") - F.col("base"))
    r = significance.compare(d, replicates=50, n_perm=50).first()
    assert r["test"] == "paired_t" and r["cohen_d"] == 0.0 and r["p_value"] == 0.0
    assert r["ci_low"] == pytest.approx(0.4) and r["ci_high"] == pytest.approx(0.4)


def test_bootstrap_interval_holds_the_mean(spark):
    df = spark.range(25).select(
        F.lit("r").alias("run_id"), F.floor(F.col("id") / 5).alias("seed"), (F.col("id") % 5).alias("fold"),
        uniform(F.col("id")).alias("score"),
    )
    ci = significance.bootstrap_ci(df, ["run_id"], "score", 400).first()
    mean = df.agg(F.avg("score")).first()[0]
    assert ci["ci_low"] < mean < ci["ci_high"]


def test_ridge_matches_spark_ml(spark):
    df = spark.range(200).select(
        "id", uniform(F.lit("a"), F.col("id")).alias("a"), (1e3 + uniform(F.lit("b"), F.col("id"))).alias("b")
    ).withColumn("y", 3 * F.col("a") - 2 * F.col("b") + uniform(F.lit("e"), F.col("id")))
    f = folds.kfold(df, "id", 4).withColumn("seed", F.lit(0))
    ours = {r["fold"]: r["rmse"] for r in linear.ridge_cv(f, ["a", "b"], "y", leave_out=False).collect()}
    stage = models.VectorAssembler(inputCols=["a", "b"], outputCol="features")
    rows = stage.transform(f.withColumn("b", F.col("b") - 1e3))
    for k in range(4):
        train = rows.where(F.col("fold") != k)
        std = train.agg(F.stddev_pop("y")).first()[0]
        fitted = models.get_estimator("Ridge", "regression", label="y", n_rows=150, label_std=std).fit(train)
        assert fitted.evaluate(rows.where(F.col("fold") == k)).rootMeanSquaredError == pytest.approx(ours[k], rel=1e-4)


def test_model_dispatch():
    kind = lambda n, t: type(models.get_estimator(n, t)).__name__
    assert kind("LogisticRegression", "classification") == "LogisticRegression"
    assert kind("XGBoost", "classification") == "GBTClassifier"
    assert kind("RandomForest", "classification") == "RandomForestClassifier"
    assert kind(None, "classification") == "RandomForestClassifier"
    assert kind("Ridge", "regression") == "LinearRegression"
    assert kind("LightGBM", "regression") == "GBTRegressor"
    assert kind("unknown", "regression") == "RandomForestRegressor"


def test_robustness_gates(spark):
    summary = spark.createDataFrame([("a", 0.01), ("b", 0.05), ("c", 0.05)], "run_id string, std double")
    ci = spark.createDataFrame([("a", 0.8), ("b", 0.8), ("c", 0.5)], "run_id string, ci_low double")
    base = spark.createDataFrame([(r, 0.6) for r in "abc"], "run_id string, baseline_mean double")
    drops = spark.createDataFrame([("a", 20.0), ("b", 30.0), ("c", 26.0)], "run_id string, drop_pct double")
    got = {r["run_id"]: (r["n_pass"], r["verdict"]) for r in robustness.gates(summary, ci, base, drops).collect()}
    assert got == {"a": (3, "PASS"), "b": (1, "WARN"), "c": (0, "FAIL")}


def test_verdict_tables(spark):
    levels = ["PASS", "WARN", "FAIL"]
    rows = [(a, b, f, p) for a in levels for b in levels for f in (0, 1) for p in (0, 2)]
    df = spark.createDataFrame(rows, "s string, c string, n_fail int, n_partial int")
    for r in df.withColumn("v", trust.qa_verdict(F.lit(0), F.col("n_fail"), F.col("n_partial"), F.col("s"), F.col("c"))).collect():
        fail = r["n_fail"] or "FAIL" in (r["s"], r["c"])
        warn = r["n_partial"] >= 2 or ((r["s"] == "WARN") != (r["c"] == "WARN"))
        assert r["v"] == ("FAIL" if fail else "WARN" if warn else "PASS")


def test_layers(spark):
    cases = list(itertools.product(["PASS", "WARN", "FAIL"], repeat=4))
    rows = [(i, layer + 1, verdict) for i, case in enumerate(cases) for layer, verdict in enumerate(case)]
    df = spark.createDataFrame(rows, "run_id int, layer int, verdict string")
    for r in trust.layered(df).collect():
        case = cases[r["run_id"]]
        want, stop = [], False
        for i, verdict in enumerate(case):
            want.append("NOT_RUN" if stop else "WARN" if i == 3 and verdict == "FAIL" else verdict)
            stop = stop or (i < 3 and verdict == "FAIL")
        assert [r["r1"], r["r2"], r["r3"], r["r4"]] == want
        assert r["overall"] == ("FAIL" if "FAIL" in want else "WARN" if "WARN" in want else "PASS")


def test_registry_upsert_twice_is_once(spark):
    known = spark.createDataFrame([("g0", "20240101", {"md": "x"})], "goal string, date string, reports map<string,string>")
    new = spark.createDataFrame(
        [("g0", "20240202", {"md": "y"}), ("g1", "20240202", {"md": "y"}), ("g1", "20240101", {"md": "z"}), ("g2", "20240101", {})],
        known.schema,
    )
    once = registry.upsert(known, new)
    twice = registry.upsert(once, new)
    rows = lambda df: sorted((r["goal"], r["date"], r["reports"]["md"]) for r in df.collect())
    assert rows(once) == rows(twice) == [("g0", "20240101", "x"), ("g1", "20240101", "z")]


def test_plan_names(spark):
    df = spark.createDataFrame([("20240102-my-goal.md",), ("plain.md",), ("2024-x.md",)], "name string")
    date, goal = registry.plan_identity(F.col("name"))
    assert [tuple(r) for r in df.select(date, goal).collect()] == [
        ("20240102", "my-goal"), ("00000000", "plain"), ("00000000", "2024-x")]


def test_number_tokens(spark):
    df = spark.createDataFrame([("r", "On 2024-01-02 12:30 score 0.85 (16.7%) in 40ms, -3 of 1200명")], "run_id string, text string")
    assert [r["cited"] for r in trust.number_tokens(df, "run_id", "text").orderBy("pos").collect()] == [0.85, 16.7, 40.0, -3.0, 1200.0]


def test_synthetic_tables_hold_the_planted_truth(spark):
    from sparkaudit.operators import audit_method
    from sparkaudit.sources import synthetic

    for df in (synthetic.classification(spark, 800), synthetic.regression(spark, 800)):
        leaks = audit_method.leak_facts(df, ["feat1", "feat2", "leak_col"], "target").first()["leaks"]
        assert "leak_col" in [x["feature"] for x in leaks] and "feat2" not in [x["feature"] for x in leaks]
