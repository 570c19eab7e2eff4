"""Rows that used to vanish, crash or bend a figure."""

import pytest
from pyspark.sql import functions as F

from sparkaudit.operators import audit_method, audit_report, baselines, iteration, metrics, models, registry, robustness
from sparkaudit.sources import notebooks, tables


def test_nan_is_read_as_missing(spark):
    df = tables.nan_to_null(spark.createDataFrame([(1.0, "a"), (float("nan"), "NaN"), (None, None)], "x double, s string"))
    assert [r["x"] for r in df.collect()] == [1.0, None, None] and df.where("s = 'NaN'").count() == 1


def test_notebook_without_cells_lacks_every_section(spark):
    books = spark.createDataFrame([("empty", None)], f"notebook string, {notebooks.NOTEBOOK_SCHEMA}")
    cells = notebooks.cells_of(books)
    assert cells.count() == 1
    assert {r["notebook"] for r in audit_report.missing_sections(cells).collect()} == {"empty"}


def test_run_never_repeated_is_missing(spark):
    recorded = spark.createDataFrame([(1, 0.8), (2, 0.7)], "run_id int, best_score double")
    again = spark.createDataFrame([(1, 0.8)], "run_id int, score double")
    got = {r["run_id"]: r["status"] for r in iteration.rerun_check(recorded, again, "run_id").collect()}
    assert got == {1: "OK", 2: "MISSING"}


def test_run_without_interval_fails_that_gate(spark):
    summary = spark.createDataFrame([("a", 0.01), ("b", 0.01)], "run_id string, std double")
    ci = spark.createDataFrame([("a", 0.6)], "run_id string, ci_low double")
    base = spark.createDataFrame([("a", 0.5)], "run_id string, baseline_mean double")
    drops = spark.createDataFrame([], "run_id string, drop_pct double")
    got = {r["run_id"]: r["verdict"] for r in robustness.gates(summary, ci, base, drops).collect()}
    assert got == {"a": "PASS", "b": "WARN"}


def test_missing_target_is_no_class(spark):
    rows = [(float(i % 4), float(i % 4)) for i in range(40)] + [(0.0, None)] * 5
    df = spark.createDataFrame(rows, "x double, y double")
    coded = audit_method.numeric_target(df, "y")
    assert {r["__y"] for r in coded.select("__y").distinct().collect()} == {-1, 0, 1, 2, 3}


def test_latest_decision_counts_once(spark):
    goals = spark.createDataFrame([("g",)], "goal string")
    fields = "goal string, decision string, decided_at string, qa_verdict string, llm_verdict string, code_verdict string"
    decisions = spark.createDataFrame([("g", "HOLD", "2024-01-01", "WARN", None, None), ("g", "SHIP", "2024-02-01", "PASS", None, None)], fields)
    qa = spark.createDataFrame([], "goal string, qa_verdict string, llm_verdict string, code_verdict string")
    got = registry.with_verdicts(goals, decisions, qa).collect()
    assert [(r["decision"], r["qa_verdict"]) for r in got] == [("SHIP", "PASS")]


def test_auc_of_scores_in_a_narrow_range(spark):
    rows = [(float(i % 2), 1e-9 * i) for i in range(400)] + [(1.0, None)]
    df = spark.createDataFrame(rows, "label double, prob double").withColumn("g", F.lit(1))
    pos, neg = [p for y, p in rows[:400] if y], [p for y, p in rows[:400] if not y]
    want = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / len(pos) / len(neg)
    assert metrics.roc_auc(df, ["g"]).first()["roc_auc"] == pytest.approx(want)


def test_too_many_classes_are_refused(spark):
    folds = spark.range(3000).selectExpr("0 AS run_id", "'m' AS model", "1 AS seed", "cast(id % 2 as int) AS fold", "id AS label")
    with pytest.raises(Exception, match="classes"):
        baselines.class_priors(folds, "label", ("seed", "fold")).collect()


def test_text_target(spark):
    rows = [(42, i // 10 % 2, i, float(i % 10), "yes" if i % 10 > 4 else "no") for i in range(80)]
    folds = spark.createDataFrame(rows, "seed int, fold int, id bigint, x double, y string")
    out = models.out_of_fold(folds, "id", ["x"], [], "y", "LogisticRegression", "classification", "r", [(42, 0), (42, 1)])
    got = out.collect()
    assert len(got) == 80 and {r["label"] for r in got} == {0.0, 1.0}
    assert sum(r["pred"] == r["label"] for r in got) >= 72
