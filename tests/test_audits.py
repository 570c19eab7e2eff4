"""Planted violations in files: exactly the planted findings come back."""

import json

from pyspark.sql import functions as F

from sparkaudit.operators import audit_method as am
from sparkaudit.operators import audit_report as ar
from sparkaudit.operators import trust
from sparkaudit.sources import notebooks, notes, sinks, tables

PLAN = """# test
- goal: smoke
- analysis_type: classification
- target_variable: target
- success_metric: AUC-ROC
- constraints: none
"""
SCRIPT = """import pandas as pd
from sklearn.preprocessing import StandardScaler
from sklearn.model_selection import train_test_split, KFold

X = StandardScaler().fit_transform(X)
A, B, a, b = train_test_split(X, y, random_state=42, shuffle=True)
m = RandomForestClassifier(random_state=42)
cv = KFold(n_splits=5, shuffle=True, random_state=42)
s = cross_val_score(m, X, y, cv=cv, scoring='roc_auc')
"""
CLEAN = """plt.rcParams['font.family'] = 'NanumGothic'
cv = StratifiedKFold(5)
X = SimpleImputer().fit(X)
A, B, a, b = train_test_split(X, y)
A = StandardScaler().fit_transform(A)
s = cross_val_score(m, X, y, cv=cv, scoring="neg_root_mean_squared_error")
"""


def notes_of(spark, *rows):
    return spark.createDataFrame(list(rows), "run_id string, text string")


def test_method_audit_of_planted_runs(spark):
    plans = notes.plan_info(notes_of(spark, ("bad", PLAN), ("good", PLAN.replace("AUC-ROC", "RMSE").replace("target\n", "other\n"))))
    cycles = notes.cycle_info(
        notes_of(spark, ("bad", "---\nbest_score: 0.9\n---\nbest_features: ['leak', 'f1']\n" + "hypothesis_id: H1\n" * 6 + "fold_excluded: 1\n"),
                 ("good", "best_features: f1 f2\nhypothesis_id: H1\n"))
    )
    excluded = notes.excluded_features(notes_of(spark, ("bad", "excluded_features: ['leak', \"x\"]\n"), ("good", "none")))
    flags = notes.script_flags(notes_of(spark, ("bad", SCRIPT), ("good", CLEAN)))
    rows = [(i % 10 == 0, float(i), float(i % 10 == 0), None if i % 3 else 1.0) for i in range(200)]
    table = spark.createDataFrame(rows, "target boolean, f1 double, leak double, gap double").withColumn("target", F.col("target").cast("int"))
    facts = [am.leak_facts(table, ["f1", "leak"], "target"), am.class_facts(table, "target"), am.null_facts(table)]
    found = am.audit(plans, cycles, excluded, flags, facts, "target", "target", "table")
    ids = {}
    for r in found.collect():
        ids.setdefault(r["run_id"], []).append(r["check_id"])
    assert sorted(ids["bad"]) == ["M1", "M11", "M12", "M3", "M4", "M5", "M6", "M7", "M9"]
    assert "good" not in ids
    verdicts = {r["run_id"]: r["verdict"] for r in trust.audit_verdict(plans, found).collect()}
    assert verdicts == {"bad": "FAIL", "good": "PASS"}
    line = sinks.finding_lines(found.where("check_id = 'M6'")).first()["line"]
    assert line.startswith("FINDING|M6|warn|") and line.count("|") == 5


def test_metric_direction_synonyms(spark):
    profile = spark.createDataFrame(
        [("a", "RMSE", "neg_root_mean_squared_error"), ("b", "AUC-ROC", "neg_mean_absolute_error"), ("c", "mae", "roc_auc")],
        "run_id string, success_metric string, metric_score_used string",
    )
    ids = lambda strict: sorted(r["run_id"] for r in am.apply_rules(profile, am.m8(strict)).collect())
    assert ids(False) == ["b", "c"]
    assert ids(True) == ["a", "b", "c"]


def test_split_line_ignores_comments_and_imports(spark):
    text = "from m import train_test_split\n# train_test_split(x)\nX = s.fit_transform(X)\nA = train_test_split(X)\n"
    same = "A, B = train_test_split(s.fit_transform(X))\n"
    rows = notes.script_flags(notes_of(spark, ("a", text), ("b", same), ("c", "x = 1"))).collect()
    got = {r["run_id"]: (r["fit_line"], r["split_line"], r["fit_before_split"]) for r in rows}
    assert got == {"a": (3, 4, True), "b": (1, 1, False), "c": (None, None, False)}


def test_front_matter_last_key_wins(spark):
    df = notes_of(spark, ("a", "---\nk: 1\n  nested: x\nv: a: b\nk: 2\n---\nk: 3\n"), ("b", "no block"))
    got = {r["run_id"]: r["m"] for r in df.select("run_id", notes.front_matter(F.col("text")).alias("m")).collect()}
    assert got == {"a": {"k": "2", "v": "a: b"}, "b": {}}


def write_notebook(folder, name, cells):
    (folder / name).write_text(json.dumps({"cells": cells, "metadata": {}, "nbformat": 4}), encoding="utf-8")


def md(*lines):
    return {"cell_type": "markdown", "source": list(lines), "metadata": {}}


def code(source, *outputs):
    return {"cell_type": "code", "source": source, "outputs": list(outputs), "metadata": {}, "execution_count": 1}


def test_report_audit_of_notebook_files(spark, tmp_path):
    stream = {"output_type": "stream", "text": ["AUC-ROC: 0.8523\n"]}
    plain = {"output_type": "execute_result", "data": {"text/plain": "10.77 and 0.00.123"}}
    write_notebook(tmp_path, "bad.ipynb", [
        md("## 데이터 개요\n", "## EDA Pass 1\n", "titanic and iris"),
        code(["print(1)"], stream),
        code("y", plain),
        code("z", {"output_type": "stream", "text": "  \n"}),
        code("w"),
        md("## 결론\n", "AUC-ROC 가 0.85 로 향상됨 but lower than before. " + "x" * 100),
        md("AUC-ROC 0.8523, score 0.77 and tail 0.123 ![p](img/a.png) ![q](img/b.svg)"),
        md("검증 결과 점수는 약 0.999 였음"),
    ])
    write_notebook(tmp_path, "good.ipynb", [
        md("Data Overview, EDA, Modeling, Validation, Conclusion"), code("x", stream), md("AUC 0.852"),
    ])
    cells = notebooks.read_notebooks(spark, str(tmp_path)).withColumn(
        "notebook", F.regexp_extract("notebook", r"([a-z]+)\.ipynb", 1)
    )
    files = spark.createDataFrame([("img/b.svg",)], "path string")
    found = ar.audit(cells, files).collect()
    got = sorted((r["notebook"], r["check_id"], r["location"]) for r in found)
    where = {(c, l) for _, c, l in got}
    assert {n for n, _, _ in got} == {"bad"}
    assert ("N1", "cell[7] (markdown)") in where and ("N5", "cell[7] (markdown)") in where
    assert ("N3", "cell[5] (markdown)") in where and ("N6", "cell[3] (code)") in where
    assert ("N8", "cell[6] (markdown)") in where
    assert [r["evidence"] for r in found if r["check_id"] == "N7"] == ["titanic=1,iris=1"]
    assert [r["evidence"] for r in found if r["check_id"] == "N4"] == ["missing=모델"]
    assert [r["evidence"] for r in found if r["check_id"] == "N2"] == ["values=0.85,0.8523"]
    assert not [r for r in found if r["check_id"] == "N1" and r["location"] == "cell[6] (markdown)"]


def test_delimited_files_and_report(spark, tmp_path):
    sub = tmp_path / "deep"
    sub.mkdir()
    (tmp_path / "a.csv").write_text("id,x\n1,2.5\n2,\n")
    (sub / "b.csv").write_text("id,x\n3,1.0\n")
    (tmp_path / "skip.txt").write_text("id,x\n9,9\n")
    df = tables.read_delimited(spark, str(tmp_path), "id bigint, x double")
    assert sorted(r["id"] for r in df.collect()) == [1, 2, 3]
    rep = {r["file_path"].rsplit("/", 1)[1]: (r["n_rows"], r["n_columns"], r["null_x"]) for r in tables.file_report(df, df.columns).collect()}
    assert rep == {"a.csv": (2, 2, 1), "b.csv": (1, 2, 0)}


def test_text_files_and_latest(spark, tmp_path):
    (tmp_path / "one.md").write_text("line 1\nline 2\n")
    texts = notes.read_texts(spark, str(tmp_path), "*.md").collect()
    assert [r["text"] for r in texts] == ["line 1\nline 2\n"]
    listed = notebooks.list_files(spark, str(tmp_path), "*.md").collect()
    assert listed[0]["path"].endswith("one.md")


def test_patterns_run_only_where_their_fixed_part_is(spark):
    texts = {
        "odd": "\t- goal: a: b \n-goal: no\ngoal:\n  success_metric:\tR2\t\n- constraints:  none \nTIME Series, Class  Imbalance",
        "near": "my goal: x\ntimer, class\nseries", "last": "goal: 1\ngoal: 2\n시계열 불균형", "empty": "", "null": None,
    }
    df = spark.createDataFrame(list(texts.items()), "run_id string, text string")
    got = {r.run_id: r for r in notes.plan_info(df).collect()}
    assert [(r, got[r].goal, got[r].success_metric, got[r].constraints, got[r].is_time_series, got[r].is_imbalanced_hint) for r in texts] == [
        ("odd", "", "R2", ["none "], True, True), ("near", None, None, [], False, False), ("last", "2", None, [], True, True),
        ("empty", None, None, [], False, False), ("null", None, None, None, None, None),
    ]
    script = "# fit_transform(a)\ndef train_test_split(x):\nb = fit_transform (x)\nc = train_test_split(b)\n'/tmp/x'\n~/y\nMyKFold"
    found = spark.createDataFrame([("s", script), ("n", None)], "run_id string, text string")
    got = {r.run_id: r for r in notes.script_flags(found).collect()}
    s, n = got["s"], got["n"]
    assert (s.fit_line, s.split_line, s.fit_before_split, s.abs_path_count, s.uses_kfold, s.has_impute) == (3, 4, True, 2, False, False)
    assert (n.fit_line, n.random_state_count, n.uses_kfold, n.has_impute, n.uses_shuffle_true) == (None, None, None, None, None)


def test_notes_of_a_small_file_are_read_by_many_tasks(spark, tmp_path):
    from sparkaudit.plans import reviewing, views

    spark.createDataFrame([(i, "1-URGENT") for i in range(50)], "o_orderkey bigint, o_orderpriority string").coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(i,) for i in range(50)], "c_custkey bigint").coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        texts = views.run_texts(spark, str(tmp_path), views.PLAN_TEXT)
        plans, cycles = reviewing.notes_of(spark, str(tmp_path))
        assert all(df.rdd.getNumPartitions() > 1 and df.count() == 50 for df in (texts, plans, cycles))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
