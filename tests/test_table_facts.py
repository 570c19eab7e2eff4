"""Facts of several tables at once, and figures at the edge of a limit."""

import pytest
from pyspark.sql import functions as F

from sparkaudit.operators import audit_method as am
from sparkaudit.operators import trust


@pytest.fixture(scope="module")
def tables(spark):
    cars = [(float(i), 2.0 * i + (i % 2) * 0.01, f"{3 * i}", i % 2, None if i % 4 == 0 else 1.0) for i in range(60)]
    homes = [(("n", "y")[i > 51], 1.0 * (i > 51), float("nan") if i < 2 else float(i % 7)) for i in range(60)]
    return {
        "cars": spark.createDataFrame(cars, "price double, twice double, thrice string, coin int, gaps double"),
        "homes": spark.createDataFrame(homes, "sold string, hint double, size double"),
    }


@pytest.fixture(scope="module")
def plans(spark):
    rows = [
        (1, "cars", "price", "regression"), (2, "cars", "coin", "classification"), (3, "homes", "sold", "classification"),
        (4, "homes", "price", "regression"), (5, "nowhere", "price", "regression"), (6, None, None, None), (7, "homes", "sold", "regression"),
    ]
    return spark.createDataFrame(rows, "run_id int, dataset string, target_variable string, analysis_type string")


def test_only_targets_of_the_own_table_are_asked(tables, plans):
    assert am.tables_asked(plans, tables) == [("cars", "coin", True), ("cars", "price", False), ("homes", "sold", True)]


def test_leaks_classes_and_gaps(tables, plans):
    asked = am.tables_asked(plans, tables)
    leaks = {(r.dataset, r.target_variable): sorted(x.feature for x in r.leaks) for r in am.table_leaks(tables, asked).collect()}
    assert leaks == {("cars", "price"): ["thrice", "twice"], ("homes", "sold"): ["hint"]}
    classes = {(r.dataset, r.target_variable): (r.min_share, r.n_classes) for r in am.table_classes(tables, asked).collect()}
    assert classes == {("cars", "coin"): (0.5, 2), ("homes", "sold"): (8 / 60, 2)}
    assert {r.dataset: r.null_columns for r in am.table_nulls(tables).collect()} == {"cars": ["gaps"]}


def test_findings_follow_the_own_table(spark, tables, plans):
    notes = spark.createDataFrame(
        [(i, ["twice", "hint", "price"]) for i in range(1, 8)], "run_id int, best_features_list array<string>"
    )
    flags = spark.createDataFrame([(i, i == 2) for i in range(1, 8)], "run_id int, has_impute boolean").withColumn(
        "uses_stratified_kfold", F.lit(False))
    profile = am.with_table_facts(am.run_profile(plans, notes, flags), tables, plans)
    found = {(r.run_id, r.check_id, r.location, r.evidence) for r in am.apply_rules(profile, am.m1(), am.m4(), am.m7()).collect()}
    assert {f for f in found if f[1] == "M1"} == {
        (1, "M1", "cars", "corr(twice,price)=1.0"), (3, "M1", "homes", "corr(hint,sold)=1.0"), (7, "M1", "homes", "corr(hint,sold)=1.0")}
    assert {f[0] for f in found if f[1] == "M4"} == {3}
    assert {f[0] for f in found if f[1] == "M7"} == {1}


def test_no_table_at_all(spark, plans):
    profile = am.with_table_facts(plans, {"empty": spark.createDataFrame([], "x double")}, plans)
    assert profile.count() == 7 and profile.where("leaks is not null or null_columns is not null").count() == 0


def test_hypotheses_are_counted_once_each(spark):
    ids = ["H2"] * 7 + ["H1"] * 5 + ["H3", "H2"] + ["H9"] * 6
    rows = spark.createDataFrame([(1, ids), (2, []), (3, None), (4, ["H1"] * 9000)], "run_id int, hypothesis_ids array<string>")
    got = {(r.run_id, r.evidence) for r in am.apply_rules(rows, am.m5()).collect()}
    assert got == {(1, "counts[H2]=8"), (1, "counts[H9]=6"), (4, "counts[H1]=9000")}


def test_scores_at_the_edge_of_a_limit(spark):
    near = 0.01 + 1e-16 * 3
    rows = [(0.81, 0.81 - near, 0.02 - 1e-16), (0.8 + 0.01, 0.8, 0.1 + 0.02 - 0.1), (0.82, 0.8, 0.5)]
    df = spark.createDataFrame(rows, "best double, mean double, spread double")
    calm = [F.lit(95), F.lit("CONSISTENT"), F.lit("PASS"), F.lit("PASS")]
    flags = [r[0] for r in df.select(trust.qa_flags(F.col("best"), F.col("mean"), F.col("spread"), *calm)).collect()]
    assert flags == [[], [], ["score not reproduced"]]
    seeds = spark.createDataFrame([(1, s, x) for s, x in enumerate((0.80, 0.81, 0.82))], "run_id int, seed int, score double")
    assert trust.cv_stability(seeds).first().cv_stability == "OK"  # exactly 0.01


def test_notes_are_read_once_for_the_targets_asked(spark, tables):
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def target(run):
        read.add(1)
        return ["price", "coin", None][run % 3]

    plans = spark.range(30).select(
        F.col("id").alias("run_id"), F.lit("cars").alias("dataset"), target("id").alias("target_variable"), F.lit("classification").alias("analysis_type")
    )
    assert am.tables_asked(plans, tables) == [("cars", "coin", True), ("cars", "price", True)]
    assert read.value == 30
