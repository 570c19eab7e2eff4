"""Ranks, quantiles, folds and metrics against plain computation."""

import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sparkaudit.functions import ordered, quantiles
from sparkaudit.operators import baselines, features, folds, metrics, robustness, signal, trust

few = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
numbers = st.one_of(
    st.none(), st.integers(-5, 5).map(float), st.floats(-1e9, 1e9), st.sampled_from([0.0, 1e-12, 1e12, 1e12 + 1])
)


@few
@given(st.lists(numbers, min_size=1, max_size=80))
def test_quantiles_equal_numpy(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = quantiles.quantile_columns(df, ["x"], [0.0, 0.25, 0.5, 0.9, 1.0]).collect()
    filled = [v for v in values if v is not None]
    if not filled:
        assert got == []
        return
    assert got[0]["q"] == pytest.approx(list(np.quantile(filled, [0.0, 0.25, 0.5, 0.9, 1.0])), rel=1e-9, abs=1e-9)


def test_quantiles_by_group_and_weight(spark):
    rows = [(g, float(x), 1 + x % 3) for g in "ab" for x in range(40)]
    df = spark.createDataFrame(rows, "g string, x double, w bigint")
    got = {r["g"]: r["q"] for r in quantiles.quantile_columns(df, ["x"], [0.3, 0.5], ["g"], "w").collect()}
    flat = [float(x) for x in range(40) for _ in range(1 + x % 3)]
    for g in "ab":
        assert got[g] == pytest.approx(list(np.quantile(flat, [0.3, 0.5])))


@few
@given(st.lists(st.integers(0, 6), min_size=1, max_size=60), st.data())
def test_order_statistics_with_ties(spark, values, data):
    pairs = sorted((float(v), i) for i, v in enumerate(values))
    ranks = sorted({data.draw(st.integers(0, len(pairs) - 1)) for _ in range(3)})
    df = spark.createDataFrame([(v, i) for v, i in pairs], "x double, id bigint")
    assert quantiles.order_statistics(df, "x", "id", ranks) == [pairs[r] for r in ranks]


def test_large_buckets_are_cut_again(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "SORT_LIMIT", 5)
    monkeypatch.setattr(quantiles, "BUCKETS", 4)
    rng = random.Random(1)
    values = [rng.choice([0.0, 1e6, rng.random()]) for _ in range(500)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = quantiles._select_ranks(df, "x", [0, 100, 250, 400, 499])
    assert got == [sorted(values)[r] for r in (0, 100, 250, 400, 499)]


def test_quantiles_with_one_heavy_value_and_nan(spark):
    values = [7.0] * 1990 + [1.0, 2.0, 8.0, 9.0, 10.0]
    df = spark.createDataFrame([(v,) for v in [*values, None, float("nan")]], "x double")
    got = quantiles.quantile_columns(df, ["x"], [0.0, 0.001, 0.5, 0.999, 1.0]).collect()
    assert got[0]["q"] == pytest.approx(list(np.quantile(values, [0.0, 0.001, 0.5, 0.999, 1.0])))


def test_time_blocks_without_time(spark):
    rows = [(i, None if i % 10 < 3 else i) for i in range(100)]
    df = spark.createDataFrame(rows, "id bigint, t bigint").withColumn("ts", F.timestamp_seconds("t"))
    sizes = {r["block"]: r["count"] for r in folds.time_blocks(df, "ts", "id").groupBy("block").count().collect()}
    assert sizes == {None: 30, 0: 15, 1: 11, 2: 11, 3: 11, 4: 11, 5: 11}


def test_running_equals_window_when_one_group_is_hot(spark):
    rng = random.Random(2)
    rows = [("hot" if rng.random() < 0.6 else f"g{i % 7}", i, rng.randrange(100)) for i in range(600)]
    df = spark.createDataFrame(rows, "g string, t bigint, v bigint")
    got = ordered.running(
        df, ["g"], F.floor(F.col("t") / 50), ["t"], {"best": ("max", "v"), "total": ("sum", "v"), "n": ("count", "v")}
    )
    state = {}
    want = {}
    for g, t, v in rows:
        seen = state.setdefault(g, [])
        want[t] = (max(seen) if seen else None, sum(seen), len(seen))
        seen.append(v)
    assert {r["t"]: (r["best"], r["total"], r["n"]) for r in got.collect()} == want


@few
@given(st.integers(2, 10), st.sampled_from([0, 1, 7, 42, 123]), st.integers(1, 120))
def test_stratified_folds_are_balanced(spark, k, seed, n):
    df = spark.range(n).select(F.col("id"), (F.col("id") % 3 == 0).cast("int").alias("y"))
    rows = folds.stratified_kfold(df, "y", "id", k, seed).collect()
    assert sorted(r["id"] for r in rows) == list(range(n))
    for y in (0, 1):
        sizes = [sum(1 for r in rows if r["y"] == y and r["fold"] == f) for f in range(k)]
        assert max(sizes) - min(sizes) <= 1


def test_time_blocks_follow_time(spark):
    df = spark.range(100).select("id", F.timestamp_seconds(F.col("id") - F.col("id") % 10).alias("ts"))
    rows = folds.time_blocks(df, "ts", "id", 5).collect()
    block = {r["id"]: r["block"] for r in rows}
    assert [sum(1 for b in block.values() if b == i) for i in range(6)] == [20, 16, 16, 16, 16, 16]
    assert all(block[i] <= block[i + 1] for i in range(99))


@few
@given(st.lists(st.tuples(st.sampled_from([0.0, 1.0]), st.integers(0, 20)), min_size=2, max_size=60))
def test_auc_is_the_pair_share(spark, rows):
    df = spark.createDataFrame([("r", y, p / 20) for y, p in rows], "run_id string, label double, prob double")
    got = metrics.roc_auc(df, ["run_id"]).first()["roc_auc"]
    pos = [p for y, p in rows if y == 1.0]
    neg = [p for y, p in rows if y == 0.0]
    if not pos or not neg:
        assert got is None
        return
    want = sum((a > b) + (a == b) / 2 for a in pos for b in neg) / (len(pos) * len(neg))
    assert got == pytest.approx(want)
    flipped = metrics.roc_auc(df.withColumn("prob", 1 - F.col("prob")), ["run_id"]).first()["roc_auc"]
    assert flipped == pytest.approx(1 - want)


@few
@given(
    st.lists(st.tuples(st.sampled_from("ab"), st.one_of(st.integers(-50, 50).map(float), st.floats(-1e4, 1e4))), min_size=1, max_size=40),
    st.lists(st.tuples(st.sampled_from("ab"), st.one_of(st.integers(-50, 50).map(float), st.floats(-1e4, 1e4))), max_size=40),
)
def test_tolerance_match_equals_brute_force(spark, cited, actual):
    c = spark.createDataFrame(cited, "run_id string, cited double")
    a = spark.createDataFrame(actual, "run_id string, actual double")
    got = {(r["run_id"], r["cited"]): r["supported"] for r in trust.match_numbers(c, a).collect()}
    want = {
        (g, x + 0.0): any(h == g and abs(x - y) <= 0.02 * abs(y) for h, y in actual) for g, x in cited
    }
    assert got == want


def test_majority_and_median_need_no_training_copy(spark):
    df = spark.range(60).select(
        "id", (F.col("id") % 4 == 0).cast("int").alias("y"), (F.col("id") * F.col("id")).cast("double").alias("v")
    )
    f = folds.seeded_folds(df, "id", "y", 3, (1, 2))
    rows = f.collect()
    got = {(r["seed"], r["fold"]): r for r in baselines.majority_class(f, "y").collect()}
    med = {(r["seed"], r["fold"]): r["pred"] for r in baselines.predict_median(f, "v").select("seed", "fold", "pred").distinct().collect()}
    for (s, k), r in got.items():
        train = [x for x in rows if x["seed"] == s and x["fold"] != k]
        assert r["majority"] == 0
        assert r["share"] == pytest.approx(sum(x["y"] == 0 for x in train) / len(train))
        assert med[(s, k)] == pytest.approx(float(np.median([x["v"] for x in train])))


def test_constant_column_has_no_correlation(spark):
    df = spark.range(10).select(F.col("id").alias("a"), F.lit(2).alias("c"))
    got = {(r["x"], r["y"]): r["r"] for r in signal.correlation_matrix(df, ["a", "c"]).collect()}
    assert got[("a", "a")] == 1.0 and got[("a", "c")] is None and got[("c", "c")] is None


def test_permutation_moves_only_one_column(spark):
    df = spark.range(30).select("id", F.col("id").cast("double").alias("a"), (F.col("id") * 2).cast("double").alias("b"))
    rows = robustness.permuted(df, "id", ["a", "b"], 2, (5,)).collect()
    assert len(rows) == 30 * 2 * 2
    for rep in (0, 1):
        mine = [r for r in rows if r["feature"] == "a" and r["repeat"] == rep]
        assert sorted(r["a"] for r in mine) == [float(i) for i in range(30)]
        assert all(r["b"] == 2.0 * r["id"] for r in mine)
        assert any(r["a"] != r["id"] for r in mine)


def test_category_codes_cut_into_ranges(spark, monkeypatch):
    monkeypatch.setattr(features, "CODE_RANGES", 4)
    names = sorted(f"name-{i:03d}" for i in range(80))
    df = spark.createDataFrame([(n,) for n in names * 2], "s string")
    got = {r["s"]: r["code"] for r in features.category_codes(df, "s").collect()}
    assert got == {n: i for i, n in enumerate(names)}


def test_feature_expressions(spark):
    df = spark.createDataFrame(
        [("Doe, Mr. John", 16.0), ("Roe, Dr. Jane", 17.0), ("Nobody", None)], "name string, age double"
    )
    title = features.extract_token(F.col("name"), r",\s*([^\.]+)\.")
    got = df.select(
        title.alias("t"),
        features.fold_rare(title, ["Mr", "Mrs", "Miss", "Master"]).alias("f"),
        features.cut(F.col("age"), [-1, 16, 32, 48, 64, 200], ["child", "young", "mid", "senior", "old"]).alias("b"),
        features.threshold_label(F.col("age"), 16, "child", "adult").alias("g"),
    ).collect()
    assert [tuple(r) for r in got] == [
        ("Mr", "Mr", "child", "adult"), ("Dr", "Rare", "young", "adult"), (None, "Rare", "unknown", None),
    ]
