"""Queries: significance against baselines, robustness."""

from __future__ import annotations

import math
from statistics import NormalDist

import numpy as np
from pyspark.sql import functions as F

from ..functions import tails
from ..operators import linear, metrics, rates, robustness, significance
from ..session import cut_lineage
from ..sources.tables import read_table
from . import scoring
from . import views as v
from .catalog import query

# ---- views of the score table --------------------------------------------------

ONE_SEED = f"""SELECT b.run_id, b.seed, b.fold, n.model AS baseline, b.score AS best, n.score AS base, b.score - n.score AS d
    FROM ({scoring.SCORES_SQL}) b JOIN ({scoring.SCORES_SQL}) n USING (run_id, seed, fold)
    WHERE b.model = 'rule' AND n.model <> 'rule'"""


def diffs(spark, sf, seed: int | None = None):
    s = cut_lineage(scoring.score_table(spark, sf))  # one row per model and fold
    if seed is not None:
        s = s.where(F.col("seed") == seed)
    return significance.differences(s.where("model = 'rule'"), s.where("model <> 'rule'"))


@query(
    "k1_fold_differences",
    f"SELECT run_id, baseline, seed, fold, round(d, 6) AS d FROM ({ONE_SEED})",
    views="v_folds",
)
def k1(spark, sf):
    return diffs(spark, sf).select("run_id", "baseline", "seed", "fold", F.round("d", 6).alias("d"))


@query(
    "k2_enough_pairs",
    f"""SELECT run_id, baseline, fold, CASE WHEN count(*) < 3 THEN 'insufficient' ELSE 'ok' END AS pairs
        FROM ({ONE_SEED}) WHERE seed <= fold * 40 GROUP BY ALL""",
    views="v_folds",
)
def k2(spark, sf):
    d = diffs(spark, sf).where(F.col("seed") <= F.col("fold") * 40)
    s = significance.summary(d, ["run_id", "baseline", "fold"])
    return s.select(
        "run_id", "baseline", "fold",
        F.when(significance.choose_test(F.col("n"), F.lit(1.0)) == "insufficient", "insufficient").otherwise("ok").alias("pairs"),
    )


@query(
    "k3_normality",
    f"""SELECT run_id, baseline, count(*) AS n,
               round(count(*) / 6.0 * (power(m3 / power(m2, 1.5), 2) + power(m4 / (m2 * m2) - 3, 2) / 4), 6) AS jarque_bera
        FROM (SELECT *, avg((d - m) ** 2) OVER w AS m2, avg((d - m) ** 3) OVER w AS m3, avg((d - m) ** 4) OVER w AS m4
              FROM (SELECT *, avg(d) OVER (PARTITION BY run_id, baseline) AS m FROM ({ONE_SEED}))
              WINDOW w AS (PARTITION BY run_id, baseline))
        GROUP BY run_id, baseline, m2, m3, m4""",
    views="v_folds",
)
def k3(spark, sf):
    n = significance.normality(diffs(spark, sf))
    return n.select("run_id", "baseline", "n", F.round("jarque_bera", 6).alias("jarque_bera"))


@query("k3_shapiro_p")
def k3_p(spark, sf):
    return significance.normality(diffs(spark, sf)).select("run_id", "baseline", "n", "p_norm")


def _weights(n: int) -> str:
    """Weights of the normality test for ``n`` values in order, as an SQL list."""
    m = [NormalDist().inv_cdf((i - 0.375) / (n + 0.25)) for i in range(1, n + 1)]
    last, second, scale = tails.shapiro_weights(n, sum(x * x for x in m), m[-1], m[-2])
    own = [-last, -second, *[x * scale for x in m[2:-2]], second, last]
    return "[" + ", ".join(f"{w!r}::DOUBLE" for w in own) + "]"


# 25 folds a comparison: W over the differences in order, and Royston's z of it
W25 = f"""SELECT run_id, baseline, count(*) AS n, avg(d) / (stddev_samp(d) / sqrt(count(*))) AS t,
      list_sum(list_transform(list_sort(list(d)), lambda x, i: x * {_weights(25)}[i])) ** 2 / (var_pop(d) * count(*)) AS w
    FROM ({ONE_SEED}) GROUP BY ALL"""
Z25 = f"(ln(1 - w) - {float(np.polyval(tails.LARGE_MEAN, math.log(25)))!r}) / {math.exp(np.polyval(tails.LARGE_LOG_SD, math.log(25)))!r}"


@query("k3_shapiro_w", f"SELECT run_id, baseline, n, round(w, 9) AS w, {Z25} <= {NormalDist().inv_cdf(0.95)!r} AS normal FROM ({W25})", views="v_folds")
def k3_w(spark, sf):
    """W of each comparison and whether it passes for normal."""
    found = significance.normality(diffs(spark, sf))
    return found.select("run_id", "baseline", "n", F.round("w", 9).alias("w"), (F.col("p_norm") >= significance.NORMAL_P).alias("normal"))


@query(
    "k7_test_and_statistic",
    f"""SELECT run_id, baseline, CASE WHEN {Z25} <= {NormalDist().inv_cdf(0.95)!r} THEN 'paired_t' ELSE 'wilcoxon' END AS test,
               round(CASE WHEN {Z25} <= {NormalDist().inv_cdf(0.95)!r} THEN t ELSE w_plus END, 4) AS stat
        FROM ({W25}) JOIN (SELECT run_id, baseline, coalesce(sum(r) FILTER (d > 0), 0) AS w_plus FROM (
          SELECT run_id, baseline, d, rank() OVER (PARTITION BY run_id, baseline ORDER BY a)
                 + (count(*) OVER (PARTITION BY run_id, baseline, a) - 1) / 2.0::DOUBLE AS r
          FROM (SELECT *, abs(d) AS a FROM ({ONE_SEED})) WHERE a > 0) GROUP BY ALL) USING (run_id, baseline)""",
    views="v_folds",
)
def k7_statistic(spark, sf):
    """Test that the differences call for, and its statistic."""
    t = significance.compare(diffs(spark, sf))
    return t.select("run_id", "baseline", "test", F.round("stat", 4).alias("stat"))


# the t tail with 24 degrees of freedom as a finite sum over even powers of the cosine
T24 = """0.5 - 0.5 * sin(th) * (1""" + "".join(
    " + " + "*".join(f"({2 * i - 1}.0/{2 * i}.0)" for i in range(1, k + 1)) + f" * power(cos(th), {2 * k})" for k in range(1, 12)
) + ")"


@query(
    "k4_paired_t",
    f"""SELECT run_id, baseline, n, round(t, 4) AS t, round({T24}, 6) AS p_t
        FROM (SELECT *, atan(t / sqrt(24.0::DOUBLE)) AS th FROM (
              SELECT run_id, baseline, count(*) AS n, avg(d) / (stddev_samp(d) / sqrt(count(*))) AS t
              FROM ({ONE_SEED}) GROUP BY ALL))""",
    views="v_folds",
)
def k4(spark, sf):
    t = significance.paired_t(significance.summary(diffs(spark, sf)))
    return t.select("run_id", "baseline", "n", F.round("t", 4).alias("t"), F.round("p_t", 6).alias("p_t"))


@query(
    "k5_signed_rank",
    f"""SELECT run_id, baseline, coalesce(sum(r) FILTER (d > 0), 0) AS w_plus, count(*) AS n_nonzero FROM (
          SELECT run_id, baseline, d, rank() OVER (PARTITION BY run_id, baseline ORDER BY a)
                 + (count(*) OVER (PARTITION BY run_id, baseline, a) - 1) / 2.0::DOUBLE AS r
          FROM (SELECT *, abs(round(d, 9)) AS a FROM ({ONE_SEED})) WHERE a > 0) GROUP BY ALL""",
    views="v_folds",
)
def k5(spark, sf):
    d = diffs(spark, sf).withColumn("d", F.round("d", 9))
    return significance.signed_rank(d).select("run_id", "baseline", "w_plus", "n_nonzero")


def normal_tail(z: str) -> str:
    """P(Z > z) in SQL, by the series of the error function whose terms are all positive."""
    terms, c = [], 1.0
    for i in range(140):
        c = c * 2 / (2 * i + 1) if i else 1.0
        terms.append(f"{c!r}::DOUBLE")
    x = f"(abs({z}) / sqrt(2.0::DOUBLE))"
    series = f"list_sum(list_transform([{', '.join(terms)}], lambda c, i: c * power({x}, 2 * i - 1)))"
    half = f"(exp(-{x} * {x}) / sqrt(pi()) * {series})"
    return f"CASE WHEN {z} > 0 THEN 0.5 - {half} ELSE 0.5 + {half} END"


# ways to reach each sum of ranks 1 .. n, for the exact tail; ties and zeros take the normal one
SIGNED_RANK_P = f"""WITH RECURSIVE r AS (
      SELECT run_id, baseline, d, a, rank() OVER (PARTITION BY run_id, baseline ORDER BY a) + (count(*) OVER (PARTITION BY run_id, baseline, a) - 1) / 2.0::DOUBLE AS r
      FROM (SELECT *, abs(d) AS a FROM (SELECT run_id, baseline, round(d, 9) AS d FROM ({ONE_SEED}))) WHERE a > 0),
    t AS (SELECT run_id, baseline, sum(c * c * c - c) AS ties FROM (SELECT run_id, baseline, a, count(*) AS c FROM r GROUP BY ALL) GROUP BY ALL),
    z AS (SELECT run_id, baseline, count(*) AS n_zero FROM ({ONE_SEED}) WHERE round(d, 9) = 0 GROUP BY ALL),
    w AS (SELECT run_id, baseline, coalesce(sum(r) FILTER (d > 0), 0) AS w_plus, count(*) AS n FROM r GROUP BY ALL),
    ways AS (SELECT 0 AS m, [1.0::DOUBLE] AS x UNION ALL
      SELECT m + 1, list_transform(range(1, len(x) + m + 2), lambda i: coalesce(x[i], 0) + CASE WHEN i > m + 1 THEN coalesce(x[i - m - 1], 0) ELSE 0 END) FROM ways WHERE m < 25),
    told AS (SELECT w.*, coalesce(ties, 0) AS ties, coalesce(n_zero, 0) AS n_zero, list_sum(x[ceil(w_plus)::INT + 1:]) / list_sum(x) AS exact,
        (w_plus - n * (n + 1) / 4.0::DOUBLE) / sqrt(n * (n + 1) * (2 * n + 1) / 24.0::DOUBLE - coalesce(ties, 0) / 48.0::DOUBLE) AS z
      FROM w JOIN ways ON ways.m = w.n LEFT JOIN t USING (run_id, baseline) LEFT JOIN z USING (run_id, baseline))
    SELECT run_id, baseline, w_plus, round(CASE WHEN ties = 0 AND n_zero = 0 THEN exact ELSE {normal_tail('z')} END, 6) AS p_wilcoxon FROM told"""


@query("k5_wilcoxon_p", SIGNED_RANK_P, views="v_folds")
def k5_tail(spark, sf):
    """Signed-rank statistic with its one-sided p."""
    found = significance.signed_rank_p(significance.signed_rank(diffs(spark, sf).withColumn("d", F.round("d", 9))))
    return found.select("run_id", "baseline", "w_plus", F.round("p_wilcoxon", 6).alias("p_wilcoxon"))


@query("k3_normality_p", f"SELECT run_id, baseline, round({normal_tail(Z25)}, 6) AS p_norm FROM ({W25})", views="v_folds")
def k3_tail(spark, sf):
    return significance.normality(diffs(spark, sf)).select("run_id", "baseline", F.round("p_norm", 6).alias("p_norm"))


@query("k5_signed_rank_p")
def k5_p(spark, sf):
    return significance.signed_rank_p(significance.signed_rank(diffs(spark, sf)))


N_PERM = 10000


@query(
    "k6_permutation",
    f"""WITH d AS (SELECT *, row_number() OVER (PARTITION BY run_id, baseline ORDER BY seed, fold) - 1 AS idx FROM ({ONE_SEED}) WHERE seed = 42),
        pool AS (SELECT run_id, baseline, 2 * idx AS item, best AS s FROM d UNION ALL SELECT run_id, baseline, 2 * idx + 1, base FROM d),
        sh AS (SELECT run_id, baseline, perm, s, row_number() OVER (PARTITION BY run_id, baseline, perm
                 ORDER BY {v.h32("concat_ws(':', 42, perm, item)")}, item) AS pos FROM pool, range({N_PERM}) r(perm)),
        gap AS (SELECT run_id, baseline, perm, avg(s) FILTER (pos <= 5) - avg(s) FILTER (pos > 5) AS g FROM sh GROUP BY ALL),
        obs AS (SELECT run_id, baseline, avg(best) - avg(base) AS o FROM d GROUP BY ALL)
        SELECT run_id, baseline, avg((round(g, 12) >= round(o, 12))::INT) AS p_perm FROM gap JOIN obs USING (run_id, baseline) GROUP BY ALL""",
    views="v_folds",
)
def k6(spark, sf):
    return significance.permutation_p(diffs(spark, sf, 42), n_perm=N_PERM)


@query("k7_chosen_test")
def k7(spark, sf):
    t = significance.compare(diffs(spark, sf))
    return t.select("run_id", "baseline", "test", "stat", "p_value", "p_norm")


def boot_sql(source: str, keys: str, value: str, reps: int) -> str:
    return f"""WITH d AS (SELECT {keys}, {value} AS x, row_number() OVER (PARTITION BY {keys} ORDER BY seed, fold) - 1 AS idx,
                                count(*) OVER (PARTITION BY {keys}) AS n FROM ({source})),
        g AS (SELECT DISTINCT {keys}, n FROM d),
        draws AS (SELECT {keys}, rep, {v.h32("concat_ws(':', 42, rep, draw)")} % n AS idx
                  FROM g, range({reps}) a(rep), range(1000) b(draw) WHERE draw < n),
        m AS (SELECT {keys}, rep, avg(x) AS m FROM draws JOIN d USING ({keys}, idx) GROUP BY {keys}, rep)
        SELECT {keys}, round(quantile_cont(m, 0.025), 6) AS ci_low, round(quantile_cont(m, 0.975), 6) AS ci_high FROM m GROUP BY {keys}"""


@query("k8_bootstrap_lift_ci", boot_sql(ONE_SEED, "run_id, baseline", "d", 2000), views="v_folds")
def k8(spark, sf):
    ci = significance.bootstrap_ci(diffs(spark, sf), ["run_id", "baseline"], "d")
    return ci.select("run_id", "baseline", F.round("ci_low", 6).alias("ci_low"), F.round("ci_high", 6).alias("ci_high"))


@query(
    "k9_effect_size",
    f"""SELECT run_id, baseline, round(avg(d), 6) AS lift, round(coalesce(avg(d) / nullif(stddev_samp(d), 0), 0), 6) AS cohen_d,
               round(avg(d) / CASE WHEN abs(avg(base)) > 1e-9 THEN abs(avg(base)) ELSE 1 END * 100, 6) AS lift_pct
        FROM ({ONE_SEED}) GROUP BY ALL""",
    views="v_folds",
)
def k9(spark, sf):
    s = significance.summary(diffs(spark, sf))
    return s.select("run_id", "baseline", *[F.round(c, 6).alias(c) for c in ("lift", "cohen_d", "lift_pct")])


CI_SQL = boot_sql(ONE_SEED, "run_id, baseline", "d", 2000)


@query(
    "k11_gates",
    f"""WITH ci AS ({CI_SQL}),
        s AS (SELECT run_id, baseline, avg(d) AS lift, avg(d) / nullif(stddev_samp(d), 0) AS cd, avg(base) AS b,
                     atan(avg(d) / (stddev_samp(d) / sqrt(count(*))) / sqrt(24.0::DOUBLE)) AS th FROM ({ONE_SEED}) GROUP BY ALL)
        SELECT run_id, bool_or(round({T24}, 12) < 0.05) AS g1, bool_or(round(lift / abs(b) * 100, 12) >= 2) AS g2, bool_or(round(abs(cd), 12) >= 0.2) AS g3,
               bool_or(round(ci_low, 12) > 0) AS g4 FROM s JOIN ci USING (run_id, baseline) GROUP BY run_id""",
    views="v_folds",
)
def k11(spark, sf):
    d = diffs(spark, sf)
    tests = significance.paired_t(significance.summary(d)).withColumnRenamed("p_t", "p_value")
    ci = significance.bootstrap_ci(d, ["run_id", "baseline"], "d")
    return significance.gates(tests.join(ci, ["run_id", "baseline"]))


@query("k12_verdict")
def k12(spark, sf):
    tests = significance.compare(diffs(spark, sf))
    return significance.verdict(significance.gates(tests))


@query(
    "k12_run_verdicts",
    """SELECT run_id, task, CASE WHEN task NOT IN ('classification', 'regression') THEN 'N/A'
              WHEN n IS NULL THEN 'FAIL' WHEN n = 4 THEN 'PASS' WHEN n >= 2 THEN 'WARN' ELSE 'FAIL' END AS verdict
       FROM (SELECT c_custkey AS run_id, CASE c_custkey % 3 WHEN 0 THEN 'classification' WHEN 1 THEN 'regression' ELSE 'clustering' END AS task FROM customer)
       LEFT JOIN (SELECT o_custkey AS run_id, bool_or(o_totalprice > 400000)::INT + bool_or(o_totalprice < 50000)::INT
                         + bool_or(o_orderstatus = 'P')::INT + bool_or(o_orderpriority = '1-URGENT')::INT AS n
                  FROM orders GROUP BY o_custkey) USING (run_id)""",
)
def k12_runs(spark, sf):
    """The verdict rule over many runs: gates from orders, runs from customers."""
    o = read_table(spark, sf, "orders")
    gated = o.groupBy(F.col("o_custkey").alias("run_id")).agg(
        F.bool_or(F.col("o_totalprice") > 400000).alias("g1"), F.bool_or(F.col("o_totalprice") < 50000).alias("g2"),
        F.bool_or(F.col("o_orderstatus") == "P").alias("g3"), F.bool_or(F.col("o_orderpriority") == "1-URGENT").alias("g4"),
    )
    runs = read_table(spark, sf, "customer").selectExpr(
        "c_custkey AS run_id",
        "CASE c_custkey % 3 WHEN 0 THEN 'classification' WHEN 1 THEN 'regression' ELSE 'clustering' END AS task",
    )
    return significance.run_verdicts(runs, significance.verdict(gated))


@query("d10_forest_rows", f"""SELECT run_id, baseline AS label, round(avg(base) + avg(d), 6) AS mean,
       round(avg(base) + max(ci_low), 5) AS low, round(avg(base) + max(ci_high), 5) AS high
       FROM ({ONE_SEED}) JOIN ({CI_SQL}) USING (run_id, baseline) GROUP BY ALL""", views="v_folds")
def d10(spark, sf):
    d = diffs(spark, sf)
    ci = significance.bootstrap_ci(d, ["run_id", "baseline"], "d")
    f = rates.forest_rows(significance.summary(d).join(ci, ["run_id", "baseline"]))
    return f.select("run_id", "label", F.round("mean", 6).alias("mean"), F.round("low", 5).alias("low"), F.round("high", 5).alias("high"))


# ---- robustness --------------------------------------------------------------------

RULE_SCORES = f"SELECT * FROM ({scoring.SCORES_SQL}) WHERE model = 'rule'"


def rule_scores(spark, sf):
    return metrics.scores(scoring.rule_preds(spark, sf), ["accuracy"])


@query(
    "l1_multi_seed",
    f"""SELECT seed, count(*) AS n, round(avg(score), 6) AS mean, round(stddev_pop(score), 6) AS std FROM ({RULE_SCORES}) GROUP BY seed""",
    views="v_folds",
)
def l1(spark, sf):
    s = rates.score_summary(rule_scores(spark, sf), ["seed"])
    return s.select("seed", "n", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"))


@query("l2_bootstrap_mean_ci", boot_sql(RULE_SCORES, "run_id", "score", 2000), views="v_folds")
def l2(spark, sf):
    ci = significance.bootstrap_ci(rule_scores(spark, sf), ["run_id"], "score")
    return ci.select("run_id", F.round("ci_low", 6).alias("ci_low"), F.round("ci_high", 6).alias("ci_high"))


POISSON = (0.36787944117144233, 0.7357588823428847, 0.9196986029286058, 0.9810118431238462,
           0.9963401531726563, 0.9994058151824183, 0.9999167588507119, 0.9999897508033253)


@query(
    "l2_poisson_bootstrap",
    f"""WITH b AS (SELECT {v.h32("concat_ws(':', 'block', o_orderkey)")} % 1024 AS block, sum(o_totalprice) AS x, count(*) AS n FROM orders GROUP BY 1),
        w AS (SELECT rep, x, n, {" + ".join(f"(u >= {p})::INT" for p in POISSON)} AS w
              FROM (SELECT rep, x, n, {v.h32("concat_ws(':', 42, rep, block)")} / 4294967296.0::DOUBLE AS u FROM b, range(2000) r(rep))),
        m AS (SELECT rep, sum(w * x) / sum(w * n) AS m FROM w GROUP BY rep)
        SELECT round(quantile_cont(m, 0.025), 4) AS ci_low, round(quantile_cont(m, 0.975), 4) AS ci_high FROM m""",
)
def l2_poisson(spark, sf):
    ci = robustness.poisson_bootstrap(read_table(spark, sf, "orders"), "o_orderkey", "o_totalprice")
    return ci.select(F.round("ci_low", 4).alias("ci_low"), F.round("ci_high", 4).alias("ci_high"))


@query(
    "l3_baseline_mean",
    f"SELECT run_id, round(avg(score), 6) AS baseline_mean FROM ({scoring.SCORES_SQL}) WHERE model = 'majority' GROUP BY run_id",
    views="v_folds",
)
def l3(spark, sf):
    s = metrics.scores(scoring.majority_preds(spark, sf), ["accuracy"])
    return s.groupBy("run_id").agg(F.round(F.avg("score"), 6).alias("baseline_mean"))


LOFO_SQL = f"""SELECT substr(m.feature_set, 2) AS feature, m.s AS score, f.s - m.s AS drop, (f.s - m.s) / abs(f.s) * 100 AS drop_pct
    FROM (SELECT feature_set, avg(r2) AS s FROM ({scoring.RIDGE2}) GROUP BY feature_set) m,
         (SELECT avg(r2) AS s FROM ({scoring.RIDGE2}) WHERE feature_set = 'full') f WHERE m.feature_set <> 'full'"""


@query(
    "l4_ridge_lofo",
    f"SELECT feature, round(score, 5) AS score, round(drop, 5) AS drop, round(drop_pct, 4) AS drop_pct FROM ({LOFO_SQL})",
    views="v_folds",
)
def l4(spark, sf):
    d = linear.lofo(scoring.ridge_scores(spark, sf), "r2")
    return d.select("feature", F.round("score", 5).alias("score"), F.round("drop", 5).alias("drop"), F.round("drop_pct", 4).alias("drop_pct"))


@query(
    "l5_lofo_classes",
    f"""SELECT feature, CASE WHEN drop_pct > 25 THEN 'CRITICAL' WHEN drop_pct > 15 THEN 'load-bearing' ELSE '' END AS drop_class FROM ({LOFO_SQL})""",
    views="v_folds",
)
def l5(spark, sf):
    return robustness.lofo_classes(linear.lofo(scoring.ridge_scores(spark, sf), "r2")).select("feature", "drop_class")


def rule_rows(spark, sf):
    """Labelled documents with the rule's prediction."""
    return v.quality(spark, sf).withColumns(
        {"label": F.col("quality").cast("double"), "pred": (F.col("junk_n") == 0).cast("double")}
    )


@query(
    "l6_third_slices",
    """SELECT 'by_n_chars_' || s AS slice, count(*) AS n, round(avg(((junk_n = 0)::INT = quality)::INT), 6) AS score FROM (
         SELECT *, CASE WHEN n_chars <= q[1] THEN 'low_33%' WHEN n_chars <= q[2] THEN 'mid_33%' ELSE 'high_33%' END AS s
         FROM v_quality, (SELECT quantile_cont(n_chars, [0.33, 0.67]) AS q FROM v_quality))
       GROUP BY s HAVING count(*) >= 30 AND min(quality) <> max(quality)""",
    views="v_quality",
)
def l6(spark, sf):
    s = robustness.slice_scores(robustness.third_slices(rule_rows(spark, sf), "n_chars"), metrics.accuracy())
    return s.withColumn("score", F.round("score", 6))


@query(
    "l7_half_slices",
    """SELECT 'by_n_chars_' || s AS slice, count(*) AS n, round(avg(((junk_n = 0)::INT = quality)::INT), 6) AS score FROM (
         SELECT *, CASE WHEN row_number() OVER (ORDER BY n_chars, doc_id) > (count(*) OVER ()) // 2 THEN 'head_50%' ELSE 'tail_50%' END AS s
         FROM v_quality) GROUP BY s HAVING count(*) >= 30 AND min(quality) <> max(quality)""",
    views="v_quality",
)
def l7(spark, sf):
    s = robustness.slice_scores(robustness.half_slices(rule_rows(spark, sf), "n_chars", "doc_id"), metrics.accuracy())
    return s.withColumn("score", F.round("score", 6))


@query(
    "l8_class_recall",
    """SELECT CASE WHEN n = lo THEN 'rare_class' ELSE 'common_class' END AS slice, n, score FROM (
         SELECT quality, count(*) AS n, round(avg(((junk_n = 0)::INT = quality)::INT), 6) AS score,
                min(count(*)) OVER () AS lo FROM v_quality GROUP BY quality) WHERE n >= 30""",
    views="v_quality",
)
def l8(spark, sf):
    return robustness.class_recall(rule_rows(spark, sf)).withColumn("score", F.round("score", 6))


PERM_FEATURES = ["junk_share", "n_chars", "toxic", "junk_n", "label_day"]
LINE = "1 - 20 * junk_share + n_chars / 1000000.0 - 0.05 * toxic - 0.002 * junk_n + 0.001 * label_day"
PERM_SEEDS, PERM_REPEATS = (0, 1, 7, 42, 123), 10


def line_rule(df):
    """A fixed linear scorer with a cut."""
    line = (
        1 - 20 * F.col("junk_share") + F.col("n_chars") / 1000000.0 - 0.05 * F.col("toxic")
        - 0.002 * F.col("junk_n") + 0.001 * F.col("label_day")
    )
    return df.withColumn("pred", (line >= 0.9).cast("double"))


PERM_ROWS = "(SELECT *, doc_id % 30 AS label_day FROM v_quality)"


def _perm_sql(feature: str) -> str:
    cols = ", ".join(f"g.{c} AS {c}" if c == feature else f"t.{c} AS {c}" for c in PERM_FEATURES)
    return f"""SELECT '{feature}' AS feature, t.seed, repeat, t.quality, {cols}
        FROM ranked t, range({PERM_REPEATS}) r(repeat), ranked g
        WHERE g.seed = t.seed AND g.p = (t.p + 1 + {v.h32("concat_ws(':', 'shift', t.seed, repeat)")} % greatest(t.n - 1, 1)) % t.n"""


PERM_SQL = f"""WITH ranked AS (SELECT *, row_number() OVER (PARTITION BY seed ORDER BY {v.h32("concat_ws(':', 'order', seed, doc_id)")}, doc_id) - 1 AS p,
             count(*) OVER (PARTITION BY seed) AS n FROM {PERM_ROWS}, (SELECT unnest({list(PERM_SEEDS)}) AS seed))
      SELECT feature, seed, base - avg(s) AS importance FROM (
      SELECT feature, seed, repeat, avg((({LINE} >= 0.9)::INT = quality)::INT) AS s
      FROM ({" UNION ALL ".join(_perm_sql(c) for c in PERM_FEATURES)}) GROUP BY ALL),
      (SELECT avg((({LINE} >= 0.9)::INT = quality)::INT) AS base FROM {PERM_ROWS}) GROUP BY feature, seed, base"""


def importances(spark, sf):
    rows = v.quality(spark, sf).withColumns(
        {"label": F.col("quality").cast("double"), "label_day": F.pmod("doc_id", F.lit(30))}
    ).select("doc_id", "label", *PERM_FEATURES)
    return robustness.permutation_importance(
        rows, "doc_id", PERM_FEATURES, line_rule, metrics.accuracy(), PERM_REPEATS, PERM_SEEDS
    )


@query("l9_permutation_importance", f"SELECT feature, seed, round(importance, 6) AS importance FROM ({PERM_SQL})", views="v_quality")
def l9(spark, sf):
    return importances(spark, sf).select("feature", "seed", F.round("importance", 6).alias("importance"))


@query(
    "l10_top3_stability",
    f"""WITH l AS (SELECT seed, string_agg(feature, ',' ORDER BY k) AS top3 FROM (SELECT seed, feature, row_number() OVER (PARTITION BY seed ORDER BY round(importance, 9) DESC, feature) AS k FROM ({PERM_SQL})) WHERE k <= 3 GROUP BY seed)
        SELECT top3, count(*) AS n_match, (SELECT count(*) FROM l) AS n_seeds FROM l GROUP BY top3
        ORDER BY count(*) DESC, min(seed) LIMIT 1""",
    views="v_quality",
)
def l10(spark, sf):
    return robustness.top3_stability(importances(spark, sf).withColumn("importance", F.round("importance", 9)))


@query(
    "l11_gates_and_verdict",
    f"""WITH ci AS ({boot_sql(RULE_SCORES, "run_id", "score", 2000)}),
        g AS (SELECT run_id, round(stddev_pop(score), 12) <= 0.03 AS g1_stability,
                     round(max(ci_low), 12) > (SELECT round(avg(score), 12) FROM ({scoring.SCORES_SQL}) WHERE model = 'majority') AS g2_ci_above_baseline,
                     (SELECT count(*) FROM ({LOFO_SQL}) WHERE round(drop_pct, 12) > 25) = 0 AS g3_lofo
              FROM ({RULE_SCORES}) JOIN ci USING (run_id) GROUP BY run_id)
        SELECT run_id, g1_stability, g2_ci_above_baseline, g3_lofo, n_pass,
               CASE WHEN n_pass = 3 THEN 'PASS' WHEN n_pass >= 1 THEN 'WARN' ELSE 'FAIL' END AS verdict
        FROM (SELECT *, g1_stability::INT + g2_ci_above_baseline::INT + g3_lofo::INT AS n_pass FROM g)""",
    views="v_folds",
)
def l11(spark, sf):
    s = rule_scores(spark, sf)
    ci = significance.bootstrap_ci(s, ["run_id"], "score")
    base = metrics.scores(scoring.majority_preds(spark, sf), ["accuracy"]).groupBy("run_id").agg(
        F.avg("score").alias("baseline_mean")
    )
    drops = linear.lofo(scoring.ridge_scores(spark, sf), "r2").withColumn("run_id", F.lit("quality"))
    return robustness.gates(rates.score_summary(s, ["run_id"]), ci, base, drops)
