"""Queries: customers' plans over the labelled documents, reviewed from plan to verdict."""

from __future__ import annotations

import math
from statistics import NormalDist

import numpy as np
from pyspark.sql import functions as F

from ..functions import tails
from ..operators import review, robustness
from ..session import cut_lineage
from ..sources.tables import read_table, spread
from . import views as v
from .catalog import query

COLUMNS = ["kchars", "junk_share", "toxic", "day", "quality"]

# notes of runs, one per customer, valid in both engines (chr: 10 newline, 39 quote)
PLAN_TEXT = """concat(
  '- goal: run-', cast(c_custkey AS STRING), chr(10),
  '- analysis_type: ', CASE WHEN c_custkey % 7 = 0 THEN 'clustering' ELSE 'regression' END, chr(10),
  '- target_variable: ', CASE WHEN c_custkey % 25 = 4 THEN 'price' WHEN c_custkey % 5 < 2 THEN 'quality' WHEN c_custkey % 5 = 2 THEN 'toxic' ELSE 'kchars' END, chr(10),
  '- success_metric: ', CASE c_custkey % 3 WHEN 0 THEN 'RMSE' WHEN 1 THEN 'R2' ELSE 'MAE' END, chr(10),
  CASE WHEN c_custkey % 6 = 0 THEN 'a time series' ELSE 'rows in any order' END, chr(10))"""
CYCLE_TEXT = """concat('best_features: ', CASE c_custkey % 4
    WHEN 0 THEN concat('[', chr(39), 'junk_share', chr(39), ']')
    WHEN 1 THEN concat('[', chr(39), 'junk_share', chr(39), ', ', chr(39), 'price', chr(39), ', ', chr(39), 'day', chr(39), ']')
    WHEN 2 THEN 'day only' ELSE 'toxic and day' END, chr(10), 'best_model: Ridge', chr(10))"""


def dataset(spark, sf) -> review.Dataset:
    """Labelled documents with a column (day) that explains nothing."""
    rows = v.quality(spark, sf).select(
        "doc_id", (F.col("n_chars") / 1000.0).alias("kchars"), "junk_share", "toxic", F.pmod("doc_id", F.lit(30)).alias("day"), "quality"
    )
    return review.Dataset(rows, "doc_id", COLUMNS)


def notes_of(spark, sf):
    """Plans and loop notes of all runs."""
    runs = spread(read_table(spark, sf, "customer").select("c_custkey"), "c_custkey")
    plans = runs.selectExpr("c_custkey AS run_id", "'documents' AS dataset", f"{PLAN_TEXT} AS text")
    return plans, runs.selectExpr("c_custkey AS run_id", f"{CYCLE_TEXT} AS text")


def reviewed(spark, sf) -> review.Review:
    return review.review(*notes_of(spark, sf), {"documents": dataset(spark, sf)})


# ---- the same in SQL: closed forms for up to two features ------------------------

#: Requests: a feature is its place in COLUMNS (0: none). Cells: rows of a split with their values as a list.
REQUESTS = """req AS (
    SELECT c_custkey AS run_id, CASE WHEN c_custkey % 7 = 0 THEN 'clustering' ELSE 'regression' END AS task,
           CASE WHEN c_custkey % 25 = 4 THEN 'price' WHEN c_custkey % 5 < 2 THEN 'quality' WHEN c_custkey % 5 = 2 THEN 'toxic' ELSE 'kchars' END AS target,
           CASE c_custkey % 3 WHEN 0 THEN 'neg_root_mean_squared_error' WHEN 1 THEN 'r2' ELSE 'neg_mean_absolute_error' END AS scorer,
           CASE WHEN c_custkey % 6 = 0 THEN 'time' ELSE 'kfold' END AS splitter,
           CASE c_custkey % 4 WHEN 0 THEN 2 WHEN 1 THEN 2 WHEN 2 THEN 4 ELSE 3 END AS f1, CASE c_custkey % 4 WHEN 0 THEN 0 WHEN 2 THEN 0 ELSE 4 END AS f2
    FROM customer),
  reviews AS (
    SELECT DISTINCT target, scorer, splitter, f1, f2, CASE target WHEN 'quality' THEN 5 WHEN 'toxic' THEN 3 ELSE 1 END AS y
    FROM req WHERE task = 'regression' AND target <> 'price'),
  fits AS (
    SELECT DISTINCT splitter, y, f1, f2 FROM reviews UNION SELECT DISTINCT splitter, y, f1, 0 FROM reviews
    UNION SELECT DISTINCT splitter, y, f2, 0 FROM reviews UNION SELECT DISTINCT splitter, y, 0, 0 FROM reviews)"""

ROWS = f"""base AS (
    SELECT doc_id, [n_chars / 1000.0::DOUBLE, coalesce(junk_share, (SELECT quantile_cont(junk_share, 0.5) FROM v_quality)), toxic, doc_id % 30, quality]::DOUBLE[] AS x
    FROM v_quality),
  cells AS (
    SELECT 'kfold' AS splitter, seed, x, ((row_number() OVER (PARTITION BY seed ORDER BY {v.h32("concat_ws(':', seed, doc_id)")}, doc_id) - 1) % 5)::INT AS fold
    FROM base, (SELECT unnest([0, 1, 7, 42, 123]) AS seed)
    UNION ALL
    SELECT 'time', seed, x, greatest(0, 6 - ceil((n - pos) / (n // 6)::DOUBLE))::INT
    FROM (SELECT x, row_number() OVER (ORDER BY doc_id) - 1 AS pos, count(*) OVER () AS n FROM base), (SELECT unnest([0, 1, 7, 42, 123]) AS seed)),
  splits AS (SELECT DISTINCT splitter, seed, fold FROM cells WHERE splitter = 'kfold' OR fold > 0),
  mom AS (
    SELECT s.splitter, s.seed, s.fold, a, b, avg(c.x[a]) AS ma, covar_pop(c.x[a], c.x[b]) * count(*) AS ab
    FROM splits s JOIN cells c ON c.splitter = s.splitter AND c.seed = s.seed AND CASE WHEN s.splitter = 'time' THEN c.fold < s.fold ELSE c.fold <> s.fold END,
         range(1, 6) i(a), range(1, 6) j(b)
    GROUP BY ALL)"""


def _cov(a: str, b: str) -> str:
    return f"coalesce((SELECT ab FROM mom m WHERE m.splitter = s.splitter AND m.seed = s.seed AND m.fold = s.fold AND m.a = {a} AND m.b = {b}), 0)"


def _mean(a: str) -> str:
    return f"coalesce((SELECT ma FROM mom m WHERE m.splitter = s.splitter AND m.seed = s.seed AND m.fold = s.fold AND m.a = {a} AND m.b = {a}), 0)"


SCORES = f"""sys AS (
    SELECT f.*, s.seed, s.fold, {_cov('f1', 'f1')} + 1 AS aa, {_cov('f2', 'f2')} + 1 AS bb, {_cov('f1', 'f2')} AS ab, {_cov('f1', 'y')} AS ay, {_cov('f2', 'y')} AS b_y,
           {_mean('f1')} AS m1, {_mean('f2')} AS m2, {_mean('y')} AS my
    FROM fits f JOIN splits s ON s.splitter = f.splitter),
  models AS (
    SELECT splitter, seed, fold, y, f1, f2, 'ridge' AS kind, (ay * bb - b_y * ab) / (aa * bb - ab * ab) AS c1, (b_y * aa - ay * ab) / (aa * bb - ab * ab) AS c2, m1, m2, my FROM sys
    UNION ALL
    SELECT s.splitter, s.seed, s.fold, y, 0, 0, 'median', 0, 0, 0, 0, quantile_cont(c.x[y], 0.5)
    FROM splits s JOIN cells c ON c.splitter = s.splitter AND c.seed = s.seed AND CASE WHEN s.splitter = 'time' THEN c.fold < s.fold ELSE c.fold <> s.fold END,
         (SELECT DISTINCT y FROM fits) GROUP BY ALL),
  wide AS (
    SELECT m.splitter, m.seed, m.fold, y, f1, f2, kind, -sqrt(avg(e * e)) AS rmse, -avg(abs(e)) AS mae, 1 - sum(e * e) / nullif(var_pop(t) * count(*), 0) AS r2
    FROM (SELECT m.*, c.x[y] AS t, c.x[y] - my - c1 * coalesce(c.x[f1] - m1, 0) - c2 * coalesce(c.x[f2] - m2, 0) AS e
          FROM models m JOIN cells c ON c.splitter = m.splitter AND c.seed = m.seed AND c.fold = m.fold) m
    GROUP BY ALL),
  scores AS (
    SELECT splitter, seed, fold, y, f1, f2, kind, scorer, CASE scorer WHEN 'r2' THEN r2 WHEN 'neg_mean_absolute_error' THEN mae ELSE rmse END AS score
    FROM wide, (SELECT unnest(['neg_root_mean_squared_error', 'r2', 'neg_mean_absolute_error']) AS scorer)),
  best AS (SELECT r.*, seed, fold, score FROM reviews r JOIN scores s USING (splitter, y, f1, f2, scorer) WHERE kind = 'ridge' AND score IS NOT NULL),
  naive AS (
    SELECT r.*, CASE kind WHEN 'ridge' THEN 'mean' ELSE kind END AS baseline, seed, fold, score
    FROM reviews r JOIN scores s ON s.splitter = r.splitter AND s.y = r.y AND s.scorer = r.scorer AND s.f1 = 0 AND s.f2 = 0 WHERE seed = 42 AND score IS NOT NULL)"""

REVIEW = "target, scorer, splitter, f1, f2"


def _by_n(made) -> str:
    """A value for three, four or five folds; a fold may lack a score."""
    return f"CASE n WHEN 3 THEN {made(3)} WHEN 4 THEN {made(4)} ELSE {made(5)} END"


def _normal_weights(n: int) -> str:
    """Weights of the normality test, from its published polynomials."""
    m = [NormalDist().inv_cdf((i - 0.375) / (n + 0.25)) for i in range(1, n + 1)]
    last, _, scale = tails.shapiro_weights(n, sum(x * x for x in m), m[-1], m[-2])
    return "[" + ", ".join(f"{w!r}::DOUBLE" for w in (-last, *[x * scale for x in m[1:-1]], last)) + "]"


def _edge(n: int) -> str:
    return f"({tails.SMALL_GAMMA[1] + n * tails.SMALL_GAMMA[0]!r} - ln(1 - w))"


def _z(n: int) -> str:
    """z of W for four or five values; three have a p of their own, here as its distance from 0.05."""
    if n == 3:
        return "0.05 - greatest(6 / pi() * (asin(sqrt(w)) - asin(sqrt(0.75))), 0)"
    mean, sd = float(np.polyval(tails.SMALL_MEAN, n)), math.exp(np.polyval(tails.SMALL_LOG_SD, n))
    return f"CASE WHEN {_edge(n)} <= 0 THEN 9 ELSE (-ln({_edge(n)}) - {mean!r}) / {sd!r} - {NormalDist().inv_cdf(0.95)!r} END"


#: One-sided tails of the t statistic with two, three and four degrees of freedom.
T_TAIL = {
    3: "0.5 - t / (2 * sqrt(2 + t * t))",
    4: "0.5 - (atan(t / sqrt(3)) + sin(atan(t / sqrt(3))) * cos(atan(t / sqrt(3)))) / pi()",
    5: "0.5 - 0.5 * sin(atan(t / 2)) * (1 + 0.5 * cos(atan(t / 2)) ** 2)",
}
#: The normality test as its threshold on z, shuffles for what is not normal; fewer than three folds are not tested.
TESTS = f"""diffs AS (
    SELECT {", ".join(f"b.{c}" for c in REVIEW.split(", "))}, n.baseline, b.seed, b.fold, b.score AS best, n.score AS base, b.score - n.score AS d
    FROM best b JOIN naive n USING (target, scorer, splitter, f1, f2, seed, fold)),
  s AS (
    SELECT {REVIEW}, baseline, count(*) AS n, avg(d) AS lift, avg(base) AS base, stddev_samp(d) AS sd, avg(d) / (nullif(stddev_samp(d), 0) / sqrt(count(*))) AS t,
           list_sort(list(d)) AS ds, var_pop(d) * count(*) AS ss FROM diffs GROUP BY ALL),
  w AS (SELECT *, least(list_sum(list_transform(ds, lambda x, i: x * ({_by_n(_normal_weights)})[i])) ** 2 / nullif(ss, 0), 1.0) AS w FROM s),
  chosen AS (SELECT *, CASE WHEN n < 3 THEN 'insufficient' WHEN w IS NULL OR w >= 1 THEN 'paired_t' WHEN {_by_n(_z)} <= 0 THEN 'paired_t' ELSE 'permutation' END AS test FROM w),
  odd AS (SELECT d.*, row_number() OVER (PARTITION BY {REVIEW}, baseline ORDER BY seed, fold) - 1 AS idx FROM diffs d JOIN chosen c USING ({REVIEW}, baseline) WHERE test = 'permutation'),
  pool AS (SELECT {REVIEW}, baseline, 2 * idx AS item, best AS v FROM odd UNION ALL SELECT {REVIEW}, baseline, 2 * idx + 1, base FROM odd),
  mixed AS (SELECT {REVIEW}, baseline, perm, v, row_number() OVER (PARTITION BY {REVIEW}, baseline, perm ORDER BY {v.h32("concat_ws(':', 42, perm, item)")}, item) AS pos FROM pool, range(10000) r(perm)),
  perm AS (SELECT {REVIEW}, baseline, avg((round(g, 12) >= round(lift, 12))::INT) AS p_perm
           FROM (SELECT {REVIEW}, baseline, perm, avg(v) FILTER (2 * pos <= size) - avg(v) FILTER (2 * pos > size) AS g FROM (SELECT *, count(*) OVER (PARTITION BY {REVIEW}, baseline, perm) AS size FROM mixed) GROUP BY ALL) JOIN chosen USING ({REVIEW}, baseline) GROUP BY ALL),
  draws AS (SELECT {REVIEW}, baseline, rep, {v.h32("concat_ws(':', 42, rep, draw)")} % n AS idx
            FROM (SELECT {REVIEW}, baseline, count(*) AS n FROM diffs GROUP BY ALL), range(2000) a(rep), range(5) b(draw) WHERE draw < n),
  numbered AS (SELECT *, row_number() OVER (PARTITION BY {REVIEW}, baseline ORDER BY seed, fold) - 1 AS idx FROM diffs),
  ci AS (SELECT {REVIEW}, baseline, quantile_cont(m, 0.025) AS ci_low FROM (
           SELECT {REVIEW}, baseline, rep, avg(d) AS m FROM draws JOIN numbered USING ({REVIEW}, baseline, idx) GROUP BY {REVIEW}, baseline, rep) GROUP BY ALL),
  tested AS (
    SELECT *, CASE test WHEN 'permutation' THEN p_perm WHEN 'paired_t' THEN coalesce({_by_n(T_TAIL.get)}, CASE WHEN lift > 0 THEN 0 WHEN lift < 0 THEN 1 END) END AS p,
           lift / CASE WHEN abs(base) > 1e-9 THEN abs(base) ELSE 1 END * 100 AS pct, coalesce(lift / nullif(sd, 0), 0) AS cohen
    FROM chosen JOIN ci USING ({REVIEW}, baseline) LEFT JOIN perm USING ({REVIEW}, baseline)),
  gates AS (
    SELECT {REVIEW}, bool_or(coalesce(round(p, 12) < 0.05, false)) AS g1, bool_or(round(pct, 12) >= 2) AS g2, bool_or(round(abs(cohen), 12) >= 0.2) AS g3, bool_or(round(ci_low, 12) > 0) AS g4 FROM tested GROUP BY ALL)"""

STABLE = f"""left_out AS (
    SELECT r.*, l.name AS feature, s.seed, s.fold, s.score FROM reviews r,
         LATERAL (SELECT r.f2 AS k1, r.f1 AS gone UNION ALL SELECT r.f1, r.f2) q JOIN scores s
           ON s.splitter = r.splitter AND s.y = r.y AND s.scorer = r.scorer AND s.f1 = q.k1 AND s.f2 = 0 AND s.kind = 'ridge'
         JOIN (SELECT unnest({COLUMNS}) AS name, unnest([1, 2, 3, 4, 5]) AS k) l ON l.k = q.gone WHERE r.f2 > 0 AND s.score IS NOT NULL),
  drops AS (
    SELECT {REVIEW}, feature, avg(score) AS score, any_value(fs) - avg(score) AS drop, coalesce((any_value(fs) - avg(score)) / nullif(abs(any_value(fs)), 0) * 100, 0) AS drop_pct
    FROM left_out JOIN (SELECT {REVIEW}, avg(score) AS fs FROM best GROUP BY ALL) USING ({REVIEW}) GROUP BY {REVIEW}, feature),
  placed AS (SELECT *, row_number() OVER (PARTITION BY {REVIEW} ORDER BY seed, fold) - 1 AS idx FROM best),
  boot AS (SELECT {REVIEW}, rep, {v.h32("concat_ws(':', 42, rep, draw)")} % n AS idx
           FROM (SELECT {REVIEW}, count(*) AS n FROM best GROUP BY ALL), range(2000) a(rep), range(25) b(draw) WHERE draw < n),
  low AS (SELECT {REVIEW}, quantile_cont(m, 0.025) AS ci_low FROM (
            SELECT {REVIEW}, rep, avg(score) AS m FROM boot JOIN placed USING ({REVIEW}, idx) GROUP BY {REVIEW}, rep) GROUP BY ALL),
  stable AS (
    SELECT {REVIEW}, round(stddev_pop(score), 12) <= 0.03 AS g1_stability, round(any_value(ci_low), 12) > round(any_value(bm), 12) AS g2_ci_above_baseline, coalesce(any_value(bad), 0) = 0 AS g3_lofo
    FROM best JOIN low USING ({REVIEW}) JOIN (SELECT {REVIEW}, avg(score) AS bm FROM naive WHERE baseline = 'mean' GROUP BY ALL) USING ({REVIEW})
         LEFT JOIN (SELECT {REVIEW}, count(*) FILTER (round(drop_pct, 12) > 25) AS bad FROM drops GROUP BY ALL) USING ({REVIEW}) GROUP BY {REVIEW})"""

_UPTO_SCORES = f"WITH {REQUESTS}, {ROWS}, {SCORES}"
#: Parts of a review in words, as both sides show them.
NAMED = "[{0}][f1] || CASE WHEN f2 > 0 THEN ',' || [{0}][f2] ELSE '' END AS features".format(", ".join(f"'{c}'" for c in COLUMNS))


def _shown(found: review.Review, df):
    """Rows of a middle table with target, scorer, splitter and features in place of the review's id."""
    asked = found.requests.where("status = 'ok'").select(
        F.col("review").alias("run_id"), "target", "scorer", "splitter", F.array_join("features", ",").alias("features")
    ).distinct()
    return df.join(asked, "run_id").drop("run_id")


@query(
    "j1_fitted_scores",
    f"{_UPTO_SCORES} SELECT target, scorer, splitter, {NAMED}, seed, fold, round(score, 6) AS score FROM best",
    views="v_quality",
)
def j1_fitted(spark, sf):
    """Scores of every unit that the plans ask for, fitted once however many runs share it."""
    data = {"documents": dataset(spark, sf)}
    wanted = review.wanted_units(cut_lineage(review.requests(*notes_of(spark, sf), data)))
    scores = review.score_units(wanted, data, 5, v.SEEDS).where("score is not null")
    full = review.feature_sets(wanted).where("left_out is null")
    return full.join(scores, ["fit", "scorer", "splitter"]).select(
        "target", "scorer", "splitter", F.array_join("features", ",").alias("features"), "seed", "fold", F.round("score", 6).alias("score")
    )


@query(
    "k11_fitted_gates",
    f"{_UPTO_SCORES}, {TESTS} SELECT target, scorer, splitter, {NAMED}, baseline, test, round(lift, 6) AS lift, round(p, 6) AS p_value, round(ci_low, 6) AS ci_low, round(cohen, 4) AS cohen_d FROM tested",
    views="v_quality",
)
def k11_fitted(spark, sf):
    """Each fitted unit against both naive models, by the test that its differences call for."""
    found = reviewed(spark, sf)
    return _shown(found, found.tests).select(
        "target", "scorer", "splitter", "features", "baseline", "test", F.round("lift", 6).alias("lift"),
        F.round("p_value", 6).alias("p_value"), F.round("ci_low", 6).alias("ci_low"), F.round("cohen_d", 4).alias("cohen_d"),
    )


@query(
    "l5_fitted_drops",
    f"{_UPTO_SCORES}, {STABLE} SELECT target, scorer, splitter, {NAMED}, feature, round(score, 6) AS score, round(drop_pct, 4) AS drop_pct FROM drops",
    views="v_quality",
)
def l5_fitted(spark, sf):
    """Refits of every unit without each of its features."""
    found = reviewed(spark, sf)
    return _shown(found, found.drops).select(
        "target", "scorer", "splitter", "features", "feature", F.round("score", 6).alias("score"), F.round("drop_pct", 4).alias("drop_pct")
    )


@query(
    "l12_plan_to_verdict",
    f"""{_UPTO_SCORES}, {TESTS}, {STABLE}
    SELECT run_id, target, scorer, splitter, g1, g2, g3, g4, g1_stability, g2_ci_above_baseline, g3_lofo,
      CASE WHEN task = 'clustering' THEN 'N/A' WHEN g1 IS NULL OR g1::INT + g2::INT + g3::INT + g4::INT < 2 THEN 'FAIL'
           WHEN g1::INT + g2::INT + g3::INT + g4::INT = 4 THEN 'PASS' ELSE 'WARN' END AS statistical_verdict,
      CASE WHEN task = 'clustering' THEN 'N/A' WHEN g1_stability IS NULL OR g1_stability::INT + g2_ci_above_baseline::INT + g3_lofo::INT = 0 THEN 'FAIL'
           WHEN g1_stability::INT + g2_ci_above_baseline::INT + g3_lofo::INT = 3 THEN 'PASS' ELSE 'WARN' END AS robustness_verdict
    FROM (SELECT req.run_id, req.task, req.target, req.scorer, req.splitter, g.* EXCLUDE (target, scorer, splitter, f1, f2), t.* EXCLUDE (target, scorer, splitter, f1, f2)
          FROM req LEFT JOIN gates g ON task = 'regression' AND g.target = req.target AND g.scorer = req.scorer AND g.splitter = req.splitter AND g.f1 = req.f1 AND g.f2 = req.f2
          LEFT JOIN stable t ON task = 'regression' AND t.target = req.target AND t.scorer = req.scorer AND t.splitter = req.splitter AND t.f1 = req.f1 AND t.f2 = req.f2)""",
    views="v_quality",
)
def l12_review(spark, sf):
    """Both verdicts of every run, from its plan's text on."""
    return reviewed(spark, sf).verdicts.select(
        "run_id", "target", "scorer", "splitter", "g1", "g2", "g3", "g4", "g1_stability", "g2_ci_above_baseline", "g3_lofo",
        "statistical_verdict", "robustness_verdict",
    )


# ---- slices and importance of the fitted model -------------------------------------

SLICE_FEATURES = ["junk_share", "kchars"]
CHOSEN = "(SELECT CASE WHEN abs(corr(junk_share, quality)) >= abs(corr(kchars, quality)) THEN 'junk_share' ELSE 'kchars' END FROM f)"


def _slice_labels() -> str:
    parts = ["low_33%", "mid_33%", "high_33%"]
    third = "CASE WHEN v <= q[1] THEN '{}' WHEN v <= q[2] THEN '{}' ELSE '{}' END".format(*parts)
    return f"""SELECT f.*, c AS col, 'by_' || c || '_' || {third} AS slice
        FROM (SELECT *, {CHOSEN} AS c, CASE WHEN {CHOSEN} = 'junk_share' THEN junk_share ELSE kchars END AS v FROM f) f,
             (SELECT quantile_cont(CASE WHEN {CHOSEN} = 'junk_share' THEN junk_share ELSE kchars END, [0.33, 0.67]) AS q FROM f)"""


REFITTED = f"""WITH f AS (SELECT doc_id, junk_share, n_chars / 1000.0::DOUBLE AS kchars, quality::DOUBLE AS quality FROM v_quality WHERE junk_share IS NOT NULL),
  labelled AS (
    SELECT doc_id, junk_share AS a, kchars AS b, quality AS y, col, slice FROM ({_slice_labels()})
    UNION ALL
    SELECT doc_id, junk_share, kchars, quality, 'junk_share', 'by_junk_share_' || CASE WHEN row_number() OVER (ORDER BY junk_share, doc_id) > (count(*) OVER ()) // 2 THEN 'head_50%' ELSE 'tail_50%' END FROM f),
  cells AS (SELECT *, (row_number() OVER (PARTITION BY slice, seed ORDER BY {v.h32("concat_ws(':', seed, doc_id)")}, doc_id) - 1) % 5 AS fold
    FROM labelled, (SELECT unnest([0, 1, 7, 42, 123]) AS seed)),
  tr AS (
    SELECT s.col, s.slice, s.seed, s.fold, avg(a) AS ma, avg(b) AS mb, avg(y) AS my, var_pop(a) * count(*) + 1 AS aa, var_pop(b) * count(*) + 1 AS bb,
           covar_pop(a, b) * count(*) AS ab, covar_pop(a, y) * count(*) AS ay, covar_pop(b, y) * count(*) AS b_y
    FROM (SELECT DISTINCT col, slice, seed, fold FROM cells) s JOIN cells c ON c.slice = s.slice AND c.seed = s.seed AND c.fold <> s.fold GROUP BY ALL),
  scored AS (
    SELECT col, slice, seed, fold, count(*) AS n, sqrt(avg(e * e)) AS rmse, 1 - sum(e * e) / nullif(var_pop(y) * count(*), 0) AS r2
    FROM (SELECT t.*, c.y, c.y - my - (ay * bb - b_y * ab) / (aa * bb - ab * ab) * (c.a - ma) - (b_y * aa - ay * ab) / (aa * bb - ab * ab) * (c.b - mb) AS e
          FROM tr t JOIN cells c USING (slice, seed, fold)) GROUP BY ALL)
  SELECT col AS "column", slice, sum(n) FILTER (seed = 42)::BIGINT AS n, round(avg(-rmse), 6) AS neg_root_mean_squared_error, round(avg(r2), 6) AS r2
  FROM scored GROUP BY col, slice HAVING sum(n) FILTER (seed = 42) >= 30"""


@query("l6_refitted_slices", REFITTED, views="v_quality")
def l6_refitted(spark, sf):
    """Ridge fitted anew inside thirds of the strongest feature and halves of the first one."""
    found = robustness.refitted_slices(dataset(spark, sf).rows, "doc_id", SLICE_FEATURES, "quality")
    return found.select("column", "slice", "n", F.round("neg_root_mean_squared_error", 6).alias("neg_root_mean_squared_error"), F.round("r2", 6).alias("r2"))


SHUFFLED, REPEATS = ["junk_share", "kchars", "day"], 10


def _cramer(column: int) -> str:
    """Coefficient of a feature in the 3 x 3 normal equations; -1 is the determinant of the system."""
    names = [["c11", "c12", "c13"], ["c12", "c22", "c23"], ["c13", "c23", "c33"]]
    right = ["y1", "y2", "y3"]
    m = [[right[i] if j == column else names[i][j] for j in range(3)] for i in range(3)]
    return (f"({m[0][0]} * ({m[1][1]} * {m[2][2]} - {m[1][2]} * {m[2][1]}) - {m[0][1]} * ({m[1][0]} * {m[2][2]} - {m[1][2]} * {m[2][0]})"
            f" + {m[0][2]} * ({m[1][0]} * {m[2][1]} - {m[1][1]} * {m[2][0]}))")


def _moved(feature: int) -> str:
    values = ", ".join(f"g.x{i} AS x{i}" if i == feature else f"t.x{i} AS x{i}" for i in (1, 2, 3))
    return f"""SELECT '{SHUFFLED[feature - 1]}' AS feature, t.seed, repeat, t.y, {values} FROM ranked t, range({REPEATS}) r(repeat), ranked g
      WHERE g.seed = t.seed AND g.p = (t.p + 1 + {v.h32("concat_ws(':', 'shift', t.seed, repeat)")} % greatest(t.n - 1, 1)) % t.n"""


FITTED_IMPORTANCE = f"""WITH f AS (SELECT doc_id, junk_share AS x1, n_chars / 1000.0::DOUBLE AS x2, (doc_id % 30)::DOUBLE AS x3, quality::DOUBLE AS y FROM v_quality WHERE junk_share IS NOT NULL),
  mo AS (SELECT avg(x1) AS m1, avg(x2) AS m2, avg(x3) AS m3, avg(y) AS my, var_pop(x1) * count(*) + 1 AS c11, var_pop(x2) * count(*) + 1 AS c22, var_pop(x3) * count(*) + 1 AS c33,
      covar_pop(x1, x2) * count(*) AS c12, covar_pop(x1, x3) * count(*) AS c13, covar_pop(x2, x3) * count(*) AS c23,
      covar_pop(x1, y) * count(*) AS y1, covar_pop(x2, y) * count(*) AS y2, covar_pop(x3, y) * count(*) AS y3 FROM f),
  line AS (SELECT *, {_cramer(0)} / {_cramer(-1)} AS b1, {_cramer(1)} / {_cramer(-1)} AS b2, {_cramer(2)} / {_cramer(-1)} AS b3 FROM mo),
  ranked AS (SELECT *, row_number() OVER (PARTITION BY seed ORDER BY {v.h32("concat_ws(':', 'order', seed, doc_id)")}, doc_id) - 1 AS p, count(*) OVER (PARTITION BY seed) AS n
      FROM f, (SELECT unnest([0, 1, 7, 42, 123]) AS seed)),
  base AS (SELECT 1 - sum((y - my - b1 * (x1 - m1) - b2 * (x2 - m2) - b3 * (x3 - m3)) ** 2) / (var_pop(y) * count(*)) AS r2 FROM f, line),
  moved AS ({" UNION ALL ".join(_moved(i) for i in (1, 2, 3))}),
  scored AS (SELECT feature, seed, repeat, 1 - sum((y - my - b1 * (x1 - m1) - b2 * (x2 - m2) - b3 * (x3 - m3)) ** 2) / (var_pop(y) * count(*)) AS r2
      FROM moved, line GROUP BY feature, seed, repeat),
  importance AS (SELECT feature, seed, avg(base.r2 - scored.r2) AS importance FROM scored, base GROUP BY feature, seed)"""


def fitted_importance(spark, sf):
    return robustness.fitted_importance(dataset(spark, sf).rows, "doc_id", SHUFFLED, "quality", REPEATS, v.SEEDS)


@query("l9_fitted_importance", f"{FITTED_IMPORTANCE} SELECT feature, seed, round(importance, 6) AS importance FROM importance", views="v_quality")
def l9_fitted(spark, sf):
    """Loss of R2 when a feature of the fitted ridge model is shuffled."""
    return fitted_importance(spark, sf).select("feature", "seed", F.round("importance", 6).alias("importance"))


@query(
    "l10_fitted_top3",
    f"""{FITTED_IMPORTANCE}, l AS (SELECT seed, string_agg(feature, ',' ORDER BY k) AS top3 FROM (
          SELECT seed, feature, row_number() OVER (PARTITION BY seed ORDER BY round(importance, 9) DESC, feature) AS k FROM importance) WHERE k <= 3 GROUP BY seed)
        SELECT top3, count(*) AS n_match, (SELECT count(*) FROM l) AS n_seeds FROM l GROUP BY top3 ORDER BY count(*) DESC, min(seed) LIMIT 1""",
    views="v_quality",
)
def l10_fitted(spark, sf):
    return robustness.top3_stability(fitted_importance(spark, sf).withColumn("importance", F.round("importance", 9)))
