"""Queries: trust metrics, verdict rules, publish gate, registry."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import registry, trust
from ..operators.profile import long_aggregate
from ..session import work_folder
from ..sources import sinks
from ..sources.tables import read_table
from . import views as v
from .catalog import query

# ---- numbers ------------------------------------------------------------------

REPORT = """concat('On ', substr(cast(o_orderdate AS STRING), 1, 10), ' order ', cast(o_orderkey AS STRING), ' scored ',
  cast(o_orderkey % 1000 / 1000.0 AS DECIMAL(5,3)), ' or ', cast(o_custkey % 100 AS STRING), '% in ', cast(o_orderkey % 70 AS STRING), 'ms, delta -',
  cast(o_orderkey % 9 AS STRING), '.5')"""


@query(
    "o1_number_tokens",
    """SELECT o_orderkey AS run_id, pos::INT AS pos, cited FROM (
         SELECT o_orderkey, unnest([0, 1, 2, 3, 4]) AS pos, unnest([o_orderkey::DOUBLE, ((o_orderkey % 1000) / 1000.0)::DECIMAL(5,3)::DOUBLE,
                (o_custkey % 100)::DOUBLE, (o_orderkey % 70)::DOUBLE, -(o_orderkey % 9)::DOUBLE - 0.5]) AS cited FROM orders)""",
)
def o1(spark, sf):
    reports = read_table(spark, sf, "orders").selectExpr("o_orderkey AS run_id", f"{REPORT} AS text")
    return trust.number_tokens(reports, "run_id", "text").select("run_id", "pos", "cited")


MATCHED = """SELECT c.run_id, c.cited, count(DISTINCT c.k) AS n_cited,
      bool_or(abs(c.cited - a.actual) <= 0.02 * abs(a.actual)) AS supported
    FROM (SELECT *, row_number() OVER () AS k FROM v_numbers) c JOIN v_numbers a USING (run_id) GROUP BY c.run_id, c.cited"""


@query(
    "o2_grounded_numeric",
    f"""SELECT run_id, sum(n_cited)::BIGINT AS n_cited, coalesce(sum(n_cited) FILTER (supported), 0)::BIGINT AS n_supported,
               round(coalesce(sum(n_cited) FILTER (supported), 0) / sum(n_cited)::DOUBLE * 100, 6) AS grounded_numeric
        FROM ({MATCHED}) GROUP BY run_id""",
    views="v_numbers",
)
def o2(spark, sf):
    n = v.cited_and_actual(spark, sf)
    g = trust.grounded_numeric(n.select("run_id", "cited"), n.select("run_id", "actual"))
    return g.withColumn("grounded_numeric", F.round("grounded_numeric", 6))


@query(
    "o3_number_comparison",
    """SELECT run_id, cited, round(actual, 4) AS actual, round(d, 4) AS delta_pct,
              CASE WHEN d <= 2 THEN 'OK' WHEN d <= 5 THEN 'PARTIAL' ELSE 'MISMATCH' END AS verdict
       FROM (SELECT run_id, cited, actual, abs(cited - actual) / abs(actual) * 100 AS d FROM (
             SELECT c.run_id, c.cited, arg_min(a.actual, (abs(c.cited - a.actual), a.actual)) AS actual
             FROM v_numbers c JOIN v_numbers a USING (run_id) GROUP BY ALL))""",
    views="v_numbers",
)
def o3(spark, sf):
    n = v.cited_and_actual(spark, sf)
    c = trust.number_comparison(n.select("run_id", "cited"), n.select("run_id", "actual"))
    return c.select("run_id", "cited", F.round("actual", 4).alias("actual"), F.round("delta_pct", 4).alias("delta_pct"), "verdict")


# ---- stability ----------------------------------------------------------------

SEED_SCORES = """SELECT o_custkey AS run_id, (o_orderkey % 3)::INT AS seed, 0.8 + (o_orderkey % 50) / 2000.0::DOUBLE AS score FROM orders"""


def seed_scores(spark, sf):
    return read_table(spark, sf, "orders").selectExpr(
        "o_custkey AS run_id", "cast(o_orderkey % 3 AS INT) AS seed", "0.8D + (o_orderkey % 50) / 2000.0D AS score"
    )


STABILITY = f"""SELECT run_id, count(*) AS n_runs, avg(m) AS stability_mean, stddev_samp(m) AS stability_std,
      CASE WHEN round(stddev_samp(m), 12) <= 0.01 THEN 'OK' WHEN round(stddev_samp(m), 12) <= 0.02 THEN 'WARN' ELSE 'FAIL' END AS cv_stability
    FROM (SELECT run_id, seed, avg(score) AS m FROM ({SEED_SCORES}) GROUP BY ALL) GROUP BY run_id"""


@query(
    "o4_cv_stability",
    f"""SELECT run_id, n_runs, round(stability_mean, 9) AS stability_mean, round(stability_std, 9) AS stability_std, cv_stability FROM ({STABILITY})""",
)
def o4(spark, sf):
    s = trust.cv_stability(seed_scores(spark, sf))
    return s.select("run_id", "n_runs", F.round("stability_mean", 9).alias("stability_mean"),
                    F.round("stability_std", 9).alias("stability_std"), "cv_stability")


@query(
    "o5_metric_quote",
    """SELECT o_custkey AS run_id, 'AUC ' || format('{:.4f}', max(o_orderkey % 1000) / 1000.0::DOUBLE) || ' ± '
              || format('{:.4f}', (count(*) % 10) / 100.0::DOUBLE) AS quote FROM orders GROUP BY o_custkey""",
)
def o5(spark, sf):
    per = read_table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("run_id")).agg(
        (F.max(F.col("o_orderkey") % 1000) / 1000.0).alias("best"), ((F.count("*") % 10) / 100.0).alias("std")
    )
    return per.select("run_id", trust.metric_quote(F.lit("AUC"), F.col("best"), F.col("std")).alias("quote"))


CLOCK = "1999-02-01"


@query(
    "o6_data_trust_signals",
    f"""SELECT run_id, days <= 30 AS fresh, null_share < 0.05 AS complete, run_id % 3 <> 0 AS consistent, key_null < 0.02 AS keys_filled,
               CASE (days <= 30)::INT + (null_share < 0.05)::INT + (run_id % 3 <> 0)::INT + (key_null < 0.02)::INT
                    WHEN 4 THEN 'High' WHEN 3 THEN 'Medium' ELSE 'Low' END AS data_trust
        FROM (SELECT o_custkey AS run_id, date_diff('day', max(o_orderdate)::DATE, DATE '{CLOCK}') AS days,
                     avg((o_totalprice < 20000)::INT) AS null_share, avg((o_orderkey % 40 = 0)::INT) AS key_null FROM orders GROUP BY o_custkey)""",
)
def o6(spark, sf):
    """Signals per customer: age of the last order, blanked prices, blanked keys."""
    per = read_table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("run_id")).agg(
        F.datediff(F.lit(CLOCK).cast("date"), F.max("o_orderdate").cast("date")).alias("days"),
        F.avg((F.col("o_totalprice") < 20000).cast("double")).alias("null_share"),
        F.avg((F.col("o_orderkey") % 40 == 0).cast("double")).alias("key_null"),
    )
    signals = trust.data_trust_signals(
        F.col("days"), F.col("null_share"), F.col("run_id") % 3 != 0, F.col("key_null")
    )
    return per.select("run_id", *signals).withColumn("data_trust", trust.data_trust())


@query(
    "o6_consistency",
    """SELECT 'l_quantity' AS "column", (SELECT max(l_quantity) FROM lineitem) = (SELECT max(l_quantity) FROM lineitem WHERE l_linenumber < 4)
              AND (SELECT min(l_quantity) FROM lineitem) = (SELECT min(l_quantity) FROM lineitem WHERE l_linenumber < 4) AS same
       UNION ALL SELECT 'l_extendedprice', (SELECT max(l_extendedprice) FROM lineitem) = (SELECT max(l_extendedprice) FROM lineitem WHERE l_linenumber < 4)
              AND (SELECT min(l_extendedprice) FROM lineitem) = (SELECT min(l_extendedprice) FROM lineitem WHERE l_linenumber < 4)""",
)
def o6_consistency(spark, sf):
    """Ranges and types now against a stored description of an older slice."""
    li = read_table(spark, sf, "lineitem").select("l_quantity", "l_extendedprice", "l_linenumber")
    cols = ["l_quantity", "l_extendedprice"]
    measure = {"min": lambda c: F.min(c), "max": lambda c: F.max(c), "dtype": lambda c: F.max(F.typeof(c))}
    now, old = long_aggregate(li, cols, measure), long_aggregate(li.where("l_linenumber < 4"), cols, measure)
    return trust.consistent_with(now, old)


# ---- rules over votes ------------------------------------------------------------


@query(
    "o8_confidence",
    """SELECT run_id, sum(CASE vote WHEN 'YES' THEN 1.0 WHEN 'PARTIAL' THEN 0.5 ELSE 0 END)::DOUBLE / 4 * 100 AS confidence
       FROM v_votes GROUP BY run_id""",
    views="v_votes",
)
def o8(spark, sf):
    checks = v.votes(spark, sf).withColumn(
        "result", F.when(F.col("vote") == "YES", "PASS").when(F.col("vote") == "NO", "FAIL").otherwise("PARTIAL")
    )
    return trust.confidence(checks)


CODE_PANEL = f"""SELECT s.run_id, cv_stability, stability_mean, conf, dt, grounded,
      CASE WHEN cv_stability = 'FAIL' OR conf < 60 OR dt = 'Low' THEN 'FAIL'
           WHEN cv_stability = 'WARN' OR conf < 80 OR dt = 'Medium' THEN 'WARN' ELSE 'PASS' END AS code_verdict
    FROM (SELECT *, 50 + run_id % 11 * 5.0::DOUBLE AS conf, CASE run_id % 4 WHEN 0 THEN 'Low' WHEN 1 THEN 'Medium' ELSE 'High' END AS dt,
                 60 + run_id % 5 * 10.0::DOUBLE AS grounded FROM ({STABILITY})) s"""


def code_panel(spark, sf):
    base = trust.cv_stability(seed_scores(spark, sf)).selectExpr(
        "*", "50 + run_id % 11 * 5.0D AS conf",
        "CASE run_id % 4 WHEN 0 THEN 'Low' WHEN 1 THEN 'Medium' ELSE 'High' END AS dt", "60 + run_id % 5 * 10.0D AS grounded",
    )
    return base.withColumn("code_verdict", trust.code_verdict(F.col("cv_stability"), F.col("conf"), F.col("dt")))


@query("o9_code_verdict", f"SELECT run_id, code_verdict FROM ({CODE_PANEL})")
def o9(spark, sf):
    return code_panel(spark, sf).select("run_id", "code_verdict")


CLAIMS = """SELECT run_id, count(*) AS n_votes, round(avg(CASE vote WHEN 'YES' THEN 1.0::DOUBLE WHEN 'PARTIAL' THEN 0.5 ELSE 0 END) * 100, 1) AS grounded_claims
    FROM v_votes GROUP BY run_id"""


@query(
    "o10_grounded_claims",
    f"SELECT *, round(100 - grounded_claims, 1) AS hallucination_risk FROM ({CLAIMS})",
    views="v_votes",
)
def o10(spark, sf):
    return trust.grounded_claims(v.votes(spark, sf))


PAIR_VOTES = """SELECT run_id, CASE WHEN vote = 'NO' AND event_type = 'error' THEN 'INCONSISTENT' WHEN vote = 'PARTIAL' THEN 'PARTIAL' ELSE 'CONSISTENT' END AS vote FROM v_votes"""
CONSISTENCY = f"""SELECT run_id, CASE max(CASE vote WHEN 'INCONSISTENT' THEN 2 WHEN 'PARTIAL' THEN 1 ELSE 0 END)
      WHEN 2 THEN 'INCONSISTENT' WHEN 1 THEN 'PARTIAL' ELSE 'CONSISTENT' END AS insight_consistency FROM ({PAIR_VOTES}) GROUP BY run_id"""


def pair_votes(spark, sf):
    bad = (F.col("vote") == "NO") & (F.col("event_type") == "error")
    return v.votes(spark, sf).select(
        "run_id",
        F.when(bad, "INCONSISTENT").when(F.col("vote") == "PARTIAL", "PARTIAL").otherwise("CONSISTENT").alias("vote"),
    )


@query("o12_insight_consistency", CONSISTENCY, views="v_votes")
def o12(spark, sf):
    return trust.insight_consistency(pair_votes(spark, sf))


SEMANTIC = f"""SELECT run_id, n_votes, grounded_claims, 100 - grounded_claims AS risk, insight_consistency,
      CASE WHEN grounded_claims < 60 OR insight_consistency = 'INCONSISTENT' THEN 'FAIL'
           WHEN grounded_claims < 80 OR insight_consistency = 'PARTIAL' THEN 'WARN' ELSE 'PASS' END AS llm_verdict
    FROM ({CLAIMS}) JOIN ({CONSISTENCY}) USING (run_id)"""


def semantic_panel(spark, sf):
    both = trust.grounded_claims(v.votes(spark, sf)).join(trust.insight_consistency(pair_votes(spark, sf)), "run_id")
    return both.withColumn("llm_verdict", trust.semantic_verdict(F.col("grounded_claims"), F.col("insight_consistency")))


@query("o13_semantic_verdict", f"SELECT run_id, llm_verdict FROM ({SEMANTIC})", views="v_votes")
def o13(spark, sf):
    return semantic_panel(spark, sf).select("run_id", "llm_verdict")


@query(
    "o14_code_backtrack",
    f"""SELECT run_id, CASE WHEN code_verdict = 'FAIL' THEN 'rerun analysis-cycle' WHEN dt = 'Low' THEN 'reload data'
               WHEN cv_stability = 'FAIL' THEN 'change model' WHEN grounded < 70 THEN 'review report numbers'
               ELSE 'continue to qa-reviewer' END AS advice FROM ({CODE_PANEL})""",
)
def o14(spark, sf):
    p = code_panel(spark, sf)
    return p.select("run_id", trust.code_backtrack(
        F.col("code_verdict"), F.col("dt"), F.col("cv_stability"), F.col("grounded")).alias("advice"))


@query(
    "o14_semantic_backtrack",
    f"""SELECT run_id, CASE WHEN llm_verdict = 'FAIL' THEN 'rewrite insights in hypothesis-eda' WHEN risk >= 40 THEN 'rerun analysis-cycle and rewrite report'
               WHEN insight_consistency = 'INCONSISTENT' THEN 'return to hypothesis-eda' ELSE 'continue to trust-metrics-code' END AS advice FROM ({SEMANTIC})""",
    views="v_votes",
)
def o14_semantic(spark, sf):
    p = semantic_panel(spark, sf)
    return p.select("run_id", trust.semantic_backtrack(
        F.col("llm_verdict"), F.col("hallucination_risk"), F.col("insight_consistency")).alias("advice"))


QA = f"""SELECT run_id, list_filter([CASE WHEN round(abs(best - stability_mean), 12) > 0.01 THEN 'score not reproduced' END,
        CASE WHEN round(spread, 12) < 0.02 THEN 'hypotheses hardly differ' END, CASE WHEN grounded < 90 THEN 'numbers not grounded' END,
        CASE WHEN insight_consistency = 'INCONSISTENT' THEN 'insights contradict' END,
        CASE WHEN (llm_verdict = 'PASS' AND code_verdict = 'FAIL') OR (llm_verdict = 'FAIL' AND code_verdict = 'PASS') THEN 'verdicts oppose' END],
        lambda x: x IS NOT NULL) AS flags, llm_verdict, code_verdict
    FROM ({SEMANTIC}) JOIN ({CODE_PANEL}) USING (run_id)
    JOIN (SELECT run_id, max(score) AS best, max(score) - min(score) AS spread FROM ({SEED_SCORES}) GROUP BY run_id) USING (run_id)"""


def qa_rows(spark, sf):
    best = seed_scores(spark, sf).groupBy("run_id").agg(
        F.max("score").alias("best"), (F.max("score") - F.min("score")).alias("spread")
    )
    joined = semantic_panel(spark, sf).join(code_panel(spark, sf), "run_id").join(best, "run_id")
    flags = trust.qa_flags(*[F.col(c) for c in (
        "best", "stability_mean", "spread", "grounded", "insight_consistency", "llm_verdict", "code_verdict")])
    return joined.select("run_id", flags.alias("flags"), "llm_verdict", "code_verdict")


@query("o15_qa_flags", f"SELECT run_id, array_to_string(flags, ',') AS flags FROM ({QA})", views="v_votes")
def o15(spark, sf):
    return qa_rows(spark, sf).select("run_id", F.concat_ws(",", "flags").alias("flags"))


@query(
    "o16_conflict_result",
    """SELECT run_id, CASE WHEN n = 0 THEN 'PASS' WHEN n = 1 THEN 'PARTIAL' ELSE 'FAIL' END AS result
       FROM (SELECT run_id, count(*) FILTER (vote = 'NO' AND event_type = 'signup') AS n FROM v_votes GROUP BY run_id)""",
    views="v_votes",
)
def o16(spark, sf):
    n = F.count_if((F.col("vote") == "NO") & (F.col("event_type") == "signup"))
    per = v.votes(spark, sf).groupBy("run_id").agg(n.alias("n"))
    return per.select("run_id", trust.conflict_result(F.col("n")).alias("result"))


QA_VERDICT = f"""SELECT run_id, llm_verdict, code_verdict,
      CASE WHEN len(flags) > 3 OR run_id % 13 = 0 OR (llm_verdict = 'FAIL' AND run_id % 2 = 0) OR code_verdict = 'FAIL' THEN 'FAIL'
           WHEN run_id % 3 >= 2 OR ((llm_verdict = 'WARN') <> (code_verdict = 'WARN')) THEN 'WARN' ELSE 'PASS' END AS qa_verdict
    FROM ({QA})"""


def qa_verdicts(spark, sf):
    """The rule with its inputs varied over runs, so that every branch is taken."""
    r = qa_rows(spark, sf)
    n_flags = F.greatest(F.size("flags") - 3, F.lit(0))
    semantic = F.when((F.col("llm_verdict") == "FAIL") & (F.col("run_id") % 2 != 0), "PASS").otherwise(F.col("llm_verdict"))
    verdict = trust.qa_verdict(
        n_flags, (F.col("run_id") % 13 == 0).cast("int"), F.col("run_id") % 3, semantic, F.col("code_verdict")
    )
    return r.select("run_id", "llm_verdict", "code_verdict", verdict.alias("qa_verdict"))


@query("o17_qa_verdict", f"SELECT run_id, qa_verdict FROM ({QA_VERDICT})", views="v_votes")
def o17(spark, sf):
    return qa_verdicts(spark, sf).select("run_id", "qa_verdict")


LAYERS = """SELECT o_custkey AS run_id, l AS layer, CASE WHEN min((o_orderkey + l * 7) % 10) = 0 AND (o_custkey + l) % 5 = 0 THEN 'FAIL'
      WHEN (o_custkey + l) % 4 = 0 THEN 'WARN' ELSE 'PASS' END AS verdict
    FROM orders, (SELECT unnest([1, 2, 3, 4]) AS l) GROUP BY o_custkey, l"""


def layer_rows(spark, sf):
    rows = read_table(spark, sf, "orders").select("o_custkey", "o_orderkey", F.explode(F.array(*[F.lit(i) for i in (1, 2, 3, 4)])).alias("layer"))
    return rows.groupBy(F.col("o_custkey").alias("run_id"), "layer").agg(
        F.min((F.col("o_orderkey") + F.col("layer") * 7) % 10).alias("m")
    ).select(
        "run_id", "layer",
        F.when((F.col("m") == 0) & ((F.col("run_id") + F.col("layer")) % 5 == 0), "FAIL")
        .when((F.col("run_id") + F.col("layer")) % 4 == 0, "WARN").otherwise("PASS").alias("verdict"),
    )


@query(
    "o19_layered_verdict",
    f"""WITH e AS (SELECT run_id, layer, CASE WHEN coalesce(max((verdict = 'FAIL' AND layer < 4)::INT) OVER (PARTITION BY run_id ORDER BY layer
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) = 1 THEN 'NOT_RUN'
                     WHEN layer = 4 AND verdict = 'FAIL' THEN 'WARN' ELSE verdict END AS x FROM ({LAYERS}))
        SELECT run_id, max(x) FILTER (layer = 1) AS r1, max(x) FILTER (layer = 2) AS r2, max(x) FILTER (layer = 3) AS r3, max(x) FILTER (layer = 4) AS r4,
               CASE WHEN bool_or(x = 'FAIL') THEN 'FAIL' WHEN bool_or(x = 'WARN') THEN 'WARN' ELSE 'PASS' END AS overall
        FROM e GROUP BY run_id""",
)
def o19(spark, sf):
    return trust.layered(layer_rows(spark, sf))


# ---- gate, panel, registry ------------------------------------------------------------

KIND = """CASE o_orderkey % 11 WHEN 0 THEN 'plan' WHEN 1 THEN 'kaggle-discover' WHEN 2 THEN 'setup' WHEN 3 THEN 'hypothesis-eda'
  WHEN 4 THEN 'analysis-cycle' WHEN 5 THEN 'report' WHEN 6 THEN 'trust-metrics-llm' WHEN 7 THEN 'trust-metrics-code'
  WHEN 8 THEN 'qa-review' WHEN 9 THEN 'head-of-data-decision' ELSE 'other' END"""
DECISION = """CASE c_custkey % 5 WHEN 0 THEN 'PUBLISH' WHEN 1 THEN 'REVISE-LLM' WHEN 2 THEN 'REVISE-Code' WHEN 3 THEN 'ABORT' ELSE 'PUBLISH' END"""
ARTIFACTS = f"SELECT o_custkey AS goal, {KIND} AS kind FROM orders"
DECISIONS = f"SELECT c_custkey AS goal, {DECISION} AS decision FROM customer WHERE c_custkey % 7 <> 0"


def artifacts(spark, sf):
    return read_table(spark, sf, "orders").selectExpr("o_custkey AS goal", f"{KIND} AS kind")


def decisions(spark, sf):
    return read_table(spark, sf, "customer").where("c_custkey % 7 <> 0").selectExpr(
        "c_custkey AS goal", f"{DECISION} AS decision"
    )


@query(
    "o20_publish_gate",
    f"""SELECT goal FROM ({ARTIFACTS}) WHERE kind IN ('trust-metrics-llm', 'trust-metrics-code', 'qa-review', 'head-of-data-decision')
          AND goal IN (SELECT goal FROM ({DECISIONS}) WHERE decision = 'PUBLISH')
        GROUP BY goal HAVING count(DISTINCT kind) = 4""",
)
def o20(spark, sf):
    return registry.publishable(artifacts(spark, sf), decisions(spark, sf))


@query(
    "o21_trust_panel",
    f"""SELECT coalesce(s.run_id, c.run_id, q.run_id) AS goal, s.llm_verdict, c.code_verdict, q.qa_verdict
        FROM (SELECT run_id, llm_verdict FROM ({SEMANTIC}) WHERE run_id % 4 <> 0) s
        FULL JOIN (SELECT run_id, code_verdict FROM ({CODE_PANEL}) WHERE run_id % 5 <> 0) c ON s.run_id = c.run_id
        FULL JOIN (SELECT run_id, qa_verdict FROM ({QA_VERDICT})) q ON q.run_id = coalesce(s.run_id, c.run_id)""",
    views="v_votes",
)
def o21(spark, sf):
    s = semantic_panel(spark, sf).where("run_id % 4 <> 0").selectExpr("run_id AS goal", "llm_verdict")
    c = code_panel(spark, sf).where("run_id % 5 <> 0").selectExpr("run_id AS goal", "code_verdict")
    q = qa_verdicts(spark, sf).selectExpr("run_id AS goal", "qa_verdict")
    return trust.trust_panel(s, c, q)


# plan files: dated for even orders, plain names for the rest
PLAN_NAME = """CASE WHEN o_orderkey % 2 = 0 THEN concat(replace(substr(cast(o_orderdate AS STRING), 1, 10), '-', ''), '-goal', cast(o_custkey AS STRING), '.md')
  ELSE concat('goal', cast(o_custkey AS STRING), '.md') END"""
PLAN_SQL = """SELECT CASE WHEN o_orderkey % 2 = 0 THEN strftime(o_orderdate, '%Y%m%d') ELSE '00000000' END AS date,
      'goal' || o_custkey::VARCHAR AS goal, o_orderkey, o_custkey FROM orders"""


def plan_files(spark, sf):
    date, goal = registry.plan_identity(F.col("name"))
    names = read_table(spark, sf, "orders").selectExpr("o_orderkey", "o_custkey", f"{PLAN_NAME} AS name")
    return names.select(date.alias("date"), goal.alias("goal"), "o_orderkey", "o_custkey")


@query("o22_plan_identity", f"SELECT o_orderkey, date, goal FROM ({PLAN_SQL})")
def o22_names(spark, sf):
    return plan_files(spark, sf).select("o_orderkey", "date", "goal")


def goal_entries(spark, sf):
    """Candidates with report maps: an order in five has an html, one in three a notebook."""
    plans = plan_files(spark, sf)
    ext = F.explode(
        F.array_compact(
            F.array(
                F.when(F.col("o_orderkey") % 5 == 0, F.lit("html")), F.when(F.col("o_orderkey") % 3 == 0, F.lit("ipynb"))
            )
        )
    ).alias("ext")
    reports = plans.select("goal", "date", ext).withColumn(
        "path", F.concat(F.lit("docs/reports/"), "date", F.lit("-"), "goal", F.lit("."), "ext")
    )
    return registry.report_map(reports)


def known_registry(spark, sf):
    """Goals of every fourth customer are registered already."""
    return read_table(spark, sf, "customer").where("c_custkey % 4 = 0").selectExpr(
        "concat('goal', cast(c_custkey AS STRING)) AS goal", "'20200101' AS date",
        "map('md', concat('docs/reports/20200101-goal', cast(c_custkey AS STRING), '.md')) AS reports",
    )


CANDIDATES = f"""SELECT goal, date, bool_or(o_orderkey % 5 = 0) AS html, bool_or(o_orderkey % 3 = 0) AS ipynb
    FROM ({PLAN_SQL}) GROUP BY ALL HAVING html OR ipynb"""
UPSERTED = f"""SELECT 'goal' || c_custkey::VARCHAR AS goal, '20200101' AS date, 'md' AS kinds FROM customer WHERE c_custkey % 4 = 0
    UNION ALL SELECT goal, min(date), arg_min(concat_ws(',', CASE WHEN html THEN 'html' END, CASE WHEN ipynb THEN 'ipynb' END), date)
    FROM ({CANDIDATES}) WHERE goal NOT IN (SELECT 'goal' || c_custkey::VARCHAR FROM customer WHERE c_custkey % 4 = 0) GROUP BY goal"""


@query("o22_registry_upsert", UPSERTED)
def o22(spark, sf):
    """The registry as a table in the shared folder: written once, updated twice."""
    folder = work_folder(spark, "registry")
    sinks.write_table(registry.upsert(known_registry(spark, sf), goal_entries(spark, sf)), folder)
    again = registry.upsert(spark.read.parquet(folder), goal_entries(spark, sf))
    return again.select("goal", "date", F.concat_ws(",", F.array_sort(F.map_keys("reports"))).alias("kinds"))


@query(
    "o23_verdict_fallback",
    """SELECT c_custkey AS goal, coalesce(CASE WHEN c_custkey % 3 = 0 THEN 'PUBLISH' END, 'UNKNOWN') AS decision,
              CASE WHEN c_custkey % 3 = 0 THEN 'PASS' WHEN c_custkey % 2 = 0 THEN 'WARN' ELSE 'UNKNOWN' END AS qa_verdict,
              CASE WHEN c_custkey % 3 = 0 THEN '2024-01-01' ELSE '' END AS decided_at FROM customer""",
)
def o23(spark, sf):
    c = read_table(spark, sf, "customer").selectExpr("c_custkey AS goal")
    d = c.where("goal % 3 = 0").selectExpr(
        "goal", "'PUBLISH' AS decision", "'2024-01-01' AS decided_at", "'PASS' AS qa_verdict", "'PASS' AS llm_verdict", "'PASS' AS code_verdict"
    )
    q = c.where("goal % 2 = 0").selectExpr("goal", "'WARN' AS qa_verdict", "'WARN' AS llm_verdict", "'WARN' AS code_verdict")
    return registry.with_verdicts(c, d, q).select("goal", "decision", "qa_verdict", "decided_at")


@query(
    "o24_registry_integrity",
    """SELECT 'goal' || c_custkey::VARCHAR AS goal, CASE WHEN c_custkey % 9 = 0 THEN 'wrong version' ELSE 'no report file' END AS violation
       FROM customer WHERE c_custkey % 4 = 0 AND (c_custkey % 9 = 0 OR c_custkey % 8 = 0)""",
)
def o24(spark, sf):
    reg = known_registry(spark, sf).withColumn(
        "version", F.when(F.substring("goal", 5, 20).cast("bigint") % 9 == 0, 2).otherwise(1)
    )
    files = read_table(spark, sf, "customer").where("c_custkey % 8 <> 0").selectExpr(
        "concat('docs/reports/20200101-goal', cast(c_custkey AS STRING), '.md') AS path"
    )
    return registry.integrity_violations(reg, files)


@query(
    "o25_reusable",
    """SELECT event_id, epoch(TIMESTAMP '2024-01-15 12:00:00')::BIGINT - floor(epoch(ts))::BIGINT BETWEEN 0 AND 3600 AS reuse FROM events""",
)
def o25(spark, sf):
    ev = read_table(spark, sf, "events").select("event_id", "ts")
    return trust.reusable(ev, "event_id", "ts", F.lit("2024-01-15 12:00:00")).select("event_id", "reuse")


@query(
    "o26_stage_status",
    f"""WITH h AS (SELECT goal, bool_or(kind = 'plan') AS pl, bool_or(kind = 'kaggle-discover') AS ka, bool_or(kind = 'setup') AS se,
            bool_or(kind = 'hypothesis-eda') AS ed, bool_or(kind = 'analysis-cycle') AS cy, bool_or(kind = 'report') AS re,
            bool_or(kind = 'trust-metrics-llm') AS tl, bool_or(kind = 'trust-metrics-code') AS tc, bool_or(kind = 'qa-review') AS qa,
            bool_or(kind = 'head-of-data-decision') AS hd FROM ({ARTIFACTS}) GROUP BY goal)
        SELECT goal, (pl::INT + ka::INT + se::INT + ed::INT + cy::INT + re::INT + tl::INT + tc::INT + qa::INT + hd::INT) AS steps_done,
               CASE WHEN NOT pl THEN 'define-analysis' WHEN NOT ka THEN 'kaggle-discover' WHEN NOT se THEN 'setup'
                    WHEN NOT ed THEN 'hypothesis-eda' WHEN NOT cy THEN 'analysis-cycle'
                    WHEN NOT tl AND NOT tc THEN 'trust-metrics-llm + trust-metrics-code' WHEN NOT tc THEN 'trust-metrics-code'
                    WHEN NOT tl THEN 'trust-metrics-llm' WHEN NOT qa THEN 'qa-reviewer' WHEN NOT hd OR decision IS NULL THEN 'head-of-data'
                    WHEN decision = 'PUBLISH' AND NOT re THEN 'verify-report' WHEN decision = 'PUBLISH' THEN 'done'
                    WHEN decision = 'REVISE-LLM' THEN 'back to hypothesis-eda' WHEN decision = 'REVISE-Code' THEN 'back to analysis-cycle'
                    ELSE 'cancelled' END AS next_step
        FROM h LEFT JOIN ({DECISIONS}) USING (goal)""",
)
def o26(spark, sf):
    return registry.stage_status(artifacts(spark, sf), decisions(spark, sf))


@query(
    "o27_choose_datasets",
    """SELECT ref, usability, n_rows FROM (
         SELECT 'ds-' || o_custkey::VARCHAR AS ref, round(avg(o_totalprice) / 40000, 2) AS usability, count(*) * 40 AS n_rows,
                bool_or(o_orderpriority = '1-URGENT') AS has_target, CASE WHEN o_custkey % 4 = 0 THEN 'json' ELSE 'csv' END AS format
         FROM orders GROUP BY o_custkey)
       WHERE usability >= 7 AND n_rows >= 500 AND has_target AND format = 'csv' ORDER BY usability DESC, n_rows DESC, ref LIMIT 5""",
)
def o27(spark, sf):
    """A catalog of one dataset per customer; its columns are the priorities seen."""
    catalog = read_table(spark, sf, "orders").groupBy("o_custkey").agg(
        F.round(F.avg("o_totalprice") / 40000, 2).alias("usability"), (F.count("*") * 40).alias("n_rows"),
        F.collect_set("o_orderpriority").alias("columns"),  # at most five values
    ).select(
        F.concat(F.lit("ds-"), F.col("o_custkey").cast("string")).alias("ref"), "usability", "n_rows", "columns",
        F.when(F.col("o_custkey") % 4 == 0, "json").otherwise("csv").alias("format"),
    )
    return registry.choose_datasets(catalog, "1-URGENT").select("ref", "usability", "n_rows")
