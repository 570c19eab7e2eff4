"""Trust metrics, verdict rules and the four-layer roll-up."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TOLERANCE = 0.02
CHUNKS_PER_UNIT = 1024  # value ranges per unit of ln(1 + |x|) in the neighbour search

# fixed values: text that looks numeric but is a date, a time or a unit
DATES = r"[0-9]{4}-[0-9]{2}-[0-9]{2}([T ][0-9]{2}:[0-9]{2}(:[0-9]{2})?)?|[0-9]{2}:[0-9]{2}(:[0-9]{2})?"
UNITS = r"([0-9])(?:%|ms|px|GB|MB|KB|원|개|회|명|건)"
NUMBER = r"-?[0-9]+(?:\.[0-9]+)?"


# ---- grounded numbers -------------------------------------------------------

def number_tokens(reports: DataFrame, key: str, text: str) -> DataFrame:
    """Every number of a report, dates and units removed, with its position."""
    clean = F.regexp_replace(F.regexp_replace(F.col(text), DATES, " "), UNITS, "$1 ")
    tokens = F.posexplode(F.regexp_extract_all(clean, F.lit(NUMBER), F.lit(0))).alias("pos", "token")
    return reports.select(key, tokens).withColumn("cited", F.col("token").try_cast("double"))


def _chunk(x: Column) -> Column:
    """Order-preserving range number of a value."""
    return F.floor(F.signum(x) * F.log1p(F.abs(x)) * CHUNKS_PER_UNIT)


def nearest_actual(cited: DataFrame, actual: DataFrame, run: str = "run_id") -> DataFrame:
    """Closest actual value of the same run below and above each distinct cited one.

    Both sides collapse to distinct values, are sorted within small value ranges of a
    run, and the last (next) actual value is carried over the ranges: no pairs are formed.
    """
    both = (
        cited.select(run, F.col("cited").cast("double").alias("x"), F.lit(1).alias("c"), F.lit(0).alias("a"))
        .unionByName(actual.select(run, F.col("actual").cast("double").alias("x"), F.lit(0).alias("c"), F.lit(1).alias("a")))
        .where(F.col("x").isNotNull() & F.col(run).isNotNull())
        .groupBy(run, "x")
        .agg(F.sum("c").alias("n_cited"), F.max("a").alias("is_actual"))
        .withColumn("chunk", _chunk(F.col("x")))
    )
    hit = F.when(F.col("is_actual") == 1, F.col("x"))
    ends = both.groupBy(run, "chunk").agg(F.min(hit).alias("first_a"), F.max(hit).alias("last_a"))
    by_chunk = Window.partitionBy(run).orderBy("chunk")
    carried = ends.select(
        run, "chunk",
        F.max("last_a").over(by_chunk.rowsBetween(Window.unboundedPreceding, -1)).alias("carry_lo"),
        F.min("first_a").over(by_chunk.rowsBetween(1, Window.unboundedFollowing)).alias("carry_hi"),
    )
    up = Window.partitionBy(run, "chunk").orderBy("x").rowsBetween(Window.unboundedPreceding, 0)
    down = Window.partitionBy(run, "chunk").orderBy(F.desc("x")).rowsBetween(Window.unboundedPreceding, 0)
    near = both.join(carried, [run, "chunk"]).select(
        run, "x", "n_cited",
        F.coalesce(F.max(hit).over(up), "carry_lo").alias("lo"),
        F.coalesce(F.min(hit).over(down), "carry_hi").alias("hi"),
    )
    return near.where(F.col("n_cited") > 0).select(run, F.col("x").alias("cited"), "n_cited", "lo", "hi")


def _within(cited: Column, actual: Column, tolerance: float) -> Column:
    """|cited - actual| / |actual| <= tolerance; zero only matches zero."""
    return F.coalesce(F.abs(cited - actual) <= tolerance * F.abs(actual), F.lit(False))


def match_numbers(
    cited: DataFrame, actual: DataFrame, run: str = "run_id", tolerance: float = TOLERANCE
) -> DataFrame:
    """Distinct cited values of each run with their support.

    Relative to the actual value, the nearest one on either side has the smallest error
    of that side (for equal signs), so looking at two neighbours is exact.
    """
    near = nearest_actual(cited, actual, run)
    ok = _within(F.col("cited"), F.col("lo"), tolerance) | _within(F.col("cited"), F.col("hi"), tolerance)
    return near.withColumn("supported", ok)


def grounded_numeric(
    cited: DataFrame, actual: DataFrame, run: str = "run_id", tolerance: float = TOLERANCE
) -> DataFrame:
    """Share (percent) of cited numbers with an actual value within the tolerance."""
    m = match_numbers(cited, actual, run, tolerance)
    return m.groupBy(run).agg(
        F.sum("n_cited").alias("n_cited"),
        F.sum(F.when(F.col("supported"), F.col("n_cited")).otherwise(0)).alias("n_supported"),
    ).withColumn("grounded_numeric", F.col("n_supported") / F.col("n_cited") * 100)


def number_comparison(
    cited: DataFrame, actual: DataFrame, run: str = "run_id", ok: float = 2.0, partial: float = 5.0
) -> DataFrame:
    """Nearest actual value, difference in percent, and class of each distinct cited value."""
    near = nearest_actual(cited, actual, run)
    below, above = F.col("cited") - F.col("lo"), F.col("hi") - F.col("cited")
    pick = F.when(F.col("hi").isNull() | (below <= above), F.col("lo")).otherwise(F.col("hi"))
    out = near.select(run, "cited", "n_cited", pick.alias("actual"))
    delta = F.when(F.col("cited") == F.col("actual"), 0.0).otherwise(
        F.abs(F.col("cited") - F.col("actual")) / F.nullif(F.abs("actual"), F.lit(0.0)) * 100
    )
    return out.withColumn("delta_pct", delta).withColumn(
        "verdict",
        F.when(F.col("delta_pct") <= ok, "OK").when(F.col("delta_pct") <= partial, "PARTIAL").otherwise("MISMATCH"),
    )


# ---- stability and data trust ----------------------------------------------

def cv_stability(scores: DataFrame, run: str = "run_id") -> DataFrame:
    """Sample std of the seed means, to twelve digits where it meets its limits: sums in another order end alike."""
    per_seed = scores.groupBy(run, "seed").agg(F.avg("score").alias("m"))
    out = per_seed.groupBy(run).agg(
        F.count("*").alias("n_runs"), F.avg("m").alias("stability_mean"), F.stddev_samp("m").alias("stability_std")
    )
    s = F.round("stability_std", 12)
    return out.withColumn("cv_stability", F.when(s <= 0.01, "OK").when(s <= 0.02, "WARN").otherwise("FAIL"))


def metric_quote(metric: Column, score: Column, std: Column) -> Column:
    return F.format_string("%s %.4f ± %.4f", metric, score, std)


def consistent_with(current: DataFrame, stored: DataFrame) -> DataFrame:
    """Does each column's range and type still equal the stored description?"""
    s = stored.select("column", *[F.col(c).alias(f"__{c}") for c in ("min", "max", "dtype")])
    same = F.lit(True)
    for c in ("min", "max", "dtype"):
        same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
    return current.join(s, "column", "full").select("column", same.alias("same"))


def data_trust_signals(
    freshness_days: Column, null_share: Column, consistent: Column, key_null_share: Column
) -> list[Column]:
    return [
        F.coalesce(freshness_days <= 30, F.lit(False)).alias("fresh"),
        F.coalesce(null_share < 0.05, F.lit(False)).alias("complete"),
        F.coalesce(consistent, F.lit(False)).alias("consistent"),
        F.coalesce(key_null_share < 0.02, F.lit(False)).alias("keys_filled"),
    ]


def data_trust(signals: Sequence[str] = ("fresh", "complete", "consistent", "keys_filled")) -> Column:
    high = sum((F.col(c).cast("int") for c in signals), F.lit(0))
    return F.when(high == 4, "High").when(high == 3, "Medium").otherwise("Low")


# ---- rules --------------------------------------------------------------------

def confidence(checklist: DataFrame, run: str = "run_id", items: int = 4) -> DataFrame:
    """(PASS + half of PARTIAL) / items, in percent."""
    points = F.when(F.col("result") == "PASS", 1.0).when(F.col("result") == "PARTIAL", 0.5).otherwise(0.0)
    return checklist.groupBy(run).agg((F.sum(points) / items * 100).alias("confidence"))


def code_verdict(stability: Column, conf: Column, trust: Column) -> Column:
    return (
        F.when((stability == "FAIL") | (conf < 60) | (trust == "Low"), "FAIL")
        .when((stability == "WARN") | (conf < 80) | (trust == "Medium"), "WARN")
        .otherwise("PASS")
    )


def grounded_claims(votes: DataFrame, run: str = "run_id") -> DataFrame:
    """Mean of the claim votes (YES 1, PARTIAL half, NO 0) in percent, and the rest as risk."""
    points = F.when(F.col("vote") == "YES", 1.0).when(F.col("vote") == "PARTIAL", 0.5).when(F.col("vote") == "NO", 0.0)
    return votes.groupBy(run).agg(
        F.count("vote").alias("n_votes"), F.round(F.avg(points) * 100, 1).alias("grounded_claims")
    ).withColumn("hallucination_risk", F.round(100 - F.col("grounded_claims"), 1))


def insight_consistency(votes: DataFrame, run: str = "run_id") -> DataFrame:
    """Worst pairwise vote of each run."""
    rank = F.when(F.col("vote") == "INCONSISTENT", 2).when(F.col("vote") == "PARTIAL", 1).otherwise(0)
    worst = votes.groupBy(run).agg(F.max(rank).alias("__w"))
    label = F.when(F.col("__w") == 2, "INCONSISTENT").when(F.col("__w") == 1, "PARTIAL").otherwise("CONSISTENT")
    return worst.select(run, label.alias("insight_consistency"))


def semantic_verdict(grounded: Column, consistency: Column) -> Column:
    return (
        F.when((grounded < 60) | (consistency == "INCONSISTENT"), "FAIL")
        .when((grounded < 80) | (consistency == "PARTIAL"), "WARN")
        .otherwise("PASS")
    )


def code_backtrack(verdict: Column, trust: Column, stability: Column, grounded: Column) -> Column:
    return (
        F.when(verdict == "FAIL", "rerun analysis-cycle")
        .when(trust == "Low", "reload data")
        .when(stability == "FAIL", "change model")
        .when(grounded < 70, "review report numbers")
        .otherwise("continue to qa-reviewer")
    )


def semantic_backtrack(verdict: Column, risk: Column, consistency: Column) -> Column:
    return (
        F.when(verdict == "FAIL", "rewrite insights in hypothesis-eda")
        .when(risk >= 40, "rerun analysis-cycle and rewrite report")
        .when(consistency == "INCONSISTENT", "return to hypothesis-eda")
        .otherwise("continue to trust-metrics-code")
    )


def qa_flags(
    best: Column, stability_mean: Column, spread: Column, grounded: Column, consistency: Column,
    semantic: Column, code: Column,
) -> Column:
    """Array of the raised consistency flags; differences of scores are compared to twelve digits."""
    opposed = ((semantic == "PASS") & (code == "FAIL")) | ((semantic == "FAIL") & (code == "PASS"))
    raised = F.array(
        F.when(F.round(F.abs(best - stability_mean), 12) > 0.01, "score not reproduced"),
        F.when(F.round(spread, 12) < 0.02, "hypotheses hardly differ"),
        F.when(grounded < 90, "numbers not grounded"),
        F.when(consistency == "INCONSISTENT", "insights contradict"),
        F.when(opposed, "verdicts oppose"),
    )
    return F.array_compact(raised)


def conflict_result(n_conflicts: Column) -> Column:
    return F.when(n_conflicts == 0, "PASS").when(n_conflicts == 1, "PARTIAL").otherwise("FAIL")


def qa_verdict(n_flags: Column, n_fail: Column, n_partial: Column, semantic: Column, code: Column) -> Column:
    """FAIL before WARN before PASS; one (not both) WARN side warns."""
    return (
        F.when((n_flags > 0) | (n_fail >= 1) | (semantic == "FAIL") | (code == "FAIL"), "FAIL")
        .when((n_partial >= 2) | ((semantic == "WARN") != (code == "WARN")), "WARN")
        .otherwise("PASS")
    )


def audit_verdict(runs: DataFrame, findings: DataFrame, run: str = "run_id") -> DataFrame:
    """Verdict from finding counts; runs without findings pass."""
    counts = findings.groupBy(run).agg(
        F.count_if(F.col("severity") == "block").alias("n_block"),
        F.count_if(F.col("severity") == "warn").alias("n_warn"),
    )
    out = runs.select(run).join(counts, run, "left").fillna(0, ["n_block", "n_warn"])
    return out.withColumn(
        "verdict", F.when(F.col("n_block") >= 1, "FAIL").when(F.col("n_warn") >= 3, "WARN").otherwise("PASS")
    )


def layered(layers: DataFrame, run: str = "run_id") -> DataFrame:
    """Effective verdict of layers 1 to 4: nothing runs after a FAIL in layers 1 to 3,
    a FAIL in layer 4 is a WARN. A run has four rows, so the state is one row per run."""
    v = lambda i: F.max(F.when(F.col("layer") == i, F.col("verdict")))
    wide = layers.groupBy(run).agg(*[v(i).alias(f"r{i}") for i in (1, 2, 3, 4)])
    stopped = F.lit(False)
    steps = []
    for i in (1, 2, 3, 4):
        c = F.col(f"r{i}")
        own = F.when((F.lit(i) == 4) & (c == "FAIL"), "WARN").otherwise(c)
        steps.append(F.when(stopped, "NOT_RUN").otherwise(own).alias(f"r{i}"))
        stopped = stopped | F.coalesce(c == "FAIL", F.lit(False))
    effective = wide.select(run, *steps)
    any_is = lambda name: F.greatest(*[F.coalesce((F.col(f"r{i}") == name).cast("int"), F.lit(0)) for i in (1, 2, 3, 4)]) == 1
    return effective.withColumn(
        "overall", F.when(any_is("FAIL"), "FAIL").when(any_is("WARN"), "WARN").otherwise("PASS")
    )


def trust_panel(semantic: DataFrame, code: DataFrame, qa: DataFrame, goal: str = "goal") -> DataFrame:
    """One wide row per goal; goals missing on a side stay."""
    return semantic.join(code, goal, "full").join(qa, goal, "full")


def reusable(results: DataFrame, key: str, computed_at: str, now: Column, hours: int = 1) -> DataFrame:
    """Results younger than the limit at the given clock."""
    age = F.unix_seconds(now.cast("timestamp")) - F.unix_seconds(F.col(computed_at).cast("timestamp"))
    return results.withColumn("reuse", (age >= 0) & (age <= hours * 3600))
