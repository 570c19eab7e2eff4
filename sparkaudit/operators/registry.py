"""Publish gate, result registry and stage status, keyed by goal."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GATE_KINDS = ("trust-metrics-llm", "trust-metrics-code", "qa-review", "head-of-data-decision")
# fixed values: steps of an analysis in order, with the artifact that proves each
STEPS = (
    ("define-analysis", "plan"),
    ("kaggle-discover", "kaggle-discover"),
    ("setup", "setup"),
    ("hypothesis-eda", "hypothesis-eda"),
    ("analysis-cycle", "analysis-cycle"),
    ("verify-report", "report"),
    ("trust-metrics-llm", "trust-metrics-llm"),
    ("trust-metrics-code", "trust-metrics-code"),
    ("qa-reviewer", "qa-review"),
    ("head-of-data", "head-of-data-decision"),
)


def publishable(artifacts: DataFrame, decisions: DataFrame) -> DataFrame:
    """Goals with all four artifacts and the decision PUBLISH."""
    full = (
        artifacts.where(F.col("kind").isin(*GATE_KINDS))
        .groupBy("goal")
        .agg(*[F.max((F.col("kind") == k).cast("int")).alias(f"k{i}") for i, k in enumerate(GATE_KINDS)])
    )
    ready = full.where(sum((F.col(f"k{i}") for i in range(len(GATE_KINDS))), F.lit(0)) == len(GATE_KINDS))
    published = decisions.where(F.col("decision") == "PUBLISH")
    return ready.join(published, "goal", "left_semi").select("goal")


def plan_identity(name: Column) -> tuple[Column, Column]:
    """(date, goal) from ``YYYYMMDD-goal.md`` or ``goal.md``."""
    dated = name.rlike(r"^[0-9]{8}-.+\.md$")
    date = F.when(dated, F.substring(name, 1, 8)).otherwise("00000000")
    goal = F.when(dated, F.regexp_extract(name, r"^[0-9]{8}-(.+)\.md$", 1)).otherwise(
        F.regexp_replace(name, r"\.md$", "")
    )
    return date, goal


def report_map(reports: DataFrame) -> DataFrame:
    """Existing report paths per (goal, date) as a map extension -> path."""
    kinds = ("html", "ipynb", "md")
    path = lambda e: F.max(F.when(F.col("ext") == e, F.col("path")))
    wide = reports.where(F.col("ext").isin(*kinds)).groupBy("goal", "date").agg(*[path(e).alias(e) for e in kinds])
    entries = F.array_compact(F.array(*[F.when(F.col(e).isNotNull(), F.struct(F.lit(e).alias("ext"), F.col(e).alias("path"))) for e in kinds]))
    return wide.select("goal", "date", F.map_from_entries(entries).alias("reports"))


def with_verdicts(goals: DataFrame, decisions: DataFrame, qa: DataFrame) -> DataFrame:
    """Verdicts per goal: the latest decision first, then the QA review, else UNKNOWN."""
    cols = ["decision", "decided_at", "qa_verdict", "llm_verdict", "code_verdict"]
    latest = F.max_by(F.struct(*cols), F.struct("decided_at", *[c for c in cols if c != "decided_at"]))
    d = decisions.groupBy("goal").agg(latest.alias("d")).select("goal", "d.*").select(
        "goal", "decision", "decided_at", F.col("qa_verdict").alias("__dq"),
        F.col("llm_verdict").alias("__dl"), F.col("code_verdict").alias("__dc"),
    )
    q = qa.select(
        "goal", F.col("qa_verdict").alias("__qq"), F.col("llm_verdict").alias("__ql"), F.col("code_verdict").alias("__qc")
    )
    known = lambda *cols: F.coalesce(*[F.col(c) for c in cols], F.lit("UNKNOWN"))
    return goals.join(d, "goal", "left").join(q, "goal", "left").select(
        *goals.columns,
        known("decision").alias("decision"),
        known("__dl", "__ql").alias("llm_verdict"),
        known("__dc", "__qc").alias("code_verdict"),
        known("__dq", "__qq").alias("qa_verdict"),
        F.coalesce("decided_at", F.lit("")).alias("decided_at"),
    )


def upsert(registry: DataFrame, candidates: DataFrame) -> DataFrame:
    """Known goals stay as they are; new goals are added once, if they have a report."""
    fresh = candidates.where(F.size("reports") > 0).join(registry.select("goal"), "goal", "left_anti")
    one = fresh.groupBy("goal").agg(
        *[F.min_by(F.col(c), F.col("date")).alias(c) for c in candidates.columns if c != "goal"]
    )
    return registry.unionByName(one.select(*registry.columns))


def integrity_violations(registry: DataFrame, files: DataFrame, version: int = 1) -> DataFrame:
    """Entries with a wrong version, without key, or without any existing report."""
    paths = registry.select("goal", F.explode_outer(F.map_values("reports")).alias("path"))
    alive = paths.join(files.select("path"), "path", "left_semi").select("goal").distinct().withColumn("__ok", F.lit(True))
    checked = registry.join(alive, "goal", "left")
    reason = (
        F.when(F.col("version") != version, "wrong version")
        .when(F.col("goal").isNull() | F.col("reports").isNull(), "missing key")
        .when(F.col("__ok").isNull(), "no report file")
    )
    return checked.select("goal", reason.alias("violation")).where(F.col("violation").isNotNull())


def registry_document(registry: DataFrame) -> DataFrame:
    """Entries as JSON lines for the dashboard."""
    return registry.select("goal", F.to_json(F.struct(*registry.columns)).alias("entry"))


def stage_status(artifacts: DataFrame, decisions: DataFrame) -> DataFrame:
    """Finished steps of each goal and what comes next."""
    have = artifacts.groupBy("goal").agg(
        *[F.max((F.col("kind") == kind).cast("int")).alias(f"s{i}") for i, (_, kind) in enumerate(STEPS)]
    )
    s = [F.col(f"s{i}") == 1 for i in range(len(STEPS))]
    done = sum((F.col(f"s{i}") for i in range(len(STEPS))), F.lit(0))
    plan, found, setup, eda, cycle, report, semantic, code, qa, decided = s
    step = (
        F.when(~plan, "define-analysis")
        .when(~found, "kaggle-discover")
        .when(~setup, "setup")
        .when(~eda, "hypothesis-eda")
        .when(~cycle, "analysis-cycle")
        .when(~semantic & ~code, "trust-metrics-llm + trust-metrics-code")
        .when(~code, "trust-metrics-code")
        .when(~semantic, "trust-metrics-llm")
        .when(~qa, "qa-reviewer")
        .when(~decided | F.col("decision").isNull(), "head-of-data")
        .when((F.col("decision") == "PUBLISH") & ~report, "verify-report")
        .when(F.col("decision") == "PUBLISH", "done")
        .when(F.col("decision") == "REVISE-LLM", "back to hypothesis-eda")
        .when(F.col("decision") == "REVISE-Code", "back to analysis-cycle")
        .otherwise("cancelled")
    )
    return have.join(decisions.select("goal", "decision"), "goal", "left").select(
        "goal", done.alias("steps_done"), step.alias("next_step")
    )


def choose_datasets(catalog: DataFrame, target: str, k: int = 5) -> DataFrame:
    """Usable CSV datasets with the target column: usability 7 and 500 rows at least."""
    return (
        catalog.where(
            (F.col("usability") >= 7.0) & (F.col("n_rows") >= 500) & (F.lower("format") == "csv")
            & F.array_contains("columns", target)
        )
        .orderBy(F.desc("usability"), F.desc("n_rows"), "ref")
        .limit(k)
    )
