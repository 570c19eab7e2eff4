"""Methodology audit over many runs.

All parsed notes of a run meet in one profile row. A check is a rule over that row that
yields an array of findings, so any number of checks costs one pass over the texts.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.moments import pearson
from .features import encode_category, normalize_metric, to_number
from .profile import class_shares, null_ratio

LEAK = 0.95
RARE_CLASS = 0.2
MAX_NULL = 0.05
MAX_TRIES = 5
MAX_SEEDS = 2
FEW_CLASSES = 5
NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")
FINDINGS = "array<struct<check_id: string, severity: string, message: string, location: string, evidence: string>>"

# fixed values: metrics by direction, normalised
HIGHER = ["AUC", "AUCROC", "F1", "ACCURACY", "RECALL", "PRECISION", "ROCAUC"]
LOWER = ["RMSE", "MAE", "LOGLOSS", "MSE"]
# fixed values: scorer spellings with the same direction
HIGHER_SCORERS = HIGHER + ["F1MACRO", "F1WEIGHTED", "F1MICRO", "BALANCEDACCURACY", "AVERAGEPRECISION"]
LOWER_SCORERS = LOWER + [
    "NEGROOTMEANSQUAREDERROR", "NEGMEANABSOLUTEERROR", "NEGLOGLOSS", "NEGMEANSQUAREDERROR",
]


def finding(check: str, severity: str, message: Column, location: Column | str, evidence: Column) -> list[Column]:
    loc = F.lit(location) if isinstance(location, str) else location
    return [
        F.lit(check).alias("check_id"),
        F.lit(severity).alias("severity"),
        message.alias("message"),
        loc.alias("location"),
        evidence.alias("evidence"),
    ]


def _one(condition: Column, *parts) -> Column:
    """An array with the finding where the condition holds, else an empty one."""
    return F.when(F.coalesce(condition, F.lit(False)), F.array(F.struct(*finding(*parts)))).otherwise(
        F.array().cast(FINDINGS)
    )


def numeric_target(df: DataFrame, target: str) -> DataFrame:
    """Target as a number: category codes for text or fewer than five values.

    A missing value is no class of its own, but gets the code -1 where codes are given.
    """
    is_text = dict(df.dtypes)[target] == "string"
    kinds = df.select(target).where(F.col(target).isNotNull()).distinct()
    few = is_text or kinds.limit(FEW_CLASSES).count() < FEW_CLASSES
    return encode_category(df, target, "__y") if few else df.withColumn("__y", F.col(target).cast("double"))


def leak_correlations(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """|r| with the target for every feature, text coerced to numbers, one scan."""
    coded = numeric_target(df, target)
    kinds = dict(df.dtypes)
    as_number = lambda c: to_number(F.col(c)) if kinds[c] == "string" else F.col(c).cast("double")
    wide = coded.agg(
        *[
            F.struct(F.lit(c).alias("feature"), F.abs(pearson(as_number(c), F.col("__y"))).alias("abs_r")).alias(f"p{i}")
            for i, c in enumerate(features)
        ]
    )
    cells = F.explode(F.array(*[F.col(f"p{i}") for i in range(len(features))])).alias("cell")
    return wide.select(cells).select("cell.*")


def leak_facts(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """One row: the features that follow the target too closely."""
    strong = leak_correlations(df, features, target).where((F.col("abs_r") > LEAK) & (F.col("feature") != target))
    return strong.agg(F.collect_list(F.struct("feature", "abs_r")).alias("leaks"))  # at most one per column


def class_facts(df: DataFrame, target: str) -> DataFrame:
    """One row: share of the rarest class and number of classes."""
    return class_shares(df, target).agg(F.min("share").alias("min_share"), F.count("*").alias("n_classes"))


def null_facts(df: DataFrame) -> DataFrame:
    """One row: the columns with too many missing values."""
    high = null_ratio(df).where(F.col("null_ratio") > MAX_NULL)
    return high.agg(F.array_sort(F.collect_list("column")).alias("null_columns"))  # at most one per column


# ---- facts of many tables --------------------------------------------------------

def tables_asked(plans: DataFrame, tables: Mapping[str, DataFrame]) -> list[tuple[str, str, bool]]:
    """(table, target, whether some plan classifies it) for all targets that plans name and tables have.

    At most one entry per column of a table reaches the driver.
    """
    known = [(name, c) for name, df in tables.items() for c in df.columns]
    columns = plans.sparkSession.createDataFrame(known, "dataset string, target_variable string")
    own = ["dataset", "target_variable"]
    named = plans.groupBy(*own).agg(F.bool_or(F.col("analysis_type") == "classification").alias("c")).alias("p")
    # <=>, as "=" would have every note parsed once more to leave out NULL targets; the columns have none
    same = F.col("p.dataset").eqNullSafe(F.col("k.dataset")) & F.col("p.target_variable").eqNullSafe(F.col("k.target_variable"))
    rows = named.join(F.broadcast(columns.alias("k")), same).select("p.*")  # one row per column
    return sorted((r["dataset"], r["target_variable"], bool(r["c"])) for r in rows.collect())


def table_leaks(tables: Mapping[str, DataFrame], asked: Sequence[tuple[str, str, bool]]) -> DataFrame:
    """(dataset, target_variable, leaks): features of each table that follow a target too closely.

    Every row gives one value pair per target and feature; moments of all pairs of all tables
    come from one aggregation, whose plan does not grow with the number of columns.
    """
    parts = []
    for name, df in tables.items():
        targets = [t for d, t, _ in asked if d == name]
        coded = df
        for i, t in enumerate(targets):
            coded = numeric_target(coded, t).withColumnRenamed("__y", f"__y{i}")
        kinds = dict(df.dtypes)
        plain = [c for c in df.columns if kinds[c].split("(")[0] in NUMERIC or kinds[c] == "string"]
        number = {c: to_number(F.col(c)) if kinds[c] == "string" else F.col(c).cast("double") for c in plain}
        if targets:
            ys = F.array(*[F.struct(F.lit(t).alias("target_variable"), F.col(f"__y{i}").cast("double").alias("y")) for i, t in enumerate(targets)])
            xs = F.array(*[F.struct(F.lit(c).alias("feature"), _finite(x).alias("x")) for c, x in number.items()])
            parts.append(coded.select(F.lit(name).alias("dataset"), F.explode(ys).alias("t"), xs.alias("xs")).select(
                "dataset", "t.*", F.explode("xs").alias("f")).select("dataset", "target_variable", "y", "f.*"))
    if not parts:
        return _no_rows(tables, "dataset string, target_variable string, leaks array<struct<feature:string,abs_r:double>>")
    pairs = union_findings(parts).where(F.col("feature") != F.col("target_variable"))
    r = pairs.groupBy("dataset", "target_variable", "feature").agg(F.abs(pearson(F.col("x"), F.col("y"))).alias("abs_r"))
    return r.where(F.col("abs_r") > LEAK).groupBy("dataset", "target_variable").agg(
        F.collect_list(F.struct("feature", "abs_r")).alias("leaks")  # at most one per column
    )


def table_classes(tables: Mapping[str, DataFrame], asked: Sequence[tuple[str, str, bool]]) -> DataFrame:
    """(dataset, target_variable, min_share, n_classes) of the targets that plans classify."""
    parts = []
    for name, df in tables.items():
        targets = [t for d, t, c in asked if d == name and c]
        if targets:
            cells = F.array(*[F.struct(F.lit(t).alias("target_variable"), F.col(t).cast("string").alias("v")) for t in targets])
            parts.append(df.select(F.lit(name).alias("dataset"), F.explode(cells).alias("c")).select("dataset", "c.*"))
    if not parts:
        return _no_rows(tables, "dataset string, target_variable string, min_share double, n_classes bigint")
    counts = union_findings(parts).where(F.col("v").isNotNull()).groupBy("dataset", "target_variable", "v").agg(F.count("*").alias("n"))
    return counts.groupBy("dataset", "target_variable").agg(
        (F.min("n") / F.sum("n")).alias("min_share"), F.count("*").alias("n_classes")
    )


def table_nulls(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(dataset, null_columns): the columns with too many missing values, sorted."""
    parts = []
    for name, df in tables.items():
        cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).isNull().cast("int").alias("gap")) for c in df.columns])
        parts.append(df.select(F.lit(name).alias("dataset"), F.explode(cells).alias("c")).select("dataset", "c.*"))
    if not parts:
        return _no_rows(tables, "dataset string, null_columns array<string>")
    share = union_findings(parts).groupBy("dataset", "column").agg(F.round(F.avg("gap"), 3).alias("r"))
    high = share.where(F.col("r") > MAX_NULL)
    return high.groupBy("dataset").agg(F.array_sort(F.collect_list("column")).alias("null_columns"))


def _finite(x: Column) -> Column:
    return F.nanvl(x, F.lit(None).cast("double"))


def _no_rows(tables: Mapping[str, DataFrame], schema: str) -> DataFrame:
    spark = next(iter(tables.values())).sparkSession if tables else SparkSession.active()
    return spark.createDataFrame([], schema)


def with_table_facts(profile: DataFrame, tables: Mapping[str, DataFrame], plans: DataFrame) -> DataFrame:
    """A run's profile (with ``dataset``) next to the facts of its own table and target; unknown tables have none."""
    asked = tables_asked(plans, tables)
    own = ["dataset", "target_variable"]
    return (
        profile.join(table_leaks(tables, asked), own, "left").join(table_classes(tables, asked), own, "left")
        .join(table_nulls(tables), "dataset", "left")
    )


def run_profile(*parts: DataFrame) -> DataFrame:
    """One row per run from any of its parsed notes; absent notes leave NULLs."""
    out = parts[0]
    for p in parts[1:]:
        out = out.join(p, "run_id", "full")
    return out


def with_facts(profile: DataFrame, *facts: DataFrame) -> DataFrame:
    """Attach one-row facts about the audited table."""
    for f in facts:
        profile = profile.crossJoin(F.broadcast(f))
    return profile


# ---- rules ------------------------------------------------------------------------

def m1(target: str | None = None, source: str | None = None) -> Column:
    """Best features that nearly equal the target; without a name, of the run's own target and table."""
    named = F.col("target_variable") if target is None else F.lit(target)
    place = F.col("dataset") if source is None else F.lit(source)
    mine = F.filter("leaks", lambda x: F.array_contains(F.col("best_features_list"), x["feature"]))
    hits = F.transform(
        mine,
        lambda x: F.struct(*finding(
            "M1", "block",
            F.concat(F.lit("possible target leakage: feature '"), x["feature"], F.lit("' (|r|="),
                     F.round(x["abs_r"], 4).cast("string"), F.lit(")")),
            place,
            F.concat(F.lit("corr("), x["feature"], F.lit(","), named, F.lit(")="), F.round(x["abs_r"], 4).cast("string")),
        )),
    )
    return F.when(F.col("target_variable") == named, hits)


def m2() -> Column:
    """Shuffled split on a time series."""
    return _one(
        F.col("is_time_series") & F.col("uses_shuffle_true"), "M2", "block",
        F.lit("shuffle=True on time series data"), "scripts/train.py", F.lit("is_time_series=True, shuffle=True"),
    )


def m3() -> Column:
    """Preprocessing fitted before the split."""
    return _one(
        F.col("fit_before_split"), "M3", "block", F.lit("fit_transform is called before the split"),
        "scripts/train.py",
        F.concat(F.lit("fit_transform line "), F.col("fit_line"), F.lit(", split line "),
                 F.coalesce(F.col("split_line").cast("string"), F.lit("none"))),
    )


def m4(target: str | None = None) -> Column:
    """Imbalanced classes without a stratified split; without a name, of the run's own target."""
    named = F.col("target_variable") if target is None else F.lit(target)
    share = F.round("min_share", 3).cast("string")
    return _one(
        (F.col("analysis_type") == "classification") & (F.col("target_variable") == named)
        & (F.col("n_classes") > 1) & (F.col("min_share") < RARE_CLASS)
        & ~F.coalesce("uses_stratified_kfold", F.lit(False)),
        "M4", "warn", F.concat(F.lit("imbalanced classes (min share "), share, F.lit(") without StratifiedKFold")),
        "scripts/train.py", F.concat(F.lit("min_share="), share),
    )


def m5() -> Column:
    """A hypothesis tried too often: equal ids stand together once sorted, so each is counted in one walk."""
    none = F.array().cast("array<struct<h:string,n:int>>")
    ids = F.array_sort("hypothesis_ids")
    tries = F.aggregate(
        ids, F.struct(F.lit(None).cast("string").alias("h"), F.lit(0).alias("n"), none.alias("done")),
        lambda t, x: F.when(x == t["h"], F.struct(t["h"].alias("h"), (t["n"] + 1).alias("n"), t["done"].alias("done")))
        .otherwise(F.struct(x.alias("h"), F.lit(1).alias("n"), _often(t).alias("done"))),
        _often,
    )
    return F.transform(
        tries,
        lambda t: F.struct(*finding(
            "M5", "warn",
            F.concat(F.lit("hypothesis '"), t["h"], F.lit("' tried "), t["n"].cast("string"), F.lit(" times")),
            "scratch/analysis-cycle.md",
            F.concat(F.lit("counts["), t["h"], F.lit("]="), t["n"].cast("string")),
        )),
    )


def _often(t: Column) -> Column:
    """The finished ids, with the current one if it was tried too often."""
    more = F.concat(t["done"], F.array(F.struct(t["h"].alias("h"), t["n"].alias("n"))))
    return F.when(t["n"] > MAX_TRIES, more).otherwise(t["done"])


def m6() -> Column:
    """A fold left out."""
    return _one(
        F.col("fold_excluded"), "M6", "warn", F.lit("a fold was left out"), "scratch/analysis-cycle.md",
        F.lit("fold_excluded"),
    )


def m7() -> Column:
    """Missing values without imputation."""
    n = F.size("null_columns")
    return _one(
        (n > 0) & ~F.coalesce("has_impute", F.lit(False)), "M7", "warn",
        F.concat(n.cast("string"), F.lit(" columns with more than 5% missing and no imputation")),
        "scripts/train.py", F.concat(F.lit("columns: "), F.concat_ws(",", F.slice("null_columns", 1, 5))),
    )


def m8(strict: bool = False) -> Column:
    """Scorer of another direction than the metric. ``strict`` knows the short names only."""
    metric, used = normalize_metric(F.col("success_metric")), normalize_metric(F.col("metric_score_used"))
    up = metric.isin(HIGHER) & ~used.isin(HIGHER if strict else HIGHER_SCORERS)
    down = metric.isin(LOWER) & ~used.isin(LOWER if strict else LOWER_SCORERS)
    way = F.when(up, "higher").otherwise("lower")
    return _one(
        up | down, "M8", "block",
        F.concat(F.lit("metric '"), "success_metric", F.lit("' is better "), way, F.lit(", scoring='"),
                 "metric_score_used", F.lit("'")),
        "scripts/train.py",
        F.concat(F.lit("metric="), "success_metric", F.lit(", scoring="), "metric_score_used"),
    )


def m9() -> Column:
    """The same seed fixed too often."""
    return _one(
        F.col("random_state_count") > MAX_SEEDS, "M9", "warn",
        F.concat(F.lit("random_state=42 occurs "), "random_state_count", F.lit(" times")),
        "scripts/train.py", F.concat(F.lit("count="), "random_state_count"),
    )


def m10() -> Column:
    """Absolute or home paths."""
    return _one(
        F.col("abs_path_count") > 0, "M10", "warn",
        F.concat(F.lit("absolute or home path used "), "abs_path_count", F.lit(" times")),
        "scripts/train.py", F.concat(F.lit("count="), "abs_path_count"),
    )


def m11() -> Column:
    """No font preamble."""
    return _one(
        ~F.coalesce("has_font", F.lit(False)), "M11", "warn", F.lit("no font preamble for Hangul labels"),
        "scripts/train.py", F.lit("font.family not set"),
    )


def m12() -> Column:
    """Excluded features among the best ones."""
    back = F.array_intersect(F.col("best_features_list"), F.col("excluded"))
    return _one(
        F.size(back) > 0, "M12", "block",
        F.concat(F.lit("excluded features are used again: "), F.concat_ws(",", F.array_sort(back))),
        "scripts/train.py",
        F.concat(F.lit("excluded="), F.concat_ws(",", "excluded"), F.lit("; best="), F.concat_ws(",", "best_features_list")),
    )


def apply_rules(profile: DataFrame, *rules: Column) -> DataFrame:
    """Findings of the rules, one row each."""
    empty = F.array().cast(FINDINGS)
    found = F.flatten(F.array(*[F.coalesce(r.cast(FINDINGS), empty) for r in rules]))
    return profile.select("run_id", F.explode(found).alias("f")).select("run_id", "f.*")


def audit_tables(
    plans: DataFrame, cycles: DataFrame, excluded: DataFrame, flags: DataFrame, tables: Mapping[str, DataFrame],
) -> DataFrame:
    """All checks, each run against its own table: ``plans`` has the column ``dataset``."""
    profile = with_table_facts(run_profile(plans, cycles, excluded, flags), tables, plans)
    return apply_rules(
        profile, m1(), m2(), m3(), m4(), m5(), m6(), m7(), m8(), m9(), m10(), m11(), m12()
    )


def audit(
    plans: DataFrame, cycles: DataFrame, excluded: DataFrame, flags: DataFrame,
    facts: Sequence[DataFrame], target: str, class_target: str, source: str,
) -> DataFrame:
    """All checks as one findings table; ``facts`` are the one-row frames of the audited table."""
    profile = with_facts(run_profile(plans, cycles, excluded, flags), *facts)
    return apply_rules(
        profile, m1(target, source), m2(), m3(), m4(class_target), m5(), m6(), m7(), m8(), m9(), m10(), m11(), m12()
    )


def union_findings(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
