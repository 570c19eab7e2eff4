"""Metadata of runs, read from text: plans, loop notes, exploration notes, scripts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# fixed values: keys of a plan note and of the best result
PLAN_KEYS = ("goal", "analysis_type", "target_variable", "success_metric", "execution_env")
BEST_KEYS = ("best_hypothesis", "best_features", "best_model", "best_score")
# fixed values: patterns of the notes
TIME_SERIES = r"(?i)time[\-\s]?series|시계열|timeseries"
IMBALANCED = r"(?i)불균형|imbalanced|class\s*imbalance"
HYPOTHESIS_ID = r"""hypothesis[_\-]?id[:\s=]+['"]?([Hh][0-9]+|HYP[A-Za-z0-9_]+)"""
EXCLUDED = r"(?i)excluded[_\-]?features[:\s=]+\[([^\]]+)\]"
WORD = r"[A-Za-z0-9_가-힣]+"


def read_texts(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """(path, modified, text), one row per whole file."""
    return (
        spark.read.text(folder, wholetext=True, recursiveFileLookup=True, pathGlobFilter=pattern)
        .select(
            F.col("_metadata.file_path").alias("path"),
            F.col("_metadata.file_modification_time").alias("modified"),
            F.col("value").alias("text"),
        )
    )


def unless(missing: Column, value, found: Column) -> Column:
    """``found``, or ``value`` where a plain search tells that its pattern has no match; a NULL text goes to the pattern."""
    return F.when(missing, value).otherwise(found)


def key_lines(text: Column) -> Column:
    """All ``key: value`` lines of a plan from the key on, last line first; read by one pass of the pattern."""
    pattern = F.lit(rf"(?m)^[ \t]*(?:- )?((?:{'|'.join(PLAN_KEYS)}):[^\r\n]*)")
    return F.reverse(F.regexp_extract_all(text, pattern, F.lit(1))).alias("__lines")


def line_value(key: str) -> Column:
    """Value of the last line of a key."""
    at = F.nullif(F.array_position("__keys", key), F.lit(0).cast("bigint")).cast("int")
    line = F.try_element_at(F.col("__lines"), at)
    return F.trim(F.substring(line, F.lit(len(key) + 2), F.length(line)), F.lit(" \t"))


def first_value(text: Column, key: str) -> Column:
    """Rest of the line after the first ``key:``; NULL where there is none."""
    return F.nullif(F.trim(F.regexp_extract(text, rf"{key}:\s*([^\n]+)", 1)), F.lit(""))


def parse_list(text: Column) -> Column:
    """A quoted list, or else its words."""
    quoted = F.replace(text, F.lit("'"), F.lit('"'))
    as_json = F.when(text.startswith("["), F.from_json(quoted, "array<string>"))
    return F.when(text.isNotNull(), F.coalesce(as_json, F.regexp_extract_all(text, F.lit(WORD), F.lit(0))))


def front_matter(text: Column) -> Column:
    """The ``---`` block at the top as a map; the last of equal keys wins."""
    block = F.regexp_extract(text, r"(?s)^---(.*?)\n---", 1)
    lines = F.filter(
        F.split(block, "\n"), lambda s: s.contains(":") & ~s.startswith(" ")
    )
    pairs = F.transform(
        lines,
        lambda s: F.struct(
            F.trim(F.substring_index(s, ":", 1)).alias("key"),
            F.trim(F.regexp_extract(s, r"^[^:]*:(.*)$", 1)).alias("value"),
        ),
    )
    last = F.filter(
        F.transform(pairs, lambda e, i: F.struct(e["key"].alias("key"), e["value"].alias("value"), i.alias("i"))),
        lambda e: ~F.exists(
            F.slice(pairs, e["i"] + 2, F.greatest(F.size(pairs), F.lit(1))), lambda later: later["key"] == e["key"]
        ),
    )
    return F.map_from_entries(F.transform(last, lambda e: F.struct(e["key"], e["value"])))


def plan_info(plans: DataFrame, key: str = "run_id", text: str = "text") -> DataFrame:
    t, small = F.col(text), F.lower(text)
    constraints = F.regexp_extract_all(t, F.lit(r"(?m)^[ \t]*- constraints:[ \t]*([^\r\n]*)"), F.lit(1))
    found = plans.select(
        key,
        key_lines(t),
        unless(~t.contains("- constraints:"), F.array().cast("array<string>"), constraints).alias("constraints"),
        ((small.contains("time") | t.contains("시계열")) & t.rlike(TIME_SERIES)).alias("is_time_series"),
        ((small.contains("imbalance") | t.contains("불균형")) & t.rlike(IMBALANCED)).alias("is_imbalanced_hint"),
    )
    keyed = found.withColumn("__keys", F.transform("__lines", lambda x: F.substring_index(x, ":", 1)))
    return keyed.select(
        key, *[line_value(k).alias(k) for k in PLAN_KEYS], "constraints", "is_time_series", "is_imbalanced_hint"
    )


def cycle_info(cycles: DataFrame, key: str = "run_id", text: str = "text") -> DataFrame:
    t = F.col(text)
    return cycles.select(
        key,
        *[first_value(t, k).alias(k) for k in BEST_KEYS],
        t.contains("fold_excluded").alias("fold_excluded"),
        unless(
            ~t.contains("hypothesis"), F.array().cast("array<string>"), F.regexp_extract_all(t, F.lit(HYPOTHESIS_ID), F.lit(1))
        ).alias("hypothesis_ids"),
    ).withColumn("best_features_list", parse_list(F.col("best_features")))


def excluded_features(notes: DataFrame, key: str = "run_id", text: str = "text") -> DataFrame:
    inner = unless(~F.lower(text).contains("excluded"), F.lit(""), F.regexp_extract(text, EXCLUDED, 1))
    parts = F.transform(F.split(inner, ","), lambda s: F.regexp_replace(F.trim(s), "^['\"]+|['\"]+$", ""))
    return notes.select(key, F.when(inner != "", parts).otherwise(F.array().cast("array<string>")).alias("excluded"))


# ---- scripts ----------------------------------------------------------------

# fixed values: what the lint looks for in a training script
SEED_42 = r"random_state\s*=\s*42"
ROOTED_PATH = r"""(?m)^["']/(?:Users|tmp|home|content)"""
ROOTED_PATH_ANYWHERE = r"""["']/(?:Users|tmp|home|content)"""
HOME_PATH = r"~/?[A-Za-z0-9_]+"
IMPUTES = (".fillna(", "SimpleImputer", "KNNImputer", "IterativeImputer")
SCORING = r"""scoring\s*=\s*['"]([^'"]+)['"]"""
SPLIT_CALL = r"train_test_split[A-Za-z0-9_.]*\s*\("
FIT_CALL = r"fit_transform[A-Za-z0-9_.]*\s*\("


def _newlines_before(at: str) -> Column:
    """Line number of a match position; NULL where there is no match."""
    return F.when(F.col(at) > 0, F.size(F.split(F.substring(F.col("__code"), F.lit(1), F.col(at)), "\n")))


def script_flags(
    scripts: DataFrame, key: str = "run_id", text: str = "text", anywhere: bool = False
) -> DataFrame:
    """Lint flags of each script; one pass over the text, no explode.

    Comments and definitions are blanked once, then the calls are located. A pattern is run
    only on texts that hold its fixed part.
    """
    t = F.col(text)
    bare = unless(~t.contains("#"), t, F.regexp_replace(t, r"#[^\n]*", ""))
    flags = scripts.select(key, t.alias("__text"), bare.alias("__bare"))
    t, bare, none = F.col("__text"), F.col("__bare"), F.lit(0)
    code = unless(~bare.contains("def"), bare, F.regexp_replace(bare, r"def\s+[A-Za-z0-9_]+", ""))
    flags = flags.select(key, "__text", code.alias("__code"))
    code = F.col("__code")
    rooted = F.regexp_count(t, F.lit(ROOTED_PATH_ANYWHERE if anywhere else ROOTED_PATH))
    flags = flags.select(
        key,
        "__code",
        unless(~code.contains("train_test_split"), none, F.regexp_instr(code, F.lit(SPLIT_CALL))).alias("__split_at"),
        unless(~code.contains("fit_transform"), none, F.regexp_instr(code, F.lit(FIT_CALL))).alias("__fit_at"),
        unless(~t.contains("random_state"), none, F.regexp_count(t, F.lit(SEED_42))).alias("random_state_count"),
        (
            unless(~(t.contains("'/") | t.contains('"/')), none, rooted)
            + unless(~t.contains("~"), none, F.regexp_count(t, F.lit(HOME_PATH)))
        ).alias("abs_path_count"),
        (t.contains("font.family") & (t.contains("AppleGothic") | t.contains("NanumGothic"))).alias("has_font"),
        reduce(Column.__or__, [t.contains(x) for x in IMPUTES]).alias("has_impute"),
        t.contains("StratifiedKFold").alias("uses_stratified_kfold"),
        (t.contains("KFold") & t.rlike(r"\bKFold\b")).alias("uses_kfold"),
        t.contains("TimeSeriesSplit").alias("uses_timeseries_split"),
        t.contains("train_test_split").alias("uses_train_test_split"),
        (t.contains("shuffle") & t.rlike(r"shuffle\s*=\s*True")).alias("uses_shuffle_true"),
        F.nullif(F.regexp_extract(t, SCORING, 1), F.lit("")).alias("metric_score_used"),
    )
    lined = flags.withColumns({"split_line": _newlines_before("__split_at"), "fit_line": _newlines_before("__fit_at")})
    early = F.col("fit_line").isNotNull() & (
        F.col("split_line").isNull() | (F.col("fit_line") < F.col("split_line"))
    )
    return lined.drop("__code", "__split_at", "__fit_at").withColumn("fit_before_split", early)
