"""Feature engineering: column expressions and fitted encoders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import hash32
from ..functions.moments import standardized
from ..functions.ordered import position
from ..functions.quantiles import quantile_columns

CODE_RANGES = 512


# ---- column expressions -------------------------------------------------

def drop_missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.na.drop(subset=list(columns))


def threshold_label(x: Column, cut: float, below: str, above: str) -> Column:
    return F.when(x < cut, below).when(x >= cut, above)


def flag(condition: Column) -> Column:
    return condition.cast("int")


def extract_token(text: Column, pattern: str) -> Column:
    """First group of a pattern, trimmed; NULL where it does not match."""
    return F.nullif(F.trim(F.regexp_extract(text, pattern, 1)), F.lit(""))


def fold_rare(value: Column, keep: Sequence[str], other: str = "Rare") -> Column:
    """Values outside the list, and missing ones, become one level."""
    return F.when(value.isin(list(keep)), value).otherwise(other)


def cut(x: Column, edges: Sequence[float], labels: Sequence[str], missing: str | None = "unknown") -> Column:
    """Right-closed bins ``(a, b]`` over fixed edges; outside or NULL gets ``missing``."""
    out = F.lit(missing)
    for lo, hi, name in reversed(list(zip(edges, edges[1:], labels))):
        out = F.when((x > lo) & (x <= hi), name).otherwise(out)
    return out


def to_number(text: Column) -> Column:
    """Double, or NULL where the text is no number."""
    return text.try_cast("double")


def normalize_metric(name: Column) -> Column:
    return F.translate(F.upper(name), " \t\n\x0b\f\r_-", "")


def scorer_for(metric: Column, task: Column) -> Column:
    """Scorer of a success metric; unknown names fall back on the task. Names and scorers are fixed values."""
    m = normalize_metric(F.coalesce(metric, F.lit("")))
    return (
        F.when(m.contains("AUC") | m.contains("ROC"), "roc_auc")
        .when(m == "F1", "f1")
        .when(m == "ACCURACY", "accuracy")
        .when(m == "RMSE", "neg_root_mean_squared_error")
        .when(m == "MAE", "neg_mean_absolute_error")
        .when(m.contains("LOGLOSS"), "neg_log_loss")
        .when(m.isin("R2", "RSQUARED"), "r2")
        .when(task == "classification", "roc_auc")
        .otherwise("r2")
    )


# ---- fitted transforms --------------------------------------------------

def fold_rare_by_count(df: DataFrame, column: str, minimum: int, other: str = "Rare") -> DataFrame:
    """Levels seen fewer than ``minimum`` times become one level."""
    frequent = (
        df.groupBy(column).agg(F.count("*").alias("__n")).where(F.col("__n") >= minimum)
        .select(F.col(column).alias("__level"))
    )
    return df.join(frequent, df[column] == frequent["__level"], "left").select(
        *[c for c in df.columns if c != column], F.coalesce("__level", F.lit(other)).alias(column)
    )


def quantile_cut(df: DataFrame, column: str, labels: Sequence[str], out: str) -> DataFrame:
    """Equal-frequency bins, right-closed, lowest value included."""
    q = len(labels)
    cuts = quantile_columns(df, [column], [i / q for i in range(1, q)])
    joined = df.crossJoin(F.broadcast(cuts.select("q")))  # one row
    label = F.lit(labels[-1])
    for i in reversed(range(q - 1)):
        label = F.when(F.col(column) <= F.col("q")[i], labels[i]).otherwise(label)
    return joined.withColumn(out, F.when(F.col(column).isNotNull(), label)).drop("q")


def category_codes(df: DataFrame, column: str) -> DataFrame:
    """Level -> 0-based code in sorted order.

    The levels are cut into ranges at hash-sampled levels and numbered range by range.
    """
    levels = df.select(column).where(F.col(column).isNotNull()).distinct()
    size = levels.agg(F.approx_count_distinct(column)).first()[0]
    sampled = levels.where(F.pmod(hash32(F.col(column)), F.lit(max(1, size // CODE_RANGES))) == 0)
    cuts = [r[0] for r in sampled.collect()]  # about CODE_RANGES values
    marks = F.array(*[F.lit(c) for c in cuts])
    chunk = F.size(F.filter(marks, lambda m: m <= F.col(column))) if cuts else F.lit(0)
    return position(levels, [], chunk, [column], "code")


def encode_category(df: DataFrame, column: str, out: str) -> DataFrame:
    """Add the code of each value; missing values get -1."""
    codes = category_codes(df, column).select(F.col(column).alias("__level"), "code")
    joined = df.join(codes, df[column] == codes["__level"], "left")
    return joined.select(*df.columns, F.coalesce("code", F.lit(-1)).alias(out))


def impute_median(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    medians = quantile_columns(df, columns, [0.5])
    row = medians.agg(
        *[F.max(F.when(F.col("column") == c, F.col("q")[0])).alias(f"__m_{c}") for c in columns]
    )
    filled = {c: F.coalesce(F.col(c).cast("double"), F.col(f"__m_{c}")) for c in columns}
    return df.crossJoin(F.broadcast(row)).withColumns(filled).drop(*[f"__m_{c}" for c in columns])


def impute_mode(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Most frequent value per column; the smallest one on a tie.

    Counted in two steps, so no aggregation buffer holds all levels of a column.
    """
    pairs = F.explode(
        F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("v")) for c in columns])
    ).alias("p")
    counts = (
        df.select(pairs).select("p.*").where(F.col("v").isNotNull())
        .groupBy("column", "v").agg(F.count("*").alias("n"))
    )
    best = counts.groupBy("column").agg(F.max("n").alias("top"))
    modes = counts.join(F.broadcast(best), "column").where(F.col("n") == F.col("top"))
    row = modes.agg(
        *[F.min(F.when(F.col("column") == c, F.col("v"))).alias(f"__m_{c}") for c in columns]
    )
    kinds = dict(df.dtypes)
    filled = {c: F.coalesce(F.col(c), F.col(f"__m_{c}").cast(kinds[c])) for c in columns}
    return df.crossJoin(F.broadcast(row)).withColumns(filled).drop(*[f"__m_{c}" for c in columns])


def standardize(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Zero mean, unit population spread."""
    row = df.agg(
        *[F.avg(c).alias(f"__a_{c}") for c in columns],
        *[F.stddev_pop(c).alias(f"__s_{c}") for c in columns],
    )
    scaled = {c: standardized(F.col(c), F.col(f"__a_{c}"), F.col(f"__s_{c}")) for c in columns}
    drop = [f"__{k}_{c}" for k in "as" for c in columns]
    return df.crossJoin(F.broadcast(row)).withColumns(scaled).drop(*drop)


def prepare_whole(df: DataFrame, numeric: Sequence[str], text: Sequence[str]) -> DataFrame:
    """Impute and encode the full table at once (before any split)."""
    out = impute_median(df, numeric) if numeric else df
    for c in text:
        filled = out.withColumn(c, F.coalesce(F.col(c), F.lit("nan")))
        out = encode_category(filled, c, f"{c}__code").drop(c).withColumnRenamed(f"{c}__code", c)
    return out
