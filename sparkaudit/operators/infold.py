"""Statistics of every training set of a cross-validation at once.

The rows of a split key (seed, fold) are a *cell*; a training set is a set of cells: the
other folds of a seed, or the earlier blocks of an expanding window. Every distinct value
is counted once per training set before the shuffle, so all fits of all seeds share one
scan, and an order statistic of a training set is found by running totals of its own
counter. No row is repeated for the training sets that it belongs to.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.moments import standardized
from ..functions.quantiles import value_buckets
from ..session import cut_lineage

SPLIT = ("seed", "fold")
Cell = tuple
Trains = Callable[[Cell, Cell], bool]


def other_folds(test: Cell, own: Cell) -> bool:
    """K-fold: the other folds with the same leading keys."""
    return test[:-1] == own[:-1] and test[-1] != own[-1]


def earlier_blocks(test: Cell, own: Cell) -> bool:
    """Expanding window: the lower blocks with the same leading keys."""
    return test[:-1] == own[:-1] and own[-1] < test[-1]


class Cells:
    """The cells of a fold table (seeds x folds of them) and which of them train for which."""

    def __init__(self, folds: DataFrame, split: Sequence[str] = SPLIT, trains: Trains = other_folds):
        self.split = list(split)
        rows = folds.select(*split).distinct().na.drop().orderBy(*split).collect()
        self.keys = [tuple(r) for r in rows]
        own = [[i for i, c in enumerate(self.keys) if trains(t, c)] for t in self.keys]
        self.tests = [i for i, members in enumerate(own) if members]
        self.members = {i: own[i] for i in self.tests}
        self.schema = folds.select(*split).schema

    def number(self) -> Column:
        """A row's own cell."""
        out = F.lit(None).cast("int")
        for i, key in enumerate(self.keys):
            same = F.lit(True)
            for name, value in zip(self.split, key):
                same = same & (F.col(name) == F.lit(value))
            out = F.when(same, i).otherwise(out)
        return out

    def per_train(self, made: Callable[[Column], Column], cell: str = "cell") -> list[Column]:
        """One aggregate per training set; ``made`` gets the condition that a row is in it."""
        return [made(F.col(cell).isin(self.members[i])) for i in self.tests]

    def named(self, df: DataFrame, at: str = "at") -> DataFrame:
        """Split keys in place of the number of a training set."""
        frame = df.sparkSession.createDataFrame([(n, *self.keys[i]) for n, i in enumerate(self.tests)], _schema(self, at))
        return df.join(F.broadcast(frame), at).drop(at)  # seeds x folds rows


def _schema(cells: Cells, at: str) -> str:
    return ", ".join([f"{at} int", *[f"`{f.name}` {f.dataType.simpleString()}" for f in cells.schema.fields]])


def _number(column: str) -> Column:
    return F.nanvl(F.col(column).cast("double"), F.lit(None).cast("double"))


def _long(df: DataFrame, columns: Sequence[str], value: Callable[[str], Column], extra: Sequence[str] = ()) -> DataFrame:
    pairs = [
        F.struct(
            F.lit(c).alias("column"), value(c).alias("value"),
            *([F.col(f"__b_{c}").cast("int").alias("bucket")] if extra else []),
        )
        for c in columns
    ]
    return df.select("cell", F.explode(F.array(*pairs)).alias("p")).select("cell", "p.*").where(F.col("value").isNotNull())


def train_quantiles(
    folds: DataFrame, columns: Sequence[str], probs: Sequence[float], split: Sequence[str] = SPLIT,
    trains: Trains = other_folds, cells: Cells | None = None,
) -> DataFrame:
    """Exact interpolated quantiles of every training set: split keys, column, prob, value.

    NULL and NaN are skipped; a training set without values has no row. Values are cut into
    buckets at sketched quantiles and counted by distinct value; only buckets that hold a
    wanted rank of some training set are sorted, so a heavy value is one counted row.
    """
    cells = cells or Cells(folds, split, trains)
    size = len(cells.tests)
    keyed = value_buckets(folds.select(*split, *[_number(c).alias(c) for c in columns]), columns).withColumn("cell", cells.number())
    rows = _long(keyed, columns, F.col, ("bucket",))
    counts = rows.groupBy("column", "bucket", "value").agg(F.array(*cells.per_train(F.count_if)).alias("t"))
    totals = counts.groupBy("column", "bucket").agg(F.array(*[F.sum(F.col("t")[i]) for i in range(size)]).alias("n"))
    upto = Window.partitionBy("column").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("column")
    spans = totals.select(
        "column", "bucket", "n",
        F.array(*[F.coalesce(F.sum(F.col("n")[i]).over(upto), F.lit(0)) for i in range(size)]).alias("first"),
        F.array(*[F.sum(F.col("n")[i]).over(whole) for i in range(size)]).alias("all"),
    )
    per_set = spans.select(
        "column", "bucket", F.posexplode(F.arrays_zip("n", "first", "all")).alias("at", "z")
    ).select("column", "bucket", "at", "z.*", F.explode(F.array(*[F.lit(float(p)) for p in probs])).alias("prob"))
    spot = F.col("prob") * (F.col("all") - 1)
    asks = per_set.where("all > 0").select(
        "column", "bucket", "at", "prob", "first", "n", (spot - F.floor(spot)).alias("part"),
        F.explode(F.array_distinct(F.array(F.floor(spot), F.ceil(spot)))).alias("rank"),
    ).where((F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("first") + F.col("n")))
    needed = asks.groupBy("column", "bucket").agg(
        F.collect_list(F.struct("at", "prob", "part", (F.col("rank") - F.col("first")).alias("rank"))).alias("asks")
    )  # at most two per training set and probability
    seen = Window.partitionBy("column", "bucket").orderBy("value")
    placed = counts.join(F.broadcast(needed), ["column", "bucket"]).select(
        "column", "value", "t", "asks", F.array(*[F.sum(F.col("t")[i]).over(seen) for i in range(size)]).alias("end")
    )
    hit = F.filter("asks", lambda a: (a["rank"] < F.get("end", a["at"])) & (a["rank"] >= F.get("end", a["at"]) - F.get("t", a["at"])))
    found = placed.select("column", "value", F.explode(hit).alias("a")).groupBy("a.at", "column", "a.prob").agg(
        F.min("value").alias("lo"), F.max("value").alias("hi"), F.max("a.part").alias("part")
    )
    return cells.named(
        found.select("at", "column", "prob", (F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("part")).alias("value"))
    )


def train_modes(
    folds: DataFrame, columns: Sequence[str], split: Sequence[str] = SPLIT, trains: Trains = other_folds,
    cells: Cells | None = None,
) -> DataFrame:
    """Most frequent value of every training set as text, the smallest one on a tie: split keys, column, mode."""
    cells = cells or Cells(folds, split, trains)
    rows = _long(folds.withColumn("cell", cells.number()), columns, lambda c: F.col(c).cast("string"))
    counts = rows.groupBy("column", "value").agg(F.array(*cells.per_train(F.count_if)).alias("t"))
    per_set = counts.select("column", "value", F.posexplode("t").alias("at", "n")).where("n > 0")
    best = per_set.groupBy("at", "column").agg(F.min(F.struct((-F.col("n")).alias("n"), "value")).alias("b"))
    return cells.named(best.select("at", "column", F.col("b.value").alias("mode")))


def train_moments(
    folds: DataFrame, columns: Sequence[str], split: Sequence[str] = SPLIT, trains: Trains = other_folds,
    cells: Cells | None = None,
) -> DataFrame:
    """Rows, values, mean and sum of squared deviations of every training set: split keys, column, n, n_values, mean, m2.

    Sums are taken around the overall mean, so that a large offset does not cancel.
    """
    cells = cells or Cells(folds, split, trains)
    plain = folds.select(*split, *[_number(c).alias(c) for c in columns])
    middle = plain.agg(*[F.coalesce(F.avg(c), F.lit(0.0)).alias(f"__a_{c}") for c in columns])
    rows = plain.crossJoin(F.broadcast(middle)).withColumn("cell", cells.number())
    sums = rows.groupBy("cell").agg(
        F.count("*").alias("n"),
        *[F.struct(
            F.lit(c).alias("column"), F.first(f"__a_{c}").alias("a"), F.count(c).alias("v"),
            F.coalesce(F.sum(F.col(c) - F.col(f"__a_{c}")), F.lit(0.0)).alias("s"),
            F.coalesce(F.sum((F.col(c) - F.col(f"__a_{c}")) * (F.col(c) - F.col(f"__a_{c}"))), F.lit(0.0)).alias("q"),
        ).alias(f"__m_{c}") for c in columns],
    ).select("cell", "n", F.explode(F.array(*[F.col(f"__m_{c}") for c in columns])).alias("m")).select("cell", "n", "m.*")
    trained = sums.groupBy("column").agg(
        F.first("a").alias("a"),
        F.array(*cells.per_train(lambda mine: F.struct(*[
            F.sum(F.when(mine, F.col(c))).alias(c) for c in ("n", "v", "s", "q")
        ]))).alias("t"),
    ).select("column", "a", F.posexplode("t").alias("at", "t")).select("column", "a", "at", "t.*")
    off = F.col("s") / F.nullif(F.col("v"), F.lit(0))
    return cells.named(trained.select(
        "at", "column", "n", F.col("v").alias("n_values"), (F.col("a") + off).alias("mean"),
        F.greatest(F.col("q") - off * F.col("s"), F.lit(0.0)).alias("m2"),
    ))


def fit(
    folds: DataFrame, numeric: Sequence[str], text: Sequence[str] = (), split: Sequence[str] = SPLIT,
    trains: Trains = other_folds,
) -> DataFrame:
    """What each training set teaches: split keys, column, ``fill`` (median), ``mode``, ``mean`` and ``spread`` after filling.

    ``spread`` is the population deviation of the filled column. Numeric columns have no
    ``mode``, text columns only that.
    """
    folds = cut_lineage(folds.select(*split, *numeric, *text))  # read by every statistic
    cells = Cells(folds, split, trains)
    out = None
    if numeric:
        middle = train_quantiles(folds, numeric, [0.5], split, trains, cells).select(*split, "column", F.col("value").alias("fill"))
        both = train_moments(folds, numeric, split, trains, cells).join(middle, [*split, "column"], "left")
        share = (F.col("n") - F.col("n_values")) / F.col("n")
        gap = F.col("fill") - F.col("mean")
        out = both.select(
            *split, "column", "fill", F.lit(None).cast("string").alias("mode"),
            (F.col("mean") + share * gap).alias("mean"),
            F.sqrt(F.col("m2") / F.col("n") + (1 - share) * share * gap * gap).alias("spread"),
        )
    if text:
        none = F.lit(None).cast("double")
        modes = train_modes(folds, text, split, trains, cells).select(
            *split, "column", none.alias("fill"), "mode", none.alias("mean"), none.alias("spread")
        )
        out = modes if out is None else out.unionByName(modes)
    return out


def apply(rows: DataFrame, learned: Sequence[dict], numeric: Sequence[str], text: Sequence[str] = (), scale: bool = True) -> DataFrame:
    """Rows filled and scaled by what one training set taught: ``learned`` is that set's part of ``fit``, one entry per column."""
    by = {r["column"]: r for r in learned}
    made = {}
    for c in numeric:
        own = by.get(c)
        filled = _number(c)
        if own is not None and own["fill"] is not None:
            filled = F.coalesce(filled, F.lit(float(own["fill"])))
            if scale:
                filled = standardized(filled, F.lit(own["mean"]), F.lit(own["spread"]))
        made[c] = filled
    for c in text:
        own = by.get(c)
        made[c] = F.coalesce(F.col(c).cast("string"), F.lit(own["mode"] if own is not None else None))
    return rows.withColumns(made)
