"""Exact order statistics, one way for every size.

``percentile`` keeps every distinct value of a group in one buffer. Here values are cut
into buckets of about equal size (sketch cut points, applied with ``Bucketizer``),
counted by distinct value before the shuffle, and only the buckets that hold a wanted
rank are sorted. A heavy value is one counted row, so it never fills a bucket. NULL and
NaN are skipped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BUCKETS = 1024
SORT_LIMIT = 1_000_000  # distinct values that one task sorts; a larger bucket is cut again


def value_buckets(df: DataFrame, columns: Sequence[str], buckets: int = BUCKETS, on_cut: bool = False) -> DataFrame:
    """Add ``__b_<column>``: an order-preserving bucket number per column.

    The cut points are literals in the plan, so a recomputed task sees the same. With
    ``on_cut`` a column ``__c_<column>`` tells whether the value is its bucket's lower cut
    point, as every value is that fills a bucket of its own.
    """
    doubles = df.select("*", *[F.col(c).cast("double").alias(f"__d_{c}") for c in columns])
    probes = ", ".join(f"{i / buckets}D" for i in range(1, buckets))
    sketch = doubles.agg(
        *[F.expr(f"percentile_approx(`__d_{c}`, array({probes}), {4 * buckets})") for c in columns]
    ).first()
    splits = [[float("-inf"), *sorted(set(c or [])), float("inf")] for c in sketch]
    splits = [s if len(s) > 2 else [float("-inf"), 0.0, float("inf")] for s in splits]
    stage = Bucketizer(
        splitsArray=splits,
        inputCols=[f"__d_{c}" for c in columns],
        outputCols=[f"__b_{c}" for c in columns],
        handleInvalid="keep",
    )
    out = stage.transform(doubles)
    if on_cut:
        for c, cuts in zip(columns, splits):
            lower = F.get(F.array(*[F.lit(x) for x in cuts]), F.col(f"__b_{c}").cast("int"))
            out = out.withColumn(f"__c_{c}", F.col(f"__d_{c}") == lower)
    return out.drop(*[f"__d_{c}" for c in columns])


def quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    by: Sequence[str] = (),
    buckets: int = BUCKETS,
    weight: str | None = None,
) -> DataFrame:
    """Linear-interpolated quantiles, long form: ``by``, column, prob, value.

    NULLs are skipped; one scan serves all columns. ``weight`` names a column of
    whole repeat counts.
    """
    by = list(by)
    extra = [weight] if weight else []
    keyed = value_buckets(df.select(*by, *extra, *columns), columns, buckets)
    size = F.sum(weight) if weight else F.count("*")
    cells = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(c).alias("column"),
                    F.col(f"__b_{c}").cast("int").alias("bucket"),
                    F.col(c).cast("double").alias("value"),
                )
                for c in columns
            ]
        )
    ).alias("cell")
    counts = (
        keyed.select(*by, *extra, cells)
        .select(*by, *extra, "cell.*")
        .where(F.col("value").isNotNull() & ~F.isnan("value"))
        .groupBy(*by, "column", "bucket", "value")
        .agg(size.alias("n"))
    )
    key = [*by, "column"]
    totals = counts.groupBy(*key, "bucket").agg(F.sum("n").alias("bucket_n"))
    upto = Window.partitionBy(*key).orderBy("bucket")
    spans = totals.select(
        *key,
        "bucket",
        (F.sum("bucket_n").over(upto) - F.col("bucket_n")).alias("first"),
        F.sum("bucket_n").over(upto).alias("end"),
        F.sum("bucket_n").over(Window.partitionBy(*key)).alias("total"),
    )
    wanted = spans.select("*", F.explode(F.array(*[F.lit(float(p)) for p in probs])).alias("prob"))
    spot = F.col("prob") * (F.col("total") - 1)
    wanted = wanted.select(
        *key, "bucket", "first", "prob", spot.alias("spot"),
        F.explode(F.array_distinct(F.array(F.floor(spot), F.ceil(spot)))).alias("rank"), "end",
    ).where((F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("end")))
    needed = wanted.groupBy(*key, "bucket", "first").agg(
        F.collect_list(F.struct("prob", "spot", "rank")).alias("asks")
    )
    if not by:  # a few rows per column
        needed = F.broadcast(needed)
    hit = _semi_rows(counts, needed, [*key, "bucket"])
    seen = Window.partitionBy(*key, "bucket").orderBy("value")
    placed = hit.select(
        *key, "value", "asks",
        (F.col("first") + F.sum("n").over(seen)).alias("upto"),
        (F.col("first") + F.sum("n").over(seen) - F.col("n")).alias("from"),
    )
    asks = placed.select(*key, "value", "from", "upto", F.explode("asks").alias("ask")).where(
        (F.col("ask.rank") >= F.col("from")) & (F.col("ask.rank") < F.col("upto"))
    )
    picked = asks.groupBy(*key, F.col("ask.prob").alias("prob")).agg(
        F.min("value").alias("lo"),
        F.max("value").alias("hi"),
        F.max(F.col("ask.spot") - F.floor("ask.spot")).alias("part"),
    )
    return picked.select(
        *key, "prob", (F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("part")).alias("value")
    )


def _semi_rows(counts: DataFrame, needed: DataFrame, keys: Sequence[str]) -> DataFrame:
    other = needed.withColumnsRenamed({k: f"__n_{k}" for k in keys})
    cond = F.lit(True)
    for k in keys:
        cond = cond & counts[k].eqNullSafe(other[f"__n_{k}"])
    return counts.join(other, cond).drop(*[f"__n_{k}" for k in keys])


def quantile_columns(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    by: Sequence[str] = (),
    weight: str | None = None,
) -> DataFrame:
    """``quantiles`` with one row per (by, column) and an array ``q`` in order of ``probs``."""
    long = quantiles(df, columns, probs, by, weight=weight)
    return long.groupBy(*by, "column").agg(
        F.array(*[F.max(F.when(F.col("prob") == float(p), F.col("value"))) for p in probs]).alias("q")
    )


def order_statistics(df: DataFrame, column: str, tie: str, ranks: Sequence[int]) -> list[tuple]:
    """The (column, tie) pairs at 0-based ranks of the (column, tie) order.

    Two bounded selections: the values first, then the tie-breakers among equal values.
    """
    values = _select_ranks(df, column, ranks)
    marks = sorted(set(values))
    below = df.agg(
        *[F.count_if(F.col(column) < F.lit(m)) for m in marks],
        *[F.count_if(F.col(column) == F.lit(m)) for m in marks],
        *[F.max(F.when(F.col(column) == F.lit(m), F.col(tie))) for m in marks],
    ).first()
    stats = {m: (below[i], below[len(marks) + i], below[2 * len(marks) + i]) for i, m in enumerate(marks)}
    out = []
    for rank, value in zip(ranks, values):
        before, same, only = stats[value]
        if same > 1:
            only = _select_ranks(df.where(F.col(column) == F.lit(value)), tie, [rank - before])[0]
        out.append((value, only))
    return out


def _select_ranks(df: DataFrame, column: str, ranks: Sequence[int]) -> list:
    """Values at 0-based ranks."""
    values = df.select(column).where(F.col(column).isNotNull())
    return _ranks_in(values.groupBy(column).agg(F.count("*").alias("n")), column, sorted(set(ranks)), list(ranks))


def _ranks_in(counts: DataFrame, column: str, wanted: list[int], ranks: list[int]) -> list:
    """Ranks over distinct values and their counts; buckets hold about equally many distinct
    values, so cutting a large one again always gets on, whatever the weight of a value."""
    keyed = value_buckets(counts, [column]).withColumnRenamed(f"__b_{column}", "bucket")
    totals = keyed.groupBy("bucket").agg(
        F.sum("n").alias("n"), F.count("*").alias("kinds"), F.min(column).alias("lo"), F.max(column).alias("hi")
    )
    found: dict[int, object] = {}
    asks: dict[int, list[tuple[int, int]]] = {}
    spans, first = {}, 0
    for span in sorted(totals.collect(), key=lambda r: r["bucket"]):  # at most BUCKETS rows
        for rank in wanted:
            if first <= rank < first + span["n"]:
                if span["lo"] == span["hi"]:
                    found[rank] = span["lo"]
                else:
                    asks.setdefault(span["bucket"], []).append((rank, rank - first))
                    spans[span["bucket"]] = span
        first += span["n"]
    small = [b for b in asks if spans[b]["kinds"] <= SORT_LIMIT]
    if small:
        upto = F.sum("n").over(Window.partitionBy("bucket").orderBy(column))
        placed = keyed.where(F.col("bucket").isin(small)).select("bucket", column, upto.alias("end"))
        asked = [(b, rank, at) for b in small for rank, at in asks[b]]
        row = placed.agg(
            *[F.min(F.when((F.col("bucket") == b) & (F.col("end") > at), F.col(column))) for b, _, at in asked]
        ).first()
        found.update({rank: row[i] for i, (_, rank, _) in enumerate(asked)})
    for b in set(asks) - set(small):
        inside = counts.where(F.col(column).between(F.lit(spans[b]["lo"]), F.lit(spans[b]["hi"])))
        at = [at for _, at in asks[b]]
        deeper = _ranks_in(inside, column, at, at)
        found.update({rank: x for (rank, _), x in zip(asks[b], deeper)})
    return [found[r] for r in ranks]
