"""Bounded samples of labelled documents for fitting a model on the driver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


_DRAWS = 1 << 40


def drawn(rows: DataFrame, key: Column, n: int, seed: int) -> DataFrame:
    """About ``2 n`` rows by a seeded hash of the key, which is added as ``__draw``; all rows of a small table.

    Taking the ``n`` smallest draws of these takes them from all rows, but no task sends
    ``n`` rows of its own.
    """
    total = rows.count()
    draw = F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(_DRAWS))
    return rows.withColumn("__draw", draw).where(F.col("__draw") < F.lit(int(min(1.0, (2 * n + 200) / max(1, total)) * _DRAWS)))


def labelled(
    docs: DataFrame, labels: DataFrame, label: str, rows: Sequence[tuple[Column, int]], key: str = "doc_id",
    text: str = "text", seed: int = 11,
) -> list[tuple[str, int]]:
    """(text, label) of at most ``n`` labelled rows for each ``(condition, n)`` on the label.

    Rows are drawn by a seeded hash of the key, so the draw is repeatable. The labels of
    the draw are bounded, and so is what reaches the driver; texts are taken whole, null
    texts as "". Rows without key or label are never drawn. A document that is present
    several times is used at most as often as the bound allows.
    """
    picked = labels.select(F.col(key).alias("__k"), F.col(label).cast("int").alias("__y")).dropna()
    texts = docs.select(F.col(key).alias("__d"), F.coalesce(F.col(text), F.lit("")).alias("__t"))
    out: list[tuple[str, int]] = []
    for condition, n in rows:
        own = drawn(picked.where(condition), F.col("__k"), n, seed).orderBy("__draw", "__k", "__y").limit(n)
        found = texts.join(F.broadcast(own), F.col("__d") == F.col("__k")).orderBy("__draw", "__y", "__t").limit(n)
        out += [(r["__t"], r["__y"]) for r in found.select("__t", "__y").collect()]
    return out
