"""Ranks and running aggregates that never sort a whole group in one task.

A window over ``partition by g order by x`` puts all rows of a hot group in one
task. Here every group is first cut into chunks by a coarse, order-preserving
key: chunk totals are aggregated (with map-side combine), a window over these
few totals yields each chunk's starting state, and only rows of the same chunk
are sorted together.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HASH_CHUNK_BITS = 12


def _null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    renamed = right.select(
        *[F.col(k).alias(f"__r_{k}") for k in keys],
        *[c for c in right.columns if c not in keys],
    )
    cond = F.lit(True)
    for k in keys:
        cond = cond & left[k].eqNullSafe(renamed[f"__r_{k}"])
    return left.join(renamed, cond, how).drop(*[f"__r_{k}" for k in keys])


def running(
    df: DataFrame,
    by: Sequence[str],
    chunk: Column,
    order: Sequence[Column | str],
    totals: Mapping[str, tuple[str, str]],
) -> DataFrame:
    """Running aggregates over the rows that come *before* the current one.

    ``chunk`` must be non-decreasing in ``order``. ``totals`` maps an output
    name to ``(kind, column)`` with kind ``sum``, ``max``, ``min`` or ``count``.
    The first row of a group gets 0 for sums and counts, NULL for max and min.
    """
    by = list(by)
    whole = {"sum": F.sum, "max": F.max, "min": F.min, "count": F.count}
    rows = df.withColumn("__chunk", chunk)
    per_chunk = rows.groupBy(*by, "__chunk").agg(
        *[whole[kind](F.col(c)).alias(f"__t_{name}") for name, (kind, c) in totals.items()]
    )
    before_chunk = Window.partitionBy(*by).orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_chunk.select(
        *by,
        "__chunk",
        *[
            whole["sum" if kind == "count" else kind](F.col(f"__t_{name}")).over(before_chunk).alias(f"__s_{name}")
            for name, (kind, _) in totals.items()
        ],
    )
    joined = _null_safe_join(rows, starts, [*by, "__chunk"])
    in_chunk = (
        Window.partitionBy(*by, "__chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    )
    merged = []
    for name, (kind, c) in totals.items():
        start, here = F.col(f"__s_{name}"), whole[kind](F.col(c)).over(in_chunk)
        if kind in ("sum", "count"):
            value = F.coalesce(start, F.lit(0)) + F.coalesce(here, F.lit(0))
        elif kind == "max":
            value = F.greatest(start, here)
        else:
            value = F.least(start, here)
        merged.append(value.alias(name))
    return joined.select(*df.columns, *merged)


def position(
    df: DataFrame, by: Sequence[str], chunk: Column, order: Sequence[Column | str], out: str
) -> DataFrame:
    """0-based row number of each row within its group."""
    one = df.withColumn("__one", F.lit(1).cast("bigint"))
    return running(one, by, chunk, order, {out: ("sum", "__one")}).drop("__one")


def hash_position(df: DataFrame, by: Sequence[str], hash_col: str, tie: str, out: str) -> DataFrame:
    """0-based rank of a 32-bit hash; its leading bits give equally filled chunks."""
    chunk = F.shiftright(F.col(hash_col), 32 - HASH_CHUNK_BITS)
    return position(df, by, chunk, [hash_col, tie], out)
