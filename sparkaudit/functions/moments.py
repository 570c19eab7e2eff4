"""NULL-safe statistics from one-pass aggregates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pearson(x: Column, y: Column) -> Column:
    """Pairwise-complete correlation; NULL where a side is constant or empty."""
    xv = F.when(y.isNotNull(), x).cast("double")
    yv = F.when(x.isNotNull(), y).cast("double")
    spread = F.stddev_pop(xv) * F.stddev_pop(yv)
    return F.covar_pop(xv, yv) / F.nullif(spread, F.lit(0.0))


def standardized(x: Column, mean: Column, sd: Column) -> Column:
    """(x - mean) / sd, with a zero spread treated as one."""
    return (x - mean) / F.coalesce(F.nullif(sd, F.lit(0.0)), F.lit(1.0))
