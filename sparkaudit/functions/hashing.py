"""Deterministic pseudo-random values that any SQL engine can reproduce.

The first 32 bits of an MD5 digest stand in for a random draw, so folds,
bootstrap draws and shuffles are the same on every run and after a lost task.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_RANGE = 4294967296  # 2 ** 32


def hash32(*parts) -> Column:
    """Integer in [0, 2**32) derived from the given columns or literals."""
    cols = [p if isinstance(p, Column) else F.lit(p) for p in parts]
    text = F.concat_ws(":", *[c.cast("string") for c in cols])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def uniform(*parts) -> Column:
    """Double in [0, 1) derived from the given columns or literals."""
    return hash32(*parts) / F.lit(float(HASH_RANGE))
