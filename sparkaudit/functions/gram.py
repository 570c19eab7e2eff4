"""Sums over pairs of columns, by matrix products per Arrow batch.

An aggregate per pair of columns makes a plan that grows with the square of their number.
Here a task multiplies the columns of each batch with each other, around the means of its
first rows, and gives one set of matrices; these are merged two by two, each moved to the
other's centre, so that a large offset never cancels.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string


class Sums:
    """n, sums, squares and products of every pair of columns over the rows that have both, around ``centre``.

    ``first[i, j]`` sums column i over rows that also have column j, ``square`` likewise.
    """

    __slots__ = ("centre", "n", "first", "square", "cross")

    def __init__(self, width: int):
        self.centre = np.zeros(width)
        self.n, self.first, self.square, self.cross = (np.zeros((width, width)) for _ in range(4))

    def add(self, x: np.ndarray) -> None:
        """Rows of values, NaN where one is missing."""
        there = ~np.isnan(x)
        fresh = (np.diag(self.n) == 0) & there.any(0)
        if fresh.any():  # nothing is summed in these columns yet, so their centre is free
            own = x[:, fresh]
            low, high = np.nanmin(own, 0), np.nanmax(own, 0)
            self.centre[fresh] = np.where(low == high, low, np.nanmean(own, 0))
        d = np.where(there, x - self.centre, 0.0)
        m = there.astype(float)
        self.n += m.T @ m
        self.first += d.T @ m
        self.square += (d * d).T @ m
        self.cross += d.T @ d


def _rows_of(parts: Iterable[pa.RecordBatch], keys: int, width: int) -> Iterator[tuple[tuple, np.ndarray]]:
    """(key, matrix) of each group of rows of a batch."""
    for part in parts:
        if not part.num_rows:
            continue
        x = part.column(keys).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
        if not keys:
            yield (), x
            continue
        numbers: dict[tuple, int] = {}
        code = np.fromiter((numbers.setdefault(k, len(numbers)) for k in zip(*[part.column(i).to_pylist() for i in range(keys)])), np.int64, part.num_rows)
        for key, c in numbers.items():
            yield key, x[code == c]


def pair_sums(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """One row per (by, column i): ``i``, ``centre`` (of all columns) and the arrays n, first, other, square, other_square, cross over j.

    ``first`` sums column i, ``other`` column j, over the rows that have both; NULL and NaN
    are missing. One scan; every task sends as many rows as columns, and rows of
    the same i are merged as they arrive.
    """
    names, keys, width = list(columns), list(by), len(columns)
    filled = [F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))) for c in names]
    source = df.select(*keys, F.array(*filled).alias("__x"))
    arrays = ["n", "first", "other", "square", "other_square", "cross"]
    fields = ", ".join(f"{c} array<double>" for c in arrays)
    schema = StructType([*source.schema.fields[:-1], *_parse_datatype_string(f"i int, centre array<double>, {fields}").fields])
    arrow = to_arrow_schema(schema)

    def batch(key: tuple, i: int, made: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([dict(zip(arrow.names, [*key, i, *made]))], schema=arrow)

    def summed(parts):
        held: dict[tuple, Sums] = {}
        for key, x in _rows_of(parts, len(keys), width):
            held.setdefault(key, Sums(width)).add(x)
        for key, s in held.items():
            for i in range(width):
                yield batch(key, i, [s.centre, s.n[i], s.first[i], s.first[:, i], s.square[i], s.square[:, i], s.cross[i]])

    def joined(parts):
        at, own = None, None
        for part in parts:
            lead = list(zip(*[c.to_pylist() for c in part.columns[: len(keys) + 1]]))
            for r, key in enumerate(lead):
                new = [c[r].values.to_numpy() for c in part.columns[len(keys) + 1 :]]
                if key != at:
                    if own is not None:
                        yield batch(at[:-1], at[-1], own)
                    at, own = key, new
                else:
                    own = _merged_row(own, new, key[-1])
        if own is not None:
            yield batch(at[:-1], at[-1], own)

    tasks = source.mapInArrow(summed, schema)
    return tasks.repartition(*keys, "i").sortWithinPartitions(*keys, "i").mapInArrow(joined, schema)


def _merged_row(a: list, b: list, i: int) -> list:
    """Sums of column i with all others from two sets, around the centre of the first that has the column."""
    centre = np.where((a[1] == 0) & (b[1] > 0), b[0], a[0])
    if a[1][i] == 0 and b[1][i] > 0:
        centre[i] = b[0][i]
    out = [centre]
    sums = []
    for own in (a, b):
        by = own[0] - centre
        n, first, other, square, other_square, cross = own[1:]
        mine = by[i]
        sums.append((
            n, first + n * mine, other + n * by, square + 2 * mine * first + n * mine * mine,
            other_square + 2 * by * other + n * by * by, cross + mine * other + by * first + n * mine * by,
        ))
    return out + [x + y for x, y in zip(*sums)]


def correlations(sums: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(x, y, r) of all ordered pairs; r is NULL where a side is constant or empty."""
    name = F.array(*[F.lit(c) for c in columns])
    cells = sums.select("i", F.posexplode(F.arrays_zip("n", "first", "other", "square", "other_square", "cross")).alias("j", "s"))
    n = F.nullif(F.col("s.n"), F.lit(0.0))
    a = F.col("s.square") - F.col("s.first") * F.col("s.first") / n
    b = F.col("s.other_square") - F.col("s.other") * F.col("s.other") / n
    both = F.sqrt(F.greatest(a, F.lit(0.0))) * F.sqrt(F.greatest(b, F.lit(0.0)))
    r = (F.col("s.cross") - F.col("s.first") * F.col("s.other") / n) / F.nullif(both, F.lit(0.0))
    return cells.select(F.get(name, F.col("i")).alias("x"), F.get(name, F.col("j")).alias("y"), r.alias("r"))
