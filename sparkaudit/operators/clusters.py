"""Quality of clusterings of the same vectors, all of them from two scans.

The mean squared distance of a vector to a cluster follows from the cluster's size, sum of
vectors and sum of squared lengths. One scan gathers these for every cluster of every
clustering, a second one scores each vector against them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Centres = Mapping[int, Sequence[Sequence[float]]]


def _vectors(parts):
    """Matrices of the complete vectors in batches; NULL vectors are left out."""
    for part in parts:
        column = part.column(0).drop_null()
        if len(column):
            yield column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _nearest(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Closest centre of each vector (the first of equals) and the squared distance to it."""
    d = (x * x).sum(1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(1)[None, :]
    own = d.argmin(1)
    return own, np.maximum(d[np.arange(len(x)), own], 0.0)


def cluster_moments(df: DataFrame, vector: str, centres: Centres) -> DataFrame:
    """(k, cluster, n, length, total, cost) of every cluster that holds a vector, for all clusterings in one scan.

    ``length`` sums squared lengths, ``total`` the vectors, ``cost`` squared distances to the centre.
    """
    fixed = {int(k): np.asarray(c, float) for k, c in centres.items()}

    def run(parts):
        sums: dict[tuple[int, int], list] = {}
        for x in _vectors(parts):
            for k, c in fixed.items():
                own, d = _nearest(x, c)
                for i in np.unique(own).tolist():
                    mine = own == i
                    new = [int(mine.sum()), float((x[mine] ** 2).sum()), x[mine].sum(0), float(d[mine].sum())]
                    old = sums.get((k, i))
                    sums[k, i] = new if old is None else [a + b for a, b in zip(old, new)]
        rows = [(k, i, n, length, total.tolist(), cost) for (k, i), (n, length, total, cost) in sums.items()]
        names = ["k", "cluster", "n", "length", "total", "cost"]
        types = [pa.int32(), pa.int32(), pa.int64(), pa.float64(), pa.list_(pa.float64()), pa.float64()]
        yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], t) for j, t in enumerate(types)], names=names)

    source = df.select(F.col(vector).cast("array<double>").alias("x"))
    parts = source.mapInArrow(run, "k int, cluster int, n bigint, length double, total array<double>, cost double")
    width = F.size(F.first("total"))
    added = F.transform(F.sequence(F.lit(0), width - 1), lambda i: F.aggregate(F.collect_list("total"), F.lit(0.0), lambda t, v: t + F.get(v, i)))
    return parts.groupBy("k", "cluster").agg(  # one row per task in a group
        F.sum("n").alias("n"), F.sum("length").alias("length"), added.alias("total"), F.sum("cost").alias("cost")
    )


def silhouettes(df: DataFrame, vector: str, centres: Centres) -> DataFrame:
    """(k, silhouette, cost) of each clustering by nearest centres, with squared distances.

    A vector alone in its cluster scores 0. With one cluster in use there is no other one to
    compare with, and the silhouette is NULL. The moments (one row per cluster) are collected.
    """
    found: dict[int, list] = {}
    for r in cluster_moments(df, vector, centres).orderBy("k", "cluster").collect():
        found.setdefault(r["k"], []).append((r["cluster"], r["n"], r["length"], r["total"], r["cost"]))
    fixed = {int(k): np.asarray(c, float) for k, c in centres.items()}

    def run(parts):
        total = {k: [0.0, 0] for k in found}
        for x in _vectors(parts):
            square = (x * x).sum(1)
            for k, rows in found.items():
                if len(rows) < 2:
                    continue
                own = np.searchsorted([r[0] for r in rows], _nearest(x, fixed[k])[0])
                n, length = (np.array([r[j] for r in rows], float) for j in (1, 2))
                sums = square[:, None] * n + length - 2 * x @ np.array([r[3] for r in rows]).T
                mean = sums / n
                at = np.arange(len(x))
                a = sums[at, own] / np.maximum(n[own] - 1, 1)
                mean[at, own] = np.inf
                b = mean.min(1)
                top = np.maximum(a, b)
                score = np.where((n[own] > 1) & (top > 0), (b - a) / np.where(top > 0, top, 1), 0.0)
                total[k][0] += float(score.sum())
                total[k][1] += len(x)
        rows = [(k, s, n) for k, (s, n) in total.items() if n]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.float64()), pa.array([r[2] for r in rows], pa.int64())],
            names=["k", "s", "n"],
        )

    spark = df.sparkSession
    costs = spark.createDataFrame([(k, float(sum(r[4] for r in rows))) for k, rows in found.items()], "k int, cost double")
    parts = df.select(F.col(vector).cast("array<double>").alias("x")).mapInArrow(run, "k int, s double, n bigint")
    scored = parts.groupBy("k").agg((F.sum("s") / F.sum("n")).alias("silhouette"))
    return costs.join(scored, "k", "left").select("k", "silhouette", "cost")
