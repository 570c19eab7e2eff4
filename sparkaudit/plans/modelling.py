"""Queries: Spark ML models on the derived tables, always on all rows of a fold."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import clusters, linear, metrics, models, robustness
from ..sources.tables import read_table
from . import views as v
from .catalog import query

NUM, TXT = ["n_chars", "junk_share", "toxic"], ["lang", "source"]
ONE_SEED_SPLITS = [(42, fold) for fold in range(5)]


def _levels(column: str) -> str:
    return f"(SELECT list(DISTINCT {column} ORDER BY {column}) FROM v_quality WHERE {column} IS NOT NULL)"


def _hot(column: str) -> str:
    """0 / 1 per level in order, then the slot of unknown levels."""
    return f"list_concat(list_transform({_levels(column)}, lambda x: (x = {column})::INT::DOUBLE), [0.0::DOUBLE])"


def _slots(column: str) -> str:
    return f"""SELECT unnest({_levels(column)}) AS x, '{column}' AS c UNION ALL SELECT '__unknown', '{column}'"""


#: Mean of each slot: scaled numbers centre at 0, levels have their share, the unknown slot is empty.
F5_SQL = f"""
SELECT (row_number() OVER (ORDER BY part, x = '__unknown', x) - 1)::INT AS slot, feature, mean FROM (
  SELECT part, '' AS x, '__num_' || ['n_chars', 'junk_share', 'toxic'][part] AS feature, 0.0::DOUBLE AS mean FROM range(1, 4) r(part)
  UNION ALL SELECT 4, x, 'lang__h_' || x, round((SELECT avg((lang = x)::INT) FROM v_quality), 9) FROM ({_slots("lang")})
  UNION ALL SELECT 5, x, 'source__h_' || x, round((SELECT avg((source = x)::INT) FROM v_quality), 9) FROM ({_slots("source")}))"""


@query("f4_one_hot", f"SELECT doc_id, list_concat({_hot('lang')}, {_hot('source')}) AS features FROM v_quality", views="v_quality")
def f4(spark, sf):
    df = v.quality(spark, sf)
    out = models.assemble(df, [], ["lang", "source"])
    return out.select("doc_id", models.vector_to_array("features").alias("features"))


@query("f5_assemble", F5_SQL, views="v_quality")
def f5(spark, sf):
    """Slot names of the assembled vector with the mean of each slot."""
    out = models.assemble(v.quality(spark, sf), NUM, TXT)
    names = models.feature_names(out)
    slots = out.select(F.posexplode(models.vector_to_array("features")).alias("slot", "x"))
    label = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("slot") + 1)
    mean = F.round(F.avg("x"), 9) + F.lit(0.0)  # no negative zero
    return slots.groupBy("slot").agg(mean.alias("mean")).withColumn("feature", label)


def _oof(spark, sf, model, label="quality", task="classification", trees=10, depth=4):
    return models.out_of_fold(
        v.quality_one_seed(spark, sf), "doc_id", ["n_chars", "junk_share", "toxic"] if label == "quality" else ["junk_share", "toxic"],
        TXT, label, model, task, "quality", ONE_SEED_SPLITS, trees=trees, depth=depth,
    )


@query("h6_logistic_regression")
def h6(spark, sf):
    return metrics.scores(_oof(spark, sf, "LogisticRegression"), ["accuracy", "roc_auc"])


@query("h7_random_forest")
def h7(spark, sf):
    return metrics.scores(_oof(spark, sf, "RandomForest"), ["accuracy", "roc_auc"])


@query("h8_random_forest_regressor")
def h8(spark, sf):
    return metrics.scores(_oof(spark, sf, "RandomForest", "n_chars", "regression"), ["neg_root_mean_squared_error", "r2"])


@query("h9_boosted_trees")
def h9(spark, sf):
    return metrics.scores(_oof(spark, sf, "XGBoost", trees=5, depth=3), ["accuracy", "roc_auc"])


@query("h10_boosted_regressor")
def h10(spark, sf):
    return metrics.scores(
        _oof(spark, sf, "LightGBM", "n_chars", "regression", trees=5, depth=3), ["neg_root_mean_squared_error"]
    )


@query("l4_model_lofo")
def l4_model(spark, sf):
    """Leave-one-feature-out with refits of an ML model, all folds and features."""
    preds = models.leave_one_out(
        v.quality_one_seed(spark, sf), "doc_id", NUM, TXT, "quality", "LogisticRegression",
        "classification", "quality", ONE_SEED_SPLITS,
    )
    scored = metrics.score_wide(preds, ["accuracy"], ["feature_set", "seed", "fold"])
    return robustness.lofo_classes(linear.lofo(scored, "accuracy"))


@query("h12_kmeans_scan")
def h12(spark, sf):
    """K-means for k = 3..8 with silhouette (the I8 metric)."""
    return models.kmeans_scan(read_table(spark, sf, "embeddings"), "embedding")


GIVEN = (3, 4, 5)

#: Centres are the vectors with the smallest ids; squared distances by products of lists.
SILHOUETTE = """WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings WHERE embedding IS NOT NULL),
  c AS (SELECT k, row_number() OVER (PARTITION BY k ORDER BY vec_id) - 1 AS cluster, x AS c
        FROM (SELECT *, row_number() OVER (ORDER BY vec_id) AS r FROM e), (SELECT unnest([3, 4, 5]) AS k) WHERE r <= k),
  a AS (SELECT k, vec_id, x, arg_min(cluster, (list_sum(list_transform(range(1, 65), lambda i: (x[i] - c[i]) ** 2)), cluster)) AS own,
               min(list_sum(list_transform(range(1, 65), lambda i: (x[i] - c[i]) ** 2))) AS d FROM e, c GROUP BY ALL),
  far AS (SELECT a.k, a.vec_id, a.own, b.own AS other, count(*) AS n, sum(list_sum(list_transform(range(1, 65), lambda i: (a.x[i] - b.x[i]) ** 2))) AS s
          FROM a JOIN a b ON a.k = b.k GROUP BY ALL),
  s AS (SELECT k, vec_id, max(n) FILTER (other = own) AS n, max(s / greatest(n - 1, 1)) FILTER (other = own) AS a, min(s / n) FILTER (other <> own) AS b FROM far GROUP BY k, vec_id)
  SELECT s.k::INT AS k, round(avg(CASE WHEN n = 1 THEN 0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette, round(any_value(cost), 4) AS cost
  FROM s JOIN (SELECT k, sum(d) AS cost FROM a GROUP BY k) USING (k) GROUP BY s.k"""


@query("i8_silhouettes", SILHOUETTE)
def i8(spark, sf):
    """Clusterings around given centres, judged together."""
    vectors = read_table(spark, sf, "embeddings")
    first = vectors.where(F.col("embedding").isNotNull()).orderBy("vec_id").limit(max(GIVEN)).collect()
    centres = {k: [list(r["embedding"]) for r in first[:k]] for k in GIVEN}
    found = clusters.silhouettes(vectors, "embedding", centres)
    return found.select("k", F.round("silhouette", 6).alias("silhouette"), F.round("cost", 4).alias("cost"))


@query("h15_top_importances")
def h15(spark, sf):
    df = v.quality(spark, sf)
    return models.top_importances(df, models.fit(df, NUM, TXT, "quality", "RandomForest", "classification", 20))


@query("h16_top_coefficients")
def h16(spark, sf):
    df = v.quality(spark, sf)
    return models.top_coefficients(df, models.fit(df, NUM, TXT, "quality", "LogisticRegression", "classification"))
