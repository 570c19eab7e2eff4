"""Queries: sources, profile, features, rates, correlation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.tails import chi2_tail, f_tail, t_tail
from ..operators import features as fe
from ..operators import profile, rates, signal
from ..session import work_folder
from ..sources import notes, sinks
from ..sources.notebooks import NOTEBOOK_SCHEMA, cells_of, output_text
from ..sources.tables import file_report, latest_per_key, read_delimited, read_table
from . import views as v
from .catalog import query

QUALITY_NUM = ["n_chars", "junk_n", "junk_share", "toxic"]
LINE_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def long_sql(source: str, columns: list[str], body: str) -> str:
    """One SELECT per column; ``{c}`` stands for the column."""
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {body.replace('{c}', c)} FROM {source}" for c in columns
    )


# ---- sources -------------------------------------------------------------------

def _csv_copy(spark, sf):
    """The customer table as a folder of CSV files, read back under its schema."""
    src = read_table(spark, sf, "customer")
    folder = work_folder(spark, "csv")
    src.write.option("header", True).csv(folder)
    return read_delimited(spark, folder, src.schema)


@query("a1_read_delimited", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def a1(spark, sf):
    return _csv_copy(spark, sf)


@query(
    "a2_file_report",
    """SELECT 1::BIGINT AS n_files, count(*) AS n_rows, 5::BIGINT AS n_columns,
              count(*) FILTER (c_name IS NULL) AS null_c_name, count(*) FILTER (c_acctbal IS NULL) AS null_c_acctbal
       FROM customer""",
)
def a2(spark, sf):
    src = read_table(spark, sf, "customer")
    folder = work_folder(spark, "csv")
    src.coalesce(1).write.option("header", True).csv(folder)
    per_file = file_report(read_delimited(spark, folder, src.schema), src.columns)
    return per_file.agg(
        F.count("*").alias("n_files"), F.sum("n_rows").alias("n_rows"), F.max("n_columns").alias("n_columns"),
        F.sum("null_c_name").alias("null_c_name"), F.sum("null_c_acctbal").alias("null_c_acctbal"),
    )


@query(
    "a3_notebook_cells",
    """SELECT user_id AS notebook, event_type, count(*) AS n_cells FROM events GROUP BY ALL""",
)
def a3(spark, sf):
    """Every event written as a notebook document and parsed back."""
    ev = read_table(spark, sf, "events")
    cell = F.struct(
        F.lit("code").alias("cell_type"),
        F.array(F.lit("x = 1\n"), F.col("props")).alias("source"),
        F.array(
            F.struct(F.lit("stream").alias("output_type"), F.array(F.col("event_type")).alias("text"))
        ).alias("outputs"),
    )
    folder = work_folder(spark, "notebooks")
    ev.select(F.to_json(F.struct("user_id", F.array(cell).alias("cells")))).write.text(folder)
    docs = spark.read.schema(f"user_id bigint, {NOTEBOOK_SCHEMA}").json(folder)
    cells = cells_of(docs.withColumnRenamed("user_id", "notebook"))
    return cells.groupBy("notebook", F.col("output_text").alias("event_type")).agg(F.count("*").alias("n_cells"))


@query(
    "a4_output_text",
    """SELECT event_id, CASE event_type
         WHEN 'view' THEN 'k=' || (props->>'$.k') || chr(10) || 'done'
         WHEN 'click' THEN '<plain ' || (props->>'$.k') || '>'
         ELSE event_type || chr(10) || 'printed' END AS output_text
       FROM events""",
)
def a4(spark, sf):
    """Text lists, plain data and printouts joined per cell."""
    k = F.get_json_object("props", "$.k")
    null = F.lit(None).cast("string")
    kind = F.col("event_type")
    text = F.when(kind == "view", F.to_json(F.array(F.concat(F.lit("k="), k, F.lit("\n")), F.lit("done")))).when(
        kind != "click", kind
    )
    data = F.struct(F.when(kind == "click", F.concat(F.lit("<plain "), k, F.lit(">"))).alias("text/plain"))
    printout = F.when(~kind.isin("view", "click"), "printed")
    out = F.array(
        F.struct(F.lit("stream").alias("output_type"), text.alias("text"), data.alias("data"), printout.alias("printout"))
    )
    return read_table(spark, sf, "events").select("event_id", output_text(out).alias("output_text"))


@query(
    "a5_plan_info",
    """SELECT run_id, 'run-' || run_id::VARCHAR AS goal,
              regexp_extract(text, '(?m)^- analysis_type: (.*)$', 1) AS analysis_type,
              regexp_extract(text, '(?m)^- target_variable: (.*)$', 1) AS target_variable,
              regexp_extract(text, '(?m)^success_metric: (.*)$', 1) AS success_metric,
              'local' AS execution_env,
              regexp_matches(text, '(?i)time[-\\s]?series|시계열|timeseries') AS is_time_series,
              regexp_matches(text, '(?i)불균형|imbalanced|class\\s*imbalance') AS is_imbalanced_hint,
              len(regexp_extract_all(text, '- constraints:'))::BIGINT AS n_constraints
       FROM v_plans""",
    views="v_plans",
)
def a5(spark, sf):
    info = notes.plan_info(v.run_texts(spark, sf, v.PLAN_TEXT))
    return info.withColumn("n_constraints", F.size("constraints").cast("bigint")).drop("constraints")


@query(
    "a5_front_matter",
    """SELECT run_id, 'analysis-cycle' AS skill, regexp_extract(text, 'best_score: (0\\.[0-9]+)', 1) AS best_score
       FROM v_cycles""",
    views="v_cycles",
)
def a5_fm(spark, sf):
    t = v.run_texts(spark, sf, v.CYCLE_TEXT)
    fm = notes.front_matter(F.col("text"))
    return t.select("run_id", fm["skill"].alias("skill"), fm["best_score"].alias("best_score"))


@query(
    "a6_best_features",
    """SELECT run_id, array_to_string(CASE WHEN json_valid(replace(bf, '''', '"'))
                THEN from_json(replace(bf, '''', '"'), '["VARCHAR"]')
                ELSE regexp_extract_all(bf, '[A-Za-z0-9_가-힣]+') END, ',') AS best_features
       FROM (SELECT run_id, trim(regexp_extract(text, 'best_features:\\s*([^\\n]+)', 1)) AS bf FROM v_cycles)""",
    views="v_cycles",
)
def a6(spark, sf):
    info = notes.cycle_info(v.run_texts(spark, sf, v.CYCLE_TEXT))
    return info.select("run_id", F.concat_ws(",", "best_features_list").alias("best_features"))


@query(
    "a7_excluded_features",
    """SELECT o_orderkey AS run_id, CASE WHEN o_orderkey % 4 = 3 THEN '' ELSE 'disc,' || o_orderpriority END AS excluded
       FROM orders""",
)
def a7(spark, sf):
    ex = notes.excluded_features(v.run_texts(spark, sf, v.EDA_TEXT))
    return ex.select("run_id", F.concat_ws(",", "excluded").alias("excluded"))


@query(
    "a9_result_json",
    """SELECT run_id, CASE WHEN n >= 2 AND spread IS NOT NULL THEN
              '{"n":' || n::VARCHAR || ',"best":' || best::VARCHAR || '}' END AS result
       FROM (SELECT run_id, count(*) AS n, max(score) AS best, max(score) - min(score) AS spread
             FROM v_runs GROUP BY run_id HAVING count(*) >= 2)""",
    views="v_runs",
)
def a9(spark, sf):
    log = v.run_log(spark, sf)
    per_run = log.groupBy("run_id").agg(F.count("*").alias("n"), F.max("score").alias("best")).where("n >= 2")
    return sinks.result_json(per_run, "run_id", ["n", "best"])


@query(
    "a10_score_card",
    """SELECT run_id, metric, value, note FROM (
         SELECT run_id, 'best' AS metric, max(score)::VARCHAR AS value, count(*)::VARCHAR AS note FROM v_runs GROUP BY run_id
         UNION ALL SELECT run_id, 'last', arg_max(score, iter)::VARCHAR, max(iter)::VARCHAR FROM v_runs GROUP BY run_id)""",
    views="v_runs",
)
def a10(spark, sf):
    panel = v.run_log(spark, sf).groupBy("run_id").agg(
        F.max("score").alias("best"), F.count("*").alias("n"),
        F.max_by("score", "iter").alias("last"), F.max("iter").alias("last_iter"),
    )
    return sinks.score_card(panel, "run_id", [("best", "best", "n"), ("last", "last", "last_iter")])


@query(
    "a11_latest_artifact",
    """SELECT o_custkey AS goal, arg_max('plan-' || o_orderkey::VARCHAR || '.md', (o_orderdate, o_orderkey)) AS path
       FROM orders GROUP BY o_custkey""",
)
def a11(spark, sf):
    files = read_table(spark, sf, "orders").select(
        F.col("o_custkey").alias("goal"), "o_orderdate", "o_orderkey",
        F.concat(F.lit("plan-"), F.col("o_orderkey").cast("string"), F.lit(".md")).alias("path"),
    )
    return latest_per_key(files, "goal", "path", ["o_orderdate", "o_orderkey"])


# ---- profile -----------------------------------------------------------------

@query("b1_shape", "SELECT count(*) AS n_rows, 11::BIGINT AS n_columns FROM lineitem")
def b1(spark, sf):
    return profile.shape(read_table(spark, sf, "lineitem"))


@query(
    "b2_dtypes",
    long_sql("documents", ["doc_id", "text", "lang", "source", "n_chars"],
             "count({c}) AS n_filled, CASE WHEN '{c}' IN ('doc_id', 'n_chars') THEN 'bigint' ELSE 'string' END AS dtype"),
)
def b2(spark, sf):
    return profile.dtypes(read_table(spark, sf, "documents"))


MISSING_COLS = ["doc_id", "lang", "source", "n_chars", "quality", "toxic"]


@query("b3_null_counts", long_sql("v_missing", MISSING_COLS, "count(*) FILTER ({c} IS NULL) AS n_null"), views="v_missing")
def b3(spark, sf):
    return profile.null_counts(v.partly_labelled(spark, sf))


@query(
    "b4_null_ratio",
    long_sql("v_missing", MISSING_COLS, "round(avg(({c} IS NULL)::INT), 3) AS null_ratio"),
    views="v_missing",
)
def b4(spark, sf):
    return profile.null_ratio(v.partly_labelled(spark, sf))


@query(
    "b5_describe",
    long_sql("lineitem", LINE_NUM,
             "count({c}) AS n, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std, min({c}) AS min, "
             "round(quantile_cont({c}, 0.25), 4) AS q25, round(quantile_cont({c}, 0.5), 4) AS q50, "
             "round(quantile_cont({c}, 0.75), 4) AS q75, max({c}) AS max"),
)
def b5(spark, sf):
    d = profile.describe(read_table(spark, sf, "lineitem"), LINE_NUM)
    return d.select(
        "column", "n", *[F.round(c, 4).alias(c) for c in ("mean", "std")], "min",
        *[F.round(c, 4).alias(c) for c in ("q25", "q50", "q75")], "max",
    )


@query(
    "b6_column_kinds",
    """SELECT 'numeric' AS kind, 'doc_id,n_chars,quality,toxic' AS names, count(n_chars) AS n_filled FROM v_missing
       UNION ALL SELECT 'text', 'lang,source', count(lang) FROM v_missing""",
    views="v_missing",
)
def b6(spark, sf):
    df = v.partly_labelled(spark, sf)
    n = df.agg(F.count("n_chars").alias("num"), F.count("lang").alias("txt"))
    names = lambda cols: F.lit(",".join(sorted(cols)))
    return n.select(
        F.explode(
            F.array(
                F.struct(F.lit("numeric").alias("kind"), names(profile.numeric_columns(df)).alias("names"), F.col("num").alias("n_filled")),
                F.struct(F.lit("text").alias("kind"), names(profile.text_columns(df)).alias("names"), F.col("txt").alias("n_filled")),
            )
        ).alias("r")
    ).select("r.*")


ORDER_COLS = ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]


@query("b7_distinct_counts", long_sql("orders", ORDER_COLS, "count(DISTINCT {c}) AS ndv"))
def b7(spark, sf):
    return profile.distinct_counts(read_table(spark, sf, "orders"), ORDER_COLS)


@query("b7_distinct_counts_approx")
def b7_approx(spark, sf):
    return profile.distinct_counts(read_table(spark, sf, "orders"), ORDER_COLS, approximate=True)


@query(
    "b8_task",
    long_sql("orders", ORDER_COLS,
             "count(DISTINCT {c}) AS ndv, CASE WHEN '{c}' IN ('o_orderstatus', 'o_orderpriority') "
             "OR count(DISTINCT {c}) < 10 THEN 'classification' ELSE 'regression' END AS task"),
)
def b8(spark, sf):
    return profile.infer_task(read_table(spark, sf, "orders"), ORDER_COLS)


@query(
    "b9_class_shares",
    """SELECT quality AS label, count(*) AS n, round(count(*)::DOUBLE / sum(count(*)) OVER (), 3) AS share
       FROM v_quality GROUP BY quality""",
    views="v_quality",
)
def b9(spark, sf):
    return profile.class_shares(v.quality(spark, sf), "quality").withColumn("share", F.round("share", 3))


# ---- features ------------------------------------------------------------------

@query("c1_drop_missing", "SELECT doc_id, quality FROM v_missing WHERE quality IS NOT NULL", views="v_missing")
def c1(spark, sf):
    return fe.drop_missing(v.partly_labelled(spark, sf), ["quality"]).select("doc_id", "quality")


@query("c2_threshold_label", "SELECT p_partkey, CASE WHEN p_size < 16 THEN 'small' ELSE 'large' END AS size_group FROM part")
def c2(spark, sf):
    return v.brands(spark, sf).select(
        "p_partkey", fe.threshold_label(F.col("p_size"), 16, "small", "large").alias("size_group")
    )


@query(
    "c3_family_size",
    "SELECT o_orderkey, (o_orderkey % 4 + o_custkey % 3 + 1)::BIGINT AS n_parts, "
    "((o_orderkey % 4 + o_custkey % 3 + 1) = 1)::INT AS is_single FROM orders",
)
def c3(spark, sf):
    size = F.col("o_orderkey") % 4 + F.col("o_custkey") % 3 + 1
    return read_table(spark, sf, "orders").select(
        "o_orderkey", size.alias("n_parts"), fe.flag(size == 1).alias("is_single")
    )


@query("c4_flag", "SELECT doc_id, (junk_n = 0)::INT AS is_clean FROM v_quality", views="v_quality")
def c4(spark, sf):
    return v.quality(spark, sf).select("doc_id", fe.flag(F.col("junk_n") == 0).alias("is_clean"))


@query("c5_extract_token", "SELECT p_partkey, nullif(trim(regexp_extract(p_brand, '#([0-9]+)', 1)), '') AS brand_no FROM part")
def c5(spark, sf):
    return v.brands(spark, sf).select("p_partkey", fe.extract_token(F.col("p_brand"), "#([0-9]+)").alias("brand_no"))


@query(
    "c6_fold_rare",
    """SELECT p_partkey, CASE WHEN p_type IN ('ECONOMY', 'SMALL') THEN p_type ELSE 'Rare' END AS kind,
              CASE WHEN n >= 80 THEN p_brand ELSE 'Rare' END AS brand
       FROM part JOIN (SELECT p_brand, count(*) AS n FROM part GROUP BY p_brand) USING (p_brand)""",
)
def c6(spark, sf):
    df = v.brands(spark, sf).withColumn("kind", fe.fold_rare(F.col("p_type"), ["ECONOMY", "SMALL"]))
    return fe.fold_rare_by_count(df, "p_brand", 80).select("p_partkey", "kind", F.col("p_brand").alias("brand"))


EDGES, NAMES = [0, 10, 20, 30, 40], ["tiny", "small", "medium", "large"]


@query(
    "c7_cut",
    """SELECT p_partkey, CASE WHEN p_size > 0 AND p_size <= 10 THEN 'tiny' WHEN p_size > 10 AND p_size <= 20 THEN 'small'
              WHEN p_size > 20 AND p_size <= 30 THEN 'medium' WHEN p_size > 30 AND p_size <= 40 THEN 'large'
              ELSE 'unknown' END AS size_bin FROM part""",
)
def c7(spark, sf):
    return v.brands(spark, sf).select("p_partkey", fe.cut(F.col("p_size"), EDGES, NAMES).alias("size_bin"))


@query(
    "c8_quantile_cut",
    """SELECT o_orderkey, CASE WHEN o_totalprice <= q[1] THEN 'q1' WHEN o_totalprice <= q[2] THEN 'q2'
              WHEN o_totalprice <= q[3] THEN 'q3' ELSE 'q4' END AS price_bin
       FROM orders, (SELECT quantile_cont(o_totalprice, [0.25, 0.5, 0.75]) AS q FROM orders)""",
)
def c8(spark, sf):
    df = read_table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return fe.quantile_cut(df, "o_totalprice", ["q1", "q2", "q3", "q4"], "price_bin").select("o_orderkey", "price_bin")


@query(
    "c9_to_number",
    "SELECT o_orderkey, try_cast(substr(o_orderpriority, 1, 1) AS DOUBLE) AS level, try_cast(o_orderstatus AS DOUBLE) AS status FROM orders",
)
def c9(spark, sf):
    return read_table(spark, sf, "orders").select(
        "o_orderkey", fe.to_number(F.substring("o_orderpriority", 1, 1)).alias("level"),
        fe.to_number(F.col("o_orderstatus")).alias("status"),
    )


@query(
    "c10_category_codes",
    """SELECT p_partkey, code FROM part JOIN (
         SELECT p_brand, row_number() OVER (ORDER BY p_brand) - 1 AS code FROM (SELECT DISTINCT p_brand FROM part)) USING (p_brand)""",
)
def c10(spark, sf):
    return fe.encode_category(v.brands(spark, sf), "p_brand", "code").select("p_partkey", "code")


METRIC_NAME = """CASE o_orderkey % 9 WHEN 0 THEN 'AUC-ROC' WHEN 1 THEN 'f1' WHEN 2 THEN 'Log Loss' WHEN 3 THEN 'rmse'
 WHEN 4 THEN 'R2' WHEN 5 THEN 'r_squared' WHEN 6 THEN 'mae' WHEN 7 THEN 'accuracy' ELSE o_orderpriority END"""
TASK_NAME = "CASE o_orderkey % 2 WHEN 0 THEN 'classification' ELSE 'regression' END"


@query(
    "c11_metric_name",
    f"SELECT o_orderkey, regexp_replace(upper({METRIC_NAME}), '[\\s_\\-]', '', 'g') AS metric FROM orders",
)
def c11(spark, sf):
    df = read_table(spark, sf, "orders").selectExpr("o_orderkey", f"{METRIC_NAME} AS m")
    return df.select("o_orderkey", fe.normalize_metric(F.col("m")).alias("metric"))


@query(
    "c12_scorer",
    """SELECT o_orderkey, CASE o_orderkey % 9 WHEN 0 THEN 'roc_auc' WHEN 1 THEN 'f1' WHEN 2 THEN 'neg_log_loss'
              WHEN 3 THEN 'neg_root_mean_squared_error' WHEN 4 THEN 'r2' WHEN 5 THEN 'r2' WHEN 6 THEN 'neg_mean_absolute_error'
              WHEN 7 THEN 'accuracy' ELSE CASE WHEN o_orderkey % 2 = 0 THEN 'roc_auc' ELSE 'r2' END END AS scorer FROM orders""",
)
def c12(spark, sf):
    df = read_table(spark, sf, "orders").selectExpr("o_orderkey", f"{METRIC_NAME} AS m", f"{TASK_NAME} AS t")
    return df.select("o_orderkey", fe.scorer_for(F.col("m"), F.col("t")).alias("scorer"))


@query("c13_select_features", "SELECT doc_id, n_chars, junk_share FROM v_quality", views="v_quality")
def c13(spark, sf):
    df = v.quality(spark, sf)
    return df.select("doc_id", *profile.select_features(df, ["n_chars", "absent", "junk_share"], "quality"))


# ---- rates ------------------------------------------------------------------------

@query("d1_overall_rate", "SELECT round(avg(quality), 6) AS rate, sum(quality)::BIGINT AS positives, count(*) AS n FROM v_quality", views="v_quality")
def d1(spark, sf):
    return rates.overall_rate(v.quality(spark, sf), "quality").withColumn("rate", F.round("rate", 6))


@query("d2_rate_by", "SELECT lang, round(avg(quality), 6) AS rate, count(*) AS n FROM v_quality GROUP BY lang", views="v_quality")
def d2(spark, sf):
    return rates.rate_by(v.quality(spark, sf), "lang", "quality").withColumn("rate", F.round("rate", 6))


D3_SQL = """SELECT '(all)' AS dimension, NULL AS value, avg(quality) AS rate, count(*) AS n FROM v_quality
    UNION ALL SELECT 'lang', lang, avg(quality), count(*) FROM v_quality GROUP BY lang
    UNION ALL SELECT 'source', source, avg(quality), count(*) FROM v_quality GROUP BY source
    UNION ALL SELECT 'toxic', toxic::VARCHAR, avg(quality), count(*) FROM v_quality GROUP BY toxic"""


def target_rates(spark, sf):
    return rates.rate_by_each(v.quality(spark, sf), ["lang", "source", "toxic"], "quality")


@query("d3_rate_by_each", f"SELECT dimension, value, round(rate, 6) AS rate, n FROM ({D3_SQL})", views="v_quality")
def d3(spark, sf):
    return target_rates(spark, sf).withColumn("rate", F.round("rate", 6))


@query(
    "d4_rate_by_derived",
    """SELECT dimension, value, round(rate, 6) AS rate, n FROM (
         SELECT 'length' AS dimension, CASE WHEN n_chars < 500 THEN 'short' ELSE 'long' END AS value,
                avg(quality) AS rate, count(*) AS n FROM v_quality GROUP BY 2
         UNION ALL SELECT 'clean', (junk_n = 0)::INT::VARCHAR, avg(quality), count(*) FROM v_quality GROUP BY 2
         UNION ALL SELECT '(all)', NULL, avg(quality), count(*) FROM v_quality)""",
    views="v_quality",
)
def d4(spark, sf):
    df = v.quality(spark, sf).select(
        "quality",
        fe.threshold_label(F.col("n_chars"), 500, "short", "long").alias("length"),
        fe.flag(F.col("junk_n") == 0).alias("clean"),
    )
    return rates.rate_by_each(df, ["length", "clean"], "quality").withColumn("rate", F.round("rate", 6))


@query(
    "d5_group_gap",
    f"""SELECT dimension, round(max(rate) - min(rate), 6) AS gap, count(*) AS n_groups FROM ({D3_SQL})
        WHERE dimension <> '(all)' GROUP BY dimension""",
    views="v_quality",
)
def d5(spark, sf):
    return rates.group_gap(target_rates(spark, sf)).withColumn("gap", F.round("gap", 6))


@query(
    "d6_score_summary",
    """SELECT run_id, count(*) AS n, round(avg(score), 9) AS mean, round(stddev_pop(score), 9) AS std, min(score) AS min,
              max(score) AS max, round(quantile_cont(score, 0.5), 9) AS median, round(quantile_cont(score, 0.25), 9) AS q25,
              round(quantile_cont(score, 0.75), 9) AS q75 FROM v_runs GROUP BY run_id""",
    views="v_runs",
)
def d6(spark, sf):
    s = rates.score_summary(v.run_log(spark, sf), ["run_id"])
    return s.select(
        "run_id", "n", *[F.round(c, 9).alias(c) for c in ("mean", "std")], "min", "max",
        *[F.round(c, 9).alias(c) for c in ("median", "q25", "q75")],
    )


@query(
    "d7_boxplot",
    """SELECT event_type, round(q[1], 6) AS q1, round(q[2], 6) AS median, round(q[3], 6) AS q3,
              min(value) FILTER (value >= q[1] - 1.5 * (q[3] - q[1])) AS whisker_low,
              max(value) FILTER (value <= q[3] + 1.5 * (q[3] - q[1])) AS whisker_high,
              count(*) FILTER (value < q[1] - 1.5 * (q[3] - q[1]) OR value > q[3] + 1.5 * (q[3] - q[1])) AS n_outliers
       FROM events JOIN (SELECT event_type, quantile_cont(value, [0.25, 0.5, 0.75]) AS q FROM events GROUP BY event_type)
         USING (event_type) GROUP BY event_type, q""",
)
def d7(spark, sf):
    b = rates.boxplot_rows(v.series(spark, sf), ["event_type"], "value")
    return b.select(
        "event_type", *[F.round(c, 6).alias(c) for c in ("q1", "median", "q3")], "whisker_low", "whisker_high",
        F.col("n_outliers").cast("bigint").alias("n_outliers"),
    )


@query(
    "d8_token_counts",
    """SELECT run_id, token, count(*) AS n FROM (
         SELECT run_id, unnest(regexp_extract_all(text, 'hypothesis[_\\-]?id[:\\s=]+[''"]?([Hh][0-9]+|HYP[A-Za-z0-9_]+)', 1)) AS token
         FROM v_cycles) GROUP BY ALL HAVING count(*) >= 2""",
    views="v_cycles",
)
def d8(spark, sf):
    return rates.token_counts(v.run_texts(spark, sf, v.CYCLE_TEXT), "run_id", "text", notes.HYPOTHESIS_ID, 2)


@query(
    "d9_bars",
    f"""SELECT dimension || '=' || value AS label, round(drop_pct, 6) AS value,
               CASE WHEN drop_pct > 25 THEN 'CRITICAL' WHEN drop_pct > 15 THEN 'load-bearing' ELSE '' END AS threshold_class,
               n AS reference
        FROM (SELECT dimension, value, n, (1 - rate) * 100 AS drop_pct FROM ({D3_SQL}) WHERE dimension <> '(all)')""",
    views="v_quality",
)
def d9(spark, sf):
    r = target_rates(spark, sf).where("dimension <> '(all)'").select(
        F.concat_ws("=", "dimension", "value").alias("l"), ((1 - F.col("rate")) * 100).alias("drop_pct"), "n"
    )
    return rates.bar_rows(r, "l", "drop_pct", F.col("n")).withColumn("value", F.round("value", 6))


@query(
    "d11_scatter_sample",
    f"""SELECT o_orderkey, feature, x, y FROM (
          SELECT o_orderkey, 'o_custkey' AS feature, o_custkey::DOUBLE AS x, o_totalprice AS y FROM orders
          UNION ALL SELECT o_orderkey, 'o_totalprice', o_totalprice, o_totalprice FROM orders)
        WHERE {v.h32("concat_ws(':', o_orderkey)")} % 20 = 0""",
)
def d11(spark, sf):
    return profile.scatter_points(
        read_table(spark, sf, "orders"), "o_orderkey", ["o_custkey", "o_totalprice"], "o_totalprice", 20
    )


# ---- signal ---------------------------------------------------------------------

LEAK_COLS = ["l_extendedprice", "l_tax", "l_quantity", "disc"]


@query(
    "e1_correlation_matrix",
    " UNION ALL ".join(
        f"SELECT '{a}' AS x, '{b}' AS y, round(corr({a}, {b}), 3) AS r FROM v_leak" for a in LEAK_COLS for b in LEAK_COLS
    ),
    views="v_leak",
)
def e1(spark, sf):
    return signal.correlation_matrix(v.leaky_lines(spark, sf), LEAK_COLS)


@query(
    "e1_constant_column",
    """SELECT 'one' AS x, 'one' AS y, NULL::DOUBLE AS r UNION ALL SELECT 'one', 'o_totalprice', NULL
       UNION ALL SELECT 'o_totalprice', 'one', NULL
       UNION ALL SELECT 'o_totalprice', 'o_totalprice', round(corr(o_totalprice, o_totalprice), 3) FROM orders""",
)
def e1_const(spark, sf):
    df = read_table(spark, sf, "orders").select("o_totalprice", F.lit(1).alias("one"))
    return signal.correlation_matrix(df, ["one", "o_totalprice"])


ABS_R = " UNION ALL ".join(f"SELECT '{c}' AS feature, abs(corr({c}, quality)) AS abs_r FROM v_quality" for c in QUALITY_NUM)


@query("e2_top_features", f"SELECT feature, round(abs_r, 6) AS abs_r FROM ({ABS_R}) ORDER BY abs_r DESC, feature LIMIT 4", views="v_quality")
def e2(spark, sf):
    return signal.top_features(v.quality(spark, sf), QUALITY_NUM, "quality").withColumn("abs_r", F.round("abs_r", 6))


RANKED = f"""SELECT *, row_number() OVER (ORDER BY signal DESC, feature) AS rank FROM (
    SELECT feature, abs_r AS signal, 'corr' AS kind FROM ({ABS_R})
    UNION ALL SELECT dimension, max(rate) - min(rate), 'gap' FROM ({D3_SQL})
      WHERE dimension IN ('lang', 'source') GROUP BY dimension)"""


def hypotheses(spark, sf):
    q = v.quality(spark, sf)
    numeric = signal.target_correlation(q, QUALITY_NUM, "quality")
    gaps = rates.group_gap(rates.rate_by_each(q, ["lang", "source"], "quality"))
    return signal.rank_hypotheses(numeric, gaps, k=3)


@query(
    "e3_rank_hypotheses",
    f"""SELECT feature, round(signal, 6) AS signal, kind, rank::INT AS rank,
               CASE WHEN signal >= 0.3 THEN 'high' WHEN signal >= 0.1 THEN 'medium' ELSE 'low' END AS priority
        FROM ({RANKED}) WHERE rank <= 3""",
    views="v_quality",
)
def e3(spark, sf):
    return hypotheses(spark, sf).withColumn("signal", F.round("signal", 6))


@query(
    "e4_no_signal_fallback",
    """SELECT 'o_totalprice' AS feature, CASE WHEN r >= 0.1 THEN 'hypothesis' ELSE 'all_numeric' END AS source FROM
         (SELECT abs(corr(o_totalprice, is_f)) AS r FROM v_order)
       UNION ALL SELECT 'o_custkey', CASE WHEN r >= 0.1 THEN 'hypothesis' ELSE 'all_numeric' END FROM
         (SELECT abs(corr(o_totalprice, is_f)) AS r FROM v_order)""",
    views="v_order",
)
def e4(spark, sf):
    r = signal.target_correlation(v.order_status(spark, sf), ["o_totalprice"], "is_f")
    return signal.features_to_use(r.withColumnRenamed("abs_r", "signal"), ["o_totalprice", "o_custkey"])


@query(
    "e5_welch_t",
    """SELECT na AS n_a, nb AS n_b, round((ma - mb) / sqrt(va / na + vb / nb), 6) AS t,
              round((va / na + vb / nb) ** 2 / ((va / na) ** 2 / (na - 1) + (vb / nb) ** 2 / (nb - 1)), 4) AS df
       FROM (SELECT count(*) FILTER (quality = 1) AS na, count(*) FILTER (quality = 0) AS nb,
                    avg(junk_share) FILTER (quality = 1) AS ma, avg(junk_share) FILTER (quality = 0) AS mb,
                    var_samp(junk_share) FILTER (quality = 1) AS va, var_samp(junk_share) FILTER (quality = 0) AS vb FROM v_quality)""",
    views="v_quality",
)
def e5(spark, sf):
    t = signal.welch_t(v.quality(spark, sf), "quality", "junk_share", 1, 0)
    return t.select("n_a", "n_b", F.round("t", 6).alias("t"), F.round("df", 4).alias("df"))


@query("e5_welch_p")
def e5_p(spark, sf):
    t = signal.welch_t(v.quality(spark, sf), "quality", "n_chars", 1, 0)
    return t.withColumn("p", 2 * t_tail(F.abs("t"), F.col("df")))


@query(
    "e6_anova",
    """SELECT round((ssb / (k - 1)) / (ssw / (n - k)), 6) AS f, k - 1 AS df_between, n - k AS df_within FROM (
         SELECT sum(c * (m - g) ** 2) AS ssb, sum(c * vp) AS ssw, count(*) AS k, sum(c)::BIGINT AS n FROM
           (SELECT lang, count(*) AS c, avg(n_chars) AS m, var_pop(n_chars) AS vp FROM documents GROUP BY lang),
           (SELECT avg(n_chars) AS g FROM documents))""",
)
def e6(spark, sf):
    a = signal.anova(read_table(spark, sf, "documents"), "lang", "n_chars")
    return a.select(F.round("f", 6).alias("f"), "df_between", "df_within")


@query("e6_anova_p")
def e6_p(spark, sf):
    a = signal.anova(read_table(spark, sf, "documents"), "lang", "n_chars")
    return a.withColumn("p", f_tail(F.col("f"), F.col("df_between").cast("double"), F.col("df_within").cast("double")))


@query(
    "e7_chi_square",
    """WITH o AS (SELECT o_orderstatus AS a, o_orderpriority AS b, count(*) AS n FROM orders GROUP BY ALL),
            t AS (SELECT a, b, coalesce(n, 0) AS n, sum(n) OVER (PARTITION BY a) AS ra, sum(n) OVER (PARTITION BY b) AS cb,
                         sum(n) OVER () AS s
                  FROM (SELECT DISTINCT a FROM o) CROSS JOIN (SELECT DISTINCT b FROM o) LEFT JOIN o USING (a, b))
       SELECT round(sum((n - ra * cb / s::DOUBLE) ** 2 / (ra * cb / s::DOUBLE)), 6) AS chi2,
              (count(DISTINCT a) - 1) * (count(DISTINCT b) - 1) AS df FROM t""",
)
def e7(spark, sf):
    c = signal.chi_square(read_table(spark, sf, "orders"), "o_orderstatus", "o_orderpriority")
    return c.select(F.round("chi2", 6).alias("chi2"), "df")


@query("e7_chi_square_p")
def e7_p(spark, sf):
    c = signal.chi_square(read_table(spark, sf, "orders"), "o_orderstatus", "o_orderpriority")
    return c.withColumn("p", chi2_tail(F.col("chi2"), F.col("df").cast("double")))
