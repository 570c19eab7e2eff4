"""Views over the given tables that play the roles of an analysis.

Each view exists twice: as a DataFrame for the queries and as SQL for the check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ordered import position
from ..operators.folds import seeded_folds, stratified_kfold
from ..operators.iteration import with_progress
from ..sources.tables import read_table, spread

JUNK = "#*%$!"


def h32(expr: str) -> str:
    """SQL twin of ``functions.hashing.hash32``."""
    return f"('0x' || substr(md5({expr}), 1, 8))::BIGINT"


# ---- tables with a target -----------------------------------------------------

def quality(spark: SparkSession, sf: str) -> DataFrame:
    """Labelled documents: does the share of junk signs tell the quality?"""
    docs = read_table(spark, sf, "documents").select(
        "doc_id", "lang", "source", "n_chars",
        (F.length("text") - F.length(F.translate("text", JUNK, ""))).cast("bigint").alias("junk_n"),
    )
    labels = read_table(spark, sf, "labels")
    return docs.join(labels, "doc_id").withColumn(
        "junk_share", F.col("junk_n") / F.nullif(F.col("n_chars"), F.lit(0))
    )


def order_status(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with a target that no feature explains."""
    return read_table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority", "o_orderdate",
        (F.col("o_orderstatus") == "F").cast("int").alias("is_f"),
    )


def leaky_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Line items: the discounted price nearly is the price."""
    return read_table(spark, sf, "lineitem").select(
        "l_extendedprice", "l_tax", "l_quantity",
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("disc"),
    )


def partly_labelled(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with missing labels."""
    docs = read_table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars")
    return docs.join(read_table(spark, sf, "labels"), "doc_id", "left")


def series(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "value")


def brands(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "part").select(
        "p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"
    )


# ---- corpora ------------------------------------------------------------------

def cells(spark: SparkSession, sf: str) -> DataFrame:
    """Events as notebook cells: printed numbers, quoted numbers, hedged numbers."""
    k = F.get_json_object("props", "$.k").cast("int")
    kk = F.lpad(k.cast("string"), 2, "0")
    kind = F.col("event_type")
    is_code = kind.isin("view", "click")
    ev = read_table(spark, sf, "events").select(
        F.col("user_id").alias("notebook"), "event_id", "ts",
        F.when(is_code, "code").otherwise("markdown").alias("cell_type"),
        F.when(is_code, "run()")
        .when(kind == "purchase", F.concat(F.lit("AUC-ROC 0."), kk))
        .when(kind == "signup", F.concat(F.lit("F1 0."), kk))
        .otherwise(F.concat(F.lit("roughly 0."), kk))
        .alias("source"),
        F.when(is_code, 1).otherwise(0).cast("bigint").alias("n_outputs"),
        F.when((kind == "click") & (F.pmod(k, F.lit(10)) == 0), "  ")
        .when(kind == "view", F.concat(F.lit("AUC-ROC: 0."), kk))
        .when(kind == "click", F.concat(F.lit("F1: 0."), kk))
        .otherwise("")
        .alias("output_text"),
    )
    day = F.datediff(F.col("ts"), F.lit("1970-01-01"))
    return position(ev, ["notebook"], day, ["ts", "event_id"], "cell_index").drop("event_id", "ts")


# lines of a report cell that depend on the document, valid in both engines
DOC_SUFFIX = """CASE doc_id % 11
  WHEN 0 THEN ' Conclusion: improved here, worse there.'
  WHEN 1 THEN ' Data Overview of the titanic set.'
  WHEN 2 THEN ' EDA Pass 1.'
  WHEN 3 THEN ' Modeling of house prices.'
  WHEN 4 THEN ' Validation.'
  WHEN 5 THEN concat(' ![plot](figures/plot_', cast(doc_id % 20 AS STRING), '.png)')
  ELSE '' END"""


def doc_cells(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as report cells, four to a notebook, whole texts."""
    return read_table(spark, sf, "documents").selectExpr(
        "cast(floor(doc_id / 4) AS BIGINT) AS notebook",
        "doc_id AS cell_index",
        "'markdown' AS cell_type",
        f"concat(text, {DOC_SUFFIX}) AS source",
        "cast(0 AS BIGINT) AS n_outputs",
        "'' AS output_text",
    )


def figure_files(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "nation").where("n_nationkey % 2 = 0").selectExpr(
        "concat('figures/plot_', cast(n_nationkey AS STRING), '.png') AS path"
    )


# texts of runs, one per order, valid in both engines (chr: 10 newline, 39 quote)
SCRIPT_TEXT = """concat(
  'import pandas as pd', chr(10),
  'from sklearn.model_selection import train_test_split, ',
  CASE o_orderkey % 3 WHEN 0 THEN 'StratifiedKFold' WHEN 1 THEN 'KFold' ELSE 'TimeSeriesSplit' END, chr(10),
  CASE WHEN o_orderkey % 4 = 0 THEN concat('plt.rcParams[', chr(39), 'font.family', chr(39), '] = ', chr(39), 'NanumGothic', chr(39), chr(10)) ELSE '' END,
  CASE WHEN o_orderkey % 5 = 0 THEN concat('folder = (', chr(10), chr(39), '/home/u/data', chr(39), ')', chr(10)) ELSE '' END,
  CASE WHEN o_orderkey % 6 = 0 THEN concat('cache = ', chr(39), '~/cache', chr(39), chr(10)) ELSE '' END,
  CASE WHEN o_orderkey % 7 = 0 THEN concat('X = X.fillna(0)', chr(10)) ELSE '' END,
  CASE WHEN o_orderkey % 8 < 3 THEN concat('X = StandardScaler().fit_transform(X)  # scale', chr(10)) ELSE '' END,
  '# train_test_split(note) random_state=42', chr(10),
  CASE WHEN o_orderkey % 9 <> 0 THEN concat('A, B, a, b = train_test_split(X, y, random_state=42, shuffle=',
    CASE WHEN o_orderkey % 2 = 0 THEN 'True' ELSE 'False' END, ')', chr(10)) ELSE '' END,
  CASE WHEN o_orderkey % 8 >= 5 THEN concat('A = StandardScaler().fit_transform(A)', chr(10)) ELSE '' END,
  CASE WHEN o_orderkey % 10 < 4 THEN concat('m = RandomForestClassifier(random_state = 42)', chr(10)) ELSE '' END,
  's = cross_val_score(m, X, y, scoring=', chr(39),
  CASE o_orderkey % 5 WHEN 0 THEN 'roc_auc' WHEN 1 THEN 'f1' WHEN 2 THEN 'neg_root_mean_squared_error' WHEN 3 THEN 'accuracy' ELSE 'rmse' END,
  chr(39), ')', chr(10))"""

PLAN_TEXT = """concat(
  '# plan ', cast(o_orderkey AS STRING), chr(10),
  '- goal: run-', cast(o_orderkey AS STRING), chr(10),
  '- analysis_type: ', CASE o_orderkey % 3 WHEN 0 THEN 'regression' ELSE 'classification' END, chr(10),
  '- target_variable: ', CASE o_orderkey % 4 WHEN 0 THEN 'l_extendedprice' ELSE 'quality' END, chr(10),
  'success_metric: ', CASE o_orderkey % 5 WHEN 0 THEN 'AUC-ROC' WHEN 1 THEN 'RMSE' WHEN 2 THEN 'rmse' WHEN 3 THEN 'F1' ELSE 'Accuracy' END, chr(10),
  '  - execution_env: local  ', chr(10),
  CASE WHEN o_orderkey % 6 = 0 THEN concat('- constraints: ', o_orderpriority, chr(10)) ELSE '' END,
  CASE WHEN o_orderkey % 7 = 0 THEN 'This is a Time-Series task' WHEN o_orderkey % 7 = 1 THEN 'class imbalance expected' ELSE 'plain' END, chr(10))"""

CYCLE_TEXT = """concat(
  '---', chr(10), 'skill: analysis-cycle', chr(10), 'best_score: 0.', cast(o_orderkey % 90 + 10 AS STRING), chr(10), '---', chr(10),
  repeat(concat('hypothesis_id: H', cast(o_orderkey % 5 AS STRING), chr(10)), cast(o_orderkey % 8 AS INT)),
  'hypothesis-id=', chr(39), 'HYP_', cast(o_orderkey % 3 AS STRING), chr(39), chr(10),
  CASE WHEN o_orderkey % 11 = 0 THEN concat('fold_excluded: 2', chr(10)) ELSE '' END,
  'best_hypothesis: H', cast(o_orderkey % 5 AS STRING), chr(10),
  'best_features: ', CASE o_orderkey % 3
     WHEN 0 THEN concat('[', chr(39), 'l_tax', chr(39), ', ', chr(39), 'disc', chr(39), ']')
     WHEN 1 THEN concat('[', chr(39), 'junk_share', chr(39), ']') ELSE 'l_tax and l_quantity' END, chr(10),
  'best_model: ', CASE o_orderkey % 2 WHEN 0 THEN 'Ridge' ELSE 'RandomForest' END, chr(10))"""

EDA_TEXT = """concat('## notes', chr(10),
  CASE WHEN o_orderkey % 4 = 3 THEN 'nothing left out' ELSE concat('Excluded_features: [', chr(39), 'disc', chr(39), ', ', chr(34), o_orderpriority, chr(34), ']') END, chr(10))"""


def run_texts(spark: SparkSession, sf: str, text: str) -> DataFrame:
    """(run_id, text) with one of the text expressions above."""
    runs = read_table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return spread(runs, "o_orderkey").selectExpr("o_orderkey AS run_id", f"{text} AS text")


# ---- logs, votes, numbers -----------------------------------------------------

def run_log(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as a numbered iteration log of each customer."""
    rows = read_table(spark, sf, "orders").selectExpr(
        "o_custkey AS run_id", "o_orderkey", "o_orderdate",
        "(o_orderkey % 1000) / 1000.0D AS score",
        "concat('H', cast(o_orderkey % 3 + 1 AS STRING)) AS hypothesis",
    )
    return with_progress(rows, "run_id", ["o_orderdate", "o_orderkey"], "score", log_day())


def log_day():
    return F.datediff(F.col("o_orderdate"), F.lit("1970-01-01"))


def votes(spark: SparkSession, sf: str) -> DataFrame:
    """Events as judge votes on the claims of a user's report."""
    return read_table(spark, sf, "events").selectExpr(
        "user_id AS run_id", "event_type",
        "CASE cast(get_json_object(props, '$.k') AS INT) % 3 WHEN 0 THEN 'YES' WHEN 1 THEN 'PARTIAL' ELSE 'NO' END AS vote",
    )


def cited_and_actual(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as cited numbers with an actual value a few percent off."""
    return read_table(spark, sf, "orders").selectExpr(
        "o_custkey AS run_id", "o_totalprice AS cited",
        "o_totalprice * (1 + ((o_orderkey % 9) - 4) / 100.0D) AS actual",
    )


# ---- folds and scores -----------------------------------------------------------

SEEDS = (0, 1, 7, 42, 123)


def quality_folds(spark: SparkSession, sf: str) -> DataFrame:
    return seeded_folds(quality(spark, sf), "doc_id", "quality", 5, SEEDS)


def partly_labelled_folds(spark: SparkSession, sf: str) -> DataFrame:
    """Shuffled folds of all documents; labels are missing for most."""
    return seeded_folds(partly_labelled(spark, sf), "doc_id", None, 5, SEEDS)


def quality_one_seed(spark: SparkSession, sf: str) -> DataFrame:
    return stratified_kfold(quality(spark, sf), "quality", "doc_id", 5, 42).withColumn("seed", F.lit(42))


VIEW_SQL = {
    "v_quality": f"""
        SELECT d.doc_id, d.lang, d.source, d.n_chars,
               length(d.text) - length(translate(d.text, '{JUNK}', '')) AS junk_n,
               (length(d.text) - length(translate(d.text, '{JUNK}', '')))::DOUBLE / nullif(d.n_chars, 0) AS junk_share,
               l.quality, l.toxic
        FROM documents d JOIN labels l USING (doc_id)""",
    "v_order": """
        SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority, o_orderdate,
               (o_orderstatus = 'F')::INT AS is_f FROM orders""",
    "v_leak": """
        SELECT l_extendedprice, l_tax, l_quantity, l_extendedprice * (1 - l_discount) AS disc FROM lineitem""",
    "v_missing": """
        SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic
        FROM documents d LEFT JOIN labels l USING (doc_id)""",
    "v_cells": """
        SELECT user_id AS notebook,
               row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS cell_index,
               CASE WHEN event_type IN ('view', 'click') THEN 'code' ELSE 'markdown' END AS cell_type,
               CASE WHEN event_type IN ('view', 'click') THEN 'run()'
                    WHEN event_type = 'purchase' THEN 'AUC-ROC 0.' || kk
                    WHEN event_type = 'signup' THEN 'F1 0.' || kk ELSE 'roughly 0.' || kk END AS source,
               CASE WHEN event_type IN ('view', 'click') THEN 1 ELSE 0 END AS n_outputs,
               CASE WHEN event_type = 'click' AND k % 10 = 0 THEN '  '
                    WHEN event_type = 'view' THEN 'AUC-ROC: 0.' || kk
                    WHEN event_type = 'click' THEN 'F1: 0.' || kk ELSE '' END AS output_text
        FROM (SELECT *, (props->>'$.k')::INT AS k, lpad(props->>'$.k', 2, '0') AS kk FROM events)""",
    "v_printed": """
        SELECT notebook, string_agg(output_text, chr(10)) AS all_out
        FROM v_cells WHERE cell_type = 'code' GROUP BY notebook""",
    "v_doc_cells": f"""
        SELECT floor(doc_id / 4)::BIGINT AS notebook, doc_id AS cell_index, 'markdown' AS cell_type,
               concat(text, {DOC_SUFFIX.replace("STRING", "VARCHAR")}) AS source,
               0 AS n_outputs, '' AS output_text FROM documents""",
    "v_scripts": f"SELECT o_orderkey AS run_id, {SCRIPT_TEXT.replace('STRING', 'VARCHAR')} AS text FROM orders",
    "v_plans": f"SELECT o_orderkey AS run_id, {PLAN_TEXT.replace('STRING', 'VARCHAR')} AS text FROM orders",
    "v_cycles": f"SELECT o_orderkey AS run_id, {CYCLE_TEXT.replace('STRING', 'VARCHAR')} AS text FROM orders",
    "v_edas": f"SELECT o_orderkey AS run_id, {EDA_TEXT.replace('STRING', 'VARCHAR')} AS text FROM orders",
    "v_runs": """
        SELECT o_custkey AS run_id, o_orderkey, o_orderdate, (o_orderkey % 1000) / 1000.0::DOUBLE AS score,
               'H' || (o_orderkey % 3 + 1)::VARCHAR AS hypothesis,
               row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) - 1 AS iter
        FROM orders""",
    "v_log": """
        SELECT *, coalesce(score - max(score) OVER (PARTITION BY run_id ORDER BY iter
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0) AS delta FROM v_runs""",
    "v_votes": """
        SELECT user_id AS run_id, event_type,
               CASE (props->>'$.k')::INT % 3 WHEN 0 THEN 'YES' WHEN 1 THEN 'PARTIAL' ELSE 'NO' END AS vote
        FROM events""",
    "v_numbers": """
        SELECT o_custkey AS run_id, o_totalprice AS cited,
               o_totalprice * (1 + ((o_orderkey % 9) - 4) / 100.0::DOUBLE) AS actual FROM orders""",
    "v_folds": f"""
        SELECT *, ((row_number() OVER (PARTITION BY seed, quality
                   ORDER BY {h32("concat_ws(':', seed, doc_id)")}, doc_id) - 1) % 5)::INT AS fold
        FROM v_quality, (SELECT unnest([0, 1, 7, 42, 123]) AS seed)""",
    "v_partly_folds": f"""
        SELECT *, ((row_number() OVER (PARTITION BY seed
                   ORDER BY {h32("concat_ws(':', seed, doc_id)")}, doc_id) - 1) % 5)::INT AS fold
        FROM v_missing, (SELECT unnest([0, 1, 7, 42, 123]) AS seed)""",
    "v_fold42": f"""
        SELECT *, 42 AS seed, ((row_number() OVER (PARTITION BY quality
                   ORDER BY {h32("concat_ws(':', 42, doc_id)")}, doc_id) - 1) % 5)::INT AS fold
        FROM v_quality""",
}

_NEEDS = {
    "v_printed": ["v_cells"],
    "v_log": ["v_runs"],
    "v_folds": ["v_quality"],
    "v_partly_folds": ["v_missing"],
    "v_fold42": ["v_quality"],
}


def with_views(names: list[str], sql: str) -> str:
    """Prefix SQL with the views it uses, dependencies first."""
    order: list[str] = []

    def add(name: str) -> None:
        for need in _NEEDS.get(name, []):
            add(need)
        if name not in order:
            order.append(name)

    for n in names:
        add(n)
    if not order:
        return sql
    body = sql.lstrip()
    head = "WITH RECURSIVE " if body.upper().startswith("WITH RECURSIVE ") else "WITH "
    more = body.upper().startswith(head)
    joined = ",\n".join(f"{n} AS ({VIEW_SQL[n]})" for n in order)
    return head + joined + (",\n" + body[len(head) :] if more else "\n" + body)
