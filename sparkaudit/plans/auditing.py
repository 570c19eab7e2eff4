"""Queries: methodology audit of run texts, report audit of notebook cells."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import audit_method as am
from ..operators import audit_report as ar
from ..operators import trust
from ..sources import notes, sinks
from ..sources.tables import read_table
from . import views as v
from .catalog import query


def flags(spark, sf):
    return notes.script_flags(v.run_texts(spark, sf, v.SCRIPT_TEXT))


def plans_of(spark, sf):
    return notes.plan_info(v.run_texts(spark, sf, v.PLAN_TEXT))


def cycles_of(spark, sf):
    return notes.cycle_info(v.run_texts(spark, sf, v.CYCLE_TEXT))


def excluded_of(spark, sf):
    return notes.excluded_features(v.run_texts(spark, sf, v.EDA_TEXT))


SHORT = ["run_id", "check_id", "severity", "evidence"]
TASK = "regexp_extract(p.text, '(?m)^- analysis_type: (.*)$', 1)"
TARGET = "regexp_extract(p.text, '(?m)^- target_variable: (.*)$', 1)"
FEATURES = """(SELECT run_id, unnest(CASE WHEN json_valid(replace(bf, '''', '"')) THEN from_json(replace(bf, '''', '"'), '["VARCHAR"]')
     ELSE regexp_extract_all(bf, '[A-Za-z0-9_]+') END) AS feature
   FROM (SELECT run_id, trim(regexp_extract(text, 'best_features:\\s*([^\\n]+)', 1)) AS bf FROM v_cycles))"""

# fixed values in the SQL: word lists and patterns of the checks, as in the operators
M_SQL = {
    "m1": f"""SELECT f.run_id, 'M1' AS check_id, 'block' AS severity,
                'corr(' || f.feature || ',l_extendedprice)=' || round(r.abs_r, 4)::VARCHAR AS evidence
         FROM {FEATURES} f JOIN v_plans p ON p.run_id = f.run_id AND {TARGET} = 'l_extendedprice'
         JOIN (SELECT 'l_tax' AS feature, abs(corr(l_tax, l_extendedprice)) AS abs_r FROM v_leak
               UNION ALL SELECT 'disc', abs(corr(disc, l_extendedprice)) FROM v_leak
               UNION ALL SELECT 'l_quantity', abs(corr(l_quantity, l_extendedprice)) FROM v_leak) r
           ON r.feature = f.feature AND r.abs_r > 0.95""",
    "m2": """SELECT p.run_id, 'M2' AS check_id, 'block' AS severity, 'is_time_series=True, shuffle=True' AS evidence
         FROM v_plans p JOIN v_scripts s USING (run_id)
         WHERE regexp_matches(p.text, '(?i)time[-\\s]?series|시계열|timeseries') AND regexp_matches(s.text, 'shuffle\\s*=\\s*True')""",
    "m3": """SELECT run_id, 'M3' AS check_id, 'block' AS severity,
                'fit_transform line ' || f::VARCHAR || ', split line ' || coalesce(s::VARCHAR, 'none') AS evidence
         FROM (SELECT run_id, min(i) FILTER (regexp_matches(code, 'fit_transform[A-Za-z0-9_.]*\\s*\\(')) AS f,
                      min(i) FILTER (regexp_matches(code, 'train_test_split[A-Za-z0-9_.]*\\s*\\(')) AS s
               FROM (SELECT run_id, i, regexp_replace(lines[i], '#.*$', '') AS code
                     FROM (SELECT run_id, lines, unnest(range(1, len(lines) + 1)) AS i
                           FROM (SELECT run_id, string_split(text, chr(10)) AS lines FROM v_scripts)))
               GROUP BY run_id) WHERE f IS NOT NULL AND (s IS NULL OR f < s)""",
    "m4": f"""SELECT p.run_id, 'M4' AS check_id, 'warn' AS severity, 'min_share=' || round(ms, 3)::VARCHAR AS evidence
         FROM v_plans p JOIN v_scripts s USING (run_id),
              (SELECT min(c)::DOUBLE / sum(c) AS ms, count(*) AS k FROM (SELECT count(*) AS c FROM labels GROUP BY quality))
         WHERE {TASK} = 'classification' AND {TARGET} = 'quality' AND k > 1 AND ms < 0.2
           AND NOT contains(s.text, 'StratifiedKFold')""",
    "m5": """SELECT run_id, 'M5' AS check_id, 'warn' AS severity, 'counts[' || h || ']=' || count(*)::VARCHAR AS evidence
         FROM (SELECT run_id, unnest(regexp_extract_all(text, 'hypothesis[_\\-]?id[:\\s=]+[''"]?([Hh][0-9]+|HYP[A-Za-z0-9_]+)', 1)) AS h FROM v_cycles)
         GROUP BY run_id, h HAVING count(*) > 5""",
    "m6": """SELECT run_id, 'M6' AS check_id, 'warn' AS severity, 'fold_excluded' AS evidence
         FROM v_cycles WHERE contains(text, 'fold_excluded')""",
    "m7": """SELECT s.run_id, 'M7' AS check_id, 'warn' AS severity, 'columns: ' || names AS evidence
         FROM v_scripts s, (SELECT string_agg(c, ',' ORDER BY c) AS names FROM (
             SELECT 'quality' AS c, avg((quality IS NULL)::INT) AS r FROM v_missing
             UNION ALL SELECT 'toxic', avg((toxic IS NULL)::INT) FROM v_missing
             UNION ALL SELECT 'lang', avg((lang IS NULL)::INT) FROM v_missing) WHERE round(r, 3) > 0.05)
         WHERE NOT regexp_matches(s.text, '\\.fillna\\(|SimpleImputer|KNNImputer|IterativeImputer') AND names IS NOT NULL""",
    "m8": """SELECT run_id, 'M8' AS check_id, 'block' AS severity, 'metric=' || m || ', scoring=' || u AS evidence FROM (
           SELECT *, regexp_replace(upper(m), '[\\s_\\-]', '', 'g') AS nm, regexp_replace(upper(u), '[\\s_\\-]', '', 'g') AS nu FROM (
             SELECT p.run_id, regexp_extract(p.text, '(?m)^success_metric: (.*)$', 1) AS m,
                    regexp_extract(s.text, 'scoring\\s*=\\s*[''"]([^''"]+)[''"]', 1) AS u
             FROM v_plans p JOIN v_scripts s USING (run_id)))
         WHERE (nm IN ('AUC', 'AUCROC', 'F1', 'ACCURACY', 'RECALL', 'PRECISION', 'ROCAUC')
                AND nu NOT IN ('AUC', 'AUCROC', 'F1', 'ACCURACY', 'RECALL', 'PRECISION', 'ROCAUC'))
            OR (nm IN ('RMSE', 'MAE', 'LOGLOSS', 'MSE')
                AND nu NOT IN ('RMSE', 'MAE', 'LOGLOSS', 'MSE', 'NEGROOTMEANSQUAREDERROR', 'NEGMEANABSOLUTEERROR'))""",
    "m9": """SELECT run_id, 'M9' AS check_id, 'warn' AS severity, 'count=' || n::VARCHAR AS evidence FROM (
           SELECT run_id, len(regexp_extract_all(text, 'random_state\\s*=\\s*42')) AS n FROM v_scripts) WHERE n > 2""",
    "m10": """SELECT run_id, 'M10' AS check_id, 'warn' AS severity, 'count=' || n::VARCHAR AS evidence FROM (
           SELECT run_id, len(regexp_extract_all(text, '(?m)^["'']/(?:Users|tmp|home|content)'))
                          + len(regexp_extract_all(text, '~/?[A-Za-z0-9_]+')) AS n FROM v_scripts) WHERE n > 0""",
    "m11": """SELECT run_id, 'M11' AS check_id, 'warn' AS severity, 'font.family not set' AS evidence FROM v_scripts
         WHERE NOT (contains(text, 'font.family') AND (contains(text, 'AppleGothic') OR contains(text, 'NanumGothic')))""",
    "m12": f"""SELECT c.run_id, 'M12' AS check_id, 'block' AS severity,
                'excluded=disc,' || o.o_orderpriority || '; best=' || c.best AS evidence
         FROM (SELECT run_id, string_agg(feature, ',') AS best, bool_or(feature = 'disc') AS hit FROM {FEATURES} GROUP BY run_id) c
         JOIN orders o ON o.o_orderkey = c.run_id WHERE c.hit AND o.o_orderkey % 4 <> 3""",
}
M_VIEWS = {
    "m1": "v_cycles v_plans v_leak", "m2": "v_plans v_scripts", "m3": "v_scripts", "m4": "v_plans v_scripts",
    "m5": "v_cycles", "m6": "v_cycles", "m7": "v_scripts v_missing", "m8": "v_plans v_scripts", "m9": "v_scripts",
    "m10": "v_scripts", "m11": "v_scripts", "m12": "v_cycles",
}
LEAK_FEATURES = ["l_tax", "disc", "l_quantity"]


def leaks(spark, sf):
    return am.leak_facts(v.leaky_lines(spark, sf), LEAK_FEATURES, "l_extendedprice")


def classes(spark, sf):
    return am.class_facts(read_table(spark, sf, "labels").select("quality"), "quality")


def nulls(spark, sf):
    return am.null_facts(v.partly_labelled(spark, sf).select("quality", "toxic", "lang"))


def both(*parts):
    """A profile from these readers only."""
    return lambda spark, sf: am.run_profile(*[p(spark, sf) for p in parts])


# which notes and facts each check reads
CHECKS = {
    "m1": (both(plans_of, cycles_of), [leaks], lambda: am.m1("l_extendedprice", "lineitem")),
    "m2": (both(plans_of, flags), [], am.m2),
    "m3": (both(flags), [], am.m3),
    "m4": (both(plans_of, flags), [classes], lambda: am.m4("quality")),
    "m5": (both(cycles_of), [], am.m5),
    "m6": (both(cycles_of), [], am.m6),
    "m7": (both(flags), [nulls], am.m7),
    "m8": (both(plans_of, flags), [], am.m8),
    "m9": (both(flags), [], am.m9),
    "m10": (both(flags), [], am.m10),
    "m11": (both(flags), [], am.m11),
    "m12": (both(cycles_of, excluded_of), [], am.m12),
}


def one_check(spark, sf, check):
    profile, facts, rule = CHECKS[check]
    return am.apply_rules(am.with_facts(profile(spark, sf), *[f(spark, sf) for f in facts]), rule())


TITLES = {
    "m1": "target_leakage", "m2": "temporal_leakage", "m3": "preprocessing_leakage", "m4": "cv_strategy",
    "m5": "selection_bias", "m6": "cherry_picking", "m7": "missing_imputation", "m8": "metric_direction",
    "m9": "fixed_seed", "m10": "absolute_path", "m11": "font_preamble", "m12": "excluded_reused",
}
for _id, _title in TITLES.items():
    query(f"{_id}_{_title}", M_SQL[_id], M_VIEWS[_id])(
        lambda spark, sf, _check=_id: one_check(spark, sf, _check).select(*SHORT)
    )


@query(
    "m13_script_flags",
    """SELECT run_id, len(regexp_extract_all(text, 'random_state\\s*=\\s*42'))::INT AS random_state_count,
              contains(text, 'StratifiedKFold') AS uses_stratified_kfold, regexp_matches(text, '\\bKFold\\b') AS uses_kfold,
              contains(text, 'TimeSeriesSplit') AS uses_timeseries_split, contains(text, 'train_test_split') AS uses_train_test_split,
              regexp_matches(text, 'shuffle\\s*=\\s*True') AS uses_shuffle_true,
              nullif(regexp_extract(text, 'scoring\\s*=\\s*[''"]([^''"]+)[''"]', 1), '') AS metric_score_used
       FROM v_scripts""",
    views="v_scripts",
)
def m13(spark, sf):
    return flags(spark, sf).select(
        "run_id", "random_state_count", "uses_stratified_kfold", "uses_kfold", "uses_timeseries_split",
        "uses_train_test_split", "uses_shuffle_true", "metric_score_used",
    )


M_ALL = " UNION ALL ".join(M_SQL[k] for k in M_SQL)
M_ALL_VIEWS = "v_cycles v_plans v_scripts v_leak v_missing"


def method_findings(spark, sf):
    """All twelve checks over one profile row per run."""
    return am.audit(
        plans_of(spark, sf), cycles_of(spark, sf), excluded_of(spark, sf), flags(spark, sf),
        [leaks(spark, sf), classes(spark, sf), nulls(spark, sf)], "l_extendedprice", "quality", "lineitem",
    )


@query("m14_method_audit", M_ALL, M_ALL_VIEWS)
def m14(spark, sf):
    return method_findings(spark, sf).select(*SHORT)


# ---- every run against its own table ---------------------------------------------

OWN_TABLE = "CASE WHEN o_orderkey % 9 = 5 THEN 'elsewhere' WHEN o_orderkey % 4 = 0 OR o_orderkey % 10 = 1 THEN 'lineitem' ELSE 'documents' END"
OWN = f"(SELECT o_orderkey AS run_id, {OWN_TABLE} AS dataset FROM orders)"


def audited_tables(spark, sf):
    """Two tables of different columns; documents lack most labels and hold one column that follows from another."""
    docs = v.partly_labelled(spark, sf).select("lang", "n_chars", "quality", "toxic", (10 - 3 * F.col("quality")).alias("junk_share"))
    return {"lineitem": v.leaky_lines(spark, sf), "documents": docs}


def own_plans(spark, sf):
    tables = read_table(spark, sf, "orders").selectExpr("o_orderkey AS run_id", f"{OWN_TABLE} AS dataset")
    return plans_of(spark, sf).join(tables, "run_id")


OWN_SQL = {
    "m1": f"""SELECT f.run_id, 'M1' AS check_id, 'block' AS severity, 'corr(' || f.feature || ',' || r.target || ')=' || round(r.abs_r, 4)::VARCHAR AS evidence
         FROM {FEATURES} f JOIN v_plans p ON p.run_id = f.run_id JOIN {OWN} d ON d.run_id = f.run_id
         JOIN (SELECT 'lineitem' AS dataset, 'l_extendedprice' AS target, 'l_tax' AS feature, abs(corr(l_tax, l_extendedprice)) AS abs_r FROM v_leak
               UNION ALL SELECT 'lineitem', 'l_extendedprice', 'disc', abs(corr(disc, l_extendedprice)) FROM v_leak
               UNION ALL SELECT 'lineitem', 'l_extendedprice', 'l_quantity', abs(corr(l_quantity, l_extendedprice)) FROM v_leak
               UNION ALL SELECT 'documents', 'quality', 'junk_share', abs(corr(10 - 3 * quality, quality)) FROM v_missing) r
           ON r.dataset = d.dataset AND r.target = {TARGET} AND r.feature = f.feature AND r.abs_r > 0.95""",
    "m4": f"""SELECT p.run_id, 'M4' AS check_id, 'warn' AS severity, 'min_share=' || round(ms, 3)::VARCHAR AS evidence
         FROM v_plans p JOIN v_scripts s USING (run_id) JOIN {OWN} d ON d.run_id = p.run_id
         JOIN (SELECT 'documents' AS dataset, 'quality' AS target, min(c)::DOUBLE / sum(c) AS ms, count(*) AS k FROM (SELECT count(*) AS c FROM v_missing WHERE quality IS NOT NULL GROUP BY quality)
               UNION ALL SELECT 'lineitem', 'l_extendedprice', min(c)::DOUBLE / sum(c), count(*) FROM (SELECT count(*) AS c FROM v_leak WHERE l_extendedprice IS NOT NULL GROUP BY l_extendedprice)) c
           ON c.dataset = d.dataset AND c.target = {TARGET}
         WHERE {TASK} = 'classification' AND k > 1 AND ms < 0.2 AND NOT contains(s.text, 'StratifiedKFold')""",
    "m7": f"""SELECT s.run_id, 'M7' AS check_id, 'warn' AS severity, 'columns: ' || names AS evidence
         FROM v_scripts s JOIN {OWN} d USING (run_id) JOIN (
           SELECT 'documents' AS dataset, string_agg(c, ',' ORDER BY c) AS names FROM (
             SELECT 'quality' AS c, avg((quality IS NULL)::INT) AS r FROM v_missing UNION ALL SELECT 'toxic', avg((toxic IS NULL)::INT) FROM v_missing
             UNION ALL SELECT 'junk_share', avg((quality IS NULL)::INT) FROM v_missing UNION ALL SELECT 'lang', avg((lang IS NULL)::INT) FROM v_missing
             UNION ALL SELECT 'n_chars', avg((n_chars IS NULL)::INT) FROM v_missing) WHERE round(r, 3) > 0.05
           UNION ALL SELECT 'lineitem', string_agg(c, ',' ORDER BY c) FROM (
             SELECT 'disc' AS c, avg((disc IS NULL)::INT) AS r FROM v_leak UNION ALL SELECT 'l_tax', avg((l_tax IS NULL)::INT) FROM v_leak) WHERE round(r, 3) > 0.05) n
           ON n.dataset = d.dataset
         WHERE NOT regexp_matches(s.text, '\\.fillna\\(|SimpleImputer|KNNImputer|IterativeImputer') AND names IS NOT NULL""",
}


def own_check(spark, sf, *rules):
    plans = own_plans(spark, sf)
    profile = am.run_profile(plans, cycles_of(spark, sf), flags(spark, sf))
    return am.apply_rules(am.with_table_facts(profile, audited_tables(spark, sf), plans), *rules).select(*SHORT)


@query("m1_leakage_per_table", OWN_SQL["m1"], "v_cycles v_plans v_leak v_missing")
def m1_own(spark, sf):
    """Leaks of each run's own target in its own table."""
    return own_check(spark, sf, am.m1())


@query("m4_strategy_per_table", OWN_SQL["m4"], "v_plans v_scripts v_missing v_leak")
def m4_own(spark, sf):
    return own_check(spark, sf, am.m4())


@query("m7_gaps_per_table", OWN_SQL["m7"], "v_scripts v_missing v_leak")
def m7_own(spark, sf):
    return own_check(spark, sf, am.m7())


@query("m14_audit_per_table", " UNION ALL ".join(OWN_SQL.get(k, M_SQL[k]) for k in M_SQL), M_ALL_VIEWS)
def m14_own(spark, sf):
    """All twelve checks, each run against the table that it names."""
    return am.audit_tables(
        own_plans(spark, sf), cycles_of(spark, sf), excluded_of(spark, sf), flags(spark, sf), audited_tables(spark, sf)
    ).select(*SHORT)


@query(
    "a8_finding_lines",
    "SELECT run_id, 'FINDING|M6|warn|a fold was left out|scratch/analysis-cycle.md|fold_excluded' AS line "
    "FROM v_cycles WHERE contains(text, 'fold_excluded')",
    views="v_cycles",
)
def a8(spark, sf):
    return sinks.finding_lines(one_check(spark, sf, "m6"))


@query(
    "o18_audit_verdict",
    f"""SELECT run_id, n_block, n_warn, CASE WHEN n_block >= 1 THEN 'FAIL' WHEN n_warn >= 3 THEN 'WARN' ELSE 'PASS' END AS verdict
        FROM (SELECT o_orderkey AS run_id, count(*) FILTER (severity = 'block') AS n_block, count(*) FILTER (severity = 'warn') AS n_warn
              FROM orders LEFT JOIN ({M_ALL}) f ON f.run_id = o_orderkey GROUP BY o_orderkey)""",
    M_ALL_VIEWS,
)
def o18(spark, sf):
    runs = read_table(spark, sf, "orders").select(F.col("o_orderkey").alias("run_id"))
    return trust.audit_verdict(runs, method_findings(spark, sf))


# ---- report audit --------------------------------------------------------------

NOTE = ["notebook", "check_id", "severity", "location", "evidence"]
NUM_PATTERN = r"([A-Za-z가-힣\-\s_]*?)(0\.[0-9]{2,4}|1\.000|0\.0000?)"
CITED = f"""SELECT notebook, cell_index, unnest(range(len(c))) AS pos, trim(unnest(c), E' \\t\\n\\r') AS ctx, unnest(n) AS num FROM (
    SELECT notebook, cell_index, regexp_extract_all(source, '{NUM_PATTERN}', 1) AS c, regexp_extract_all(source, '{NUM_PATTERN}', 2) AS n
    FROM v_cells WHERE cell_type = 'markdown')"""


@query("n0_cited_numbers", f"SELECT notebook, cell_index, pos::INT AS pos, ctx, num FROM ({CITED})", views="v_cells")
def n0(spark, sf):
    return ar.cited_numbers(v.cells(spark, sf))


N_SQL = {
    "n1": f"""SELECT c.notebook, 'N1' AS check_id, 'warn' AS severity, 'cell[' || cell_index::VARCHAR || '] (markdown)' AS location,
                'ctx=' || ctx || ', num=' || num AS evidence
         FROM ({CITED}) c LEFT JOIN v_printed p USING (notebook) WHERE ctx <> '' AND NOT contains(coalesce(all_out, ''), num)""",
    "n2": """SELECT notebook, 'N2' AS check_id, 'block' AS severity,
                'first cell[' || min(cell_index)::VARCHAR || '], ' || count(*)::VARCHAR || ' citations' AS location,
                'values=' || array_to_string(list_sort(list(DISTINCT value)), ',') AS evidence
         FROM (SELECT notebook, cell_index, regexp_replace(upper(m), '[ -]', '', 'g') AS metric, x::DOUBLE AS value FROM (
               SELECT notebook, cell_index,
                 unnest(regexp_extract_all(source, '(AUC[-\\s]?ROC|F1|RMSE|MAE|Accuracy|AUC|R²|R2)[^0-9]{0,5}(0\\.[0-9]{2,4}|1\\.000)', 1)) AS m,
                 unnest(regexp_extract_all(source, '(AUC[-\\s]?ROC|F1|RMSE|MAE|Accuracy|AUC|R²|R2)[^0-9]{0,5}(0\\.[0-9]{2,4}|1\\.000)', 2)) AS x
               FROM v_cells WHERE cell_type = 'markdown'))
         GROUP BY notebook, metric HAVING count(DISTINCT value) > 1""",
    "n5": """SELECT c.notebook, 'N5' AS check_id, 'block' AS severity, 'cell[' || cell_index::VARCHAR || '] (markdown)' AS location,
                'marker=' || marker || ', num=' || num AS evidence
         FROM (SELECT notebook, cell_index, marker, unnest(regexp_extract_all(substr(source, greatest(spot - 30, 1), spot + 50 - greatest(spot - 30, 1)), '0\\.[0-9]{2,4}')) AS num
               FROM (SELECT *, instr(source, marker) AS spot FROM v_cells,
                       (SELECT unnest(['약', '大概', 'roughly', '정도', '쯤', '대략', '≈', 'approximately', '估计']) AS marker)
                     WHERE cell_type = 'markdown') WHERE spot > 0) c
         LEFT JOIN v_printed p USING (notebook) WHERE NOT contains(coalesce(all_out, ''), num)""",
    "n6": """SELECT notebook, 'N6' AS check_id, 'block' AS severity, 'cell[' || cell_index::VARCHAR || '] (code)' AS location,
                'blank text' AS evidence FROM v_cells WHERE cell_type = 'code' AND n_outputs > 0 AND trim(output_text) = ''""",
}
D_SQL = {
    "n3": """SELECT notebook, 'N3' AS check_id, 'warn' AS severity, 'cell[' || cell_index::VARCHAR || '] (markdown)' AS location,
                substr(source, 1, 80) || '...' AS evidence
         FROM v_doc_cells WHERE length(source) >= 100 AND regexp_matches(source, '결론|Conclusion|conclusion')
           AND regexp_matches(source, '향상|개선|높|좋|증가|상향|improved|increased|better|higher')
           AND regexp_matches(source, '하향|감소|낮|악화|떨|worse|lower|decreased|worsen')""",
    "n4": """SELECT notebook, 'N4' AS check_id, 'warn' AS severity, 'whole notebook' AS location,
                'missing=' || array_to_string(m, ',') AS evidence
         FROM (SELECT notebook, list_sort(list_filter([
                 CASE WHEN NOT bool_or(regexp_matches(source, '데이터 개요|Data Overview|Dataset|데이터셋')) THEN '데이터' END,
                 CASE WHEN NOT bool_or(regexp_matches(source, 'EDA|탐색|Pass 1|Pass 2|Pass1|Pass2')) THEN 'EDA' END,
                 CASE WHEN NOT bool_or(regexp_matches(source, '모델|Modeling|Model|Training|학습')) THEN '모델' END,
                 CASE WHEN NOT bool_or(regexp_matches(source, '검증|Verification|Verify|Validation')) THEN '검증' END,
                 CASE WHEN NOT bool_or(regexp_matches(source, '결론|Conclusion|Summary')) THEN '결론' END], lambda x: x IS NOT NULL)) AS m
               FROM v_doc_cells GROUP BY notebook) WHERE len(m) > 0""",
    "n7": """SELECT notebook, 'N7' AS check_id, 'warn' AS severity, 'whole notebook' AS location, array_to_string(m, ',') AS evidence
         FROM (SELECT notebook, list_filter([
                 CASE WHEN t > 0 THEN 'titanic=' || t::VARCHAR END, CASE WHEN h > 0 THEN 'house_price=' || h::VARCHAR END,
                 CASE WHEN i > 0 THEN 'iris=' || i::VARCHAR END, CASE WHEN k > 0 THEN 'mnist=' || k::VARCHAR END,
                 CASE WHEN b > 0 THEN 'imdb=' || b::VARCHAR END], lambda x: x IS NOT NULL) AS m
               FROM (SELECT notebook, count(*) FILTER (regexp_matches(lower(source), 'titanic|타이타닉')) AS t,
                            count(*) FILTER (regexp_matches(lower(source), 'house|집값|주택|real estate')) AS h,
                            count(*) FILTER (regexp_matches(lower(source), 'iris|붓꽃')) AS i,
                            count(*) FILTER (regexp_matches(lower(source), 'mnist|손글씨')) AS k,
                            count(*) FILTER (regexp_matches(lower(source), 'imdb|영화리뷰')) AS b
                     FROM v_doc_cells GROUP BY notebook)) WHERE len(m) >= 2""",
    "n8": """SELECT notebook, 'N8' AS check_id, 'warn' AS severity, 'cell[' || cell_index::VARCHAR || '] (markdown)' AS location,
                'checked=' || path AS evidence
         FROM (SELECT notebook, cell_index, unnest(regexp_extract_all(source, '!\\[.*?\\]\\(([^)]+\\.(?:png|jpg|jpeg|gif|svg))\\)', 1)) AS path FROM v_doc_cells)
         WHERE path NOT IN (SELECT 'figures/plot_' || n_nationkey::VARCHAR || '.png' FROM nation WHERE n_nationkey % 2 = 0)""",
}


@query("n1_unsupported_citations", N_SQL["n1"], "v_cells v_printed")
def n1(spark, sf):
    return ar.unsupported_citations(v.cells(spark, sf)).select(*NOTE)


@query("n2_inconsistent_metrics", N_SQL["n2"], "v_cells")
def n2(spark, sf):
    return ar.inconsistent_metrics(v.cells(spark, sf)).select(*NOTE)


@query("n3_contradictions", D_SQL["n3"], "v_doc_cells")
def n3(spark, sf):
    return ar.contradictions(v.doc_cells(spark, sf)).select(*NOTE)


@query("n4_missing_sections", D_SQL["n4"], "v_doc_cells")
def n4(spark, sf):
    return ar.missing_sections(v.doc_cells(spark, sf)).select(*NOTE)


@query("n5_unsupported_hedges", N_SQL["n5"], "v_cells v_printed")
def n5(spark, sf):
    return ar.unsupported_hedges(v.cells(spark, sf)).select(*NOTE)


@query("n6_blank_outputs", N_SQL["n6"], "v_cells")
def n6(spark, sf):
    return ar.blank_outputs(v.cells(spark, sf)).select(*NOTE)


@query("n7_domain_residue", D_SQL["n7"], "v_doc_cells")
def n7(spark, sf):
    return ar.domain_residue(v.doc_cells(spark, sf)).select(*NOTE)


@query("n8_missing_images", D_SQL["n8"], "v_doc_cells")
def n8(spark, sf):
    return ar.missing_images(v.doc_cells(spark, sf), v.figure_files(spark, sf)).select(*NOTE)


@query(
    "n9_report_audit",
    "SELECT notebook, check_id, severity, count(*) AS n FROM ("
    + " UNION ALL ".join([N_SQL[k] for k in ("n1", "n2", "n5", "n6")])
    + """ UNION ALL SELECT notebook, 'N4', 'warn', '', '' FROM v_cells GROUP BY notebook
        ) GROUP BY ALL""",
    "v_cells v_printed",
)
def n9(spark, sf):
    found = ar.audit(v.cells(spark, sf))
    return found.groupBy("notebook", "check_id", "severity").agg(F.count("*").alias("n"))
