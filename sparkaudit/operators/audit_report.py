"""Report audit over a notebook corpus: cells in, findings out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .audit_method import finding, union_findings

# fixed values: patterns and word lists of the checks
NUMBER_WITH_CONTEXT = r"([A-Za-z가-힣\-\s_]*?)(0\.[0-9]{2,4}|1\.000|0\.0000?)"
NUMBER = r"0\.[0-9]{2,4}"
METRIC_VALUE = r"(AUC[\-\s]?ROC|F1|RMSE|MAE|Accuracy|AUC|R²|R2)[^0-9]{0,5}(0\.[0-9]{2,4}|1\.000)"
IMAGE = r"!\[.*?\]\(([^)]+\.(?:png|jpg|jpeg|gif|svg))\)"
POSITIVE = ["향상", "개선", "높", "좋", "증가", "상향", "improved", "increased", "better", "higher"]
NEGATIVE = ["하향", "감소", "낮", "악화", "떨", "worse", "lower", "decreased", "worsen"]
CONCLUSION = ["결론", "Conclusion", "conclusion"]
HEDGES = ["약", "大概", "roughly", "정도", "쯤", "대략", "≈", "approximately", "估计"]
SECTIONS = {
    "데이터": ["데이터 개요", "Data Overview", "Dataset", "데이터셋"],
    "EDA": ["EDA", "탐색", "Pass 1", "Pass 2", "Pass1", "Pass2"],
    "모델": ["모델", "Modeling", "Model", "Training", "학습"],
    "검증": ["검증", "Verification", "Verify", "Validation"],
    "결론": ["결론", "Conclusion", "Summary"],
}
DOMAINS = {
    "titanic": ["titanic", "타이타닉"],
    "house_price": ["house", "집값", "주택", "real estate"],
    "iris": ["iris", "붓꽃"],
    "mnist": ["mnist", "손글씨"],
    "imdb": ["imdb", "영화리뷰"],
}


def any_of(text: Column, words: list[str]) -> Column:
    """Does the text hold any of the words? Plain substring search, no pattern engine."""
    found = F.lit(False)
    for w in words:
        found = found | text.contains(w)
    return found


def _markdown(cells: DataFrame) -> DataFrame:
    return cells.where(F.col("cell_type") == "markdown")


def _at(kind: str) -> Column:
    return F.concat(F.lit("cell["), F.col("cell_index"), F.lit(f"] ({kind})"))


def cited_numbers(cells: DataFrame) -> DataFrame:
    """N0. Every number with the words before it, one row per citation."""
    pat = F.lit(NUMBER_WITH_CONTEXT)
    pairs = F.posexplode(
        F.arrays_zip(
            F.regexp_extract_all("source", pat, F.lit(1)).alias("ctx"),
            F.regexp_extract_all("source", pat, F.lit(2)).alias("num"),
        )
    ).alias("pos", "pair")
    return _markdown(cells).select("notebook", "cell_index", pairs).select(
        "notebook", "cell_index", "pos",
        F.regexp_replace(F.col("pair.ctx"), r"^\s+|\s+$", "").alias("ctx"),
        F.col("pair.num").alias("num"),
    )


def printed_numbers(cells: DataFrame) -> DataFrame:
    """Distinct (notebook, number) that code outputs contain as a substring.

    Every ``0.`` followed by two or more digits yields its 2-, 3- and 4-digit forms,
    overlapping ones included, so support becomes an equality test.
    """
    digits = F.regexp_extract_all("output_text", F.lit(r"0(?=\.([0-9]{2,4}))"), F.lit(1))
    forms = F.flatten(
        F.transform(
            F.array_distinct(digits),
            lambda d: F.transform(
                F.sequence(F.lit(2), F.length(d)), lambda k: F.concat(F.lit("0."), F.substring(d, F.lit(1), k))
            ),
        )
    )
    one = F.when(F.col("output_text").contains("1.000"), F.array(F.lit("1.000"))).otherwise(
        F.array().cast("array<string>")
    )
    return (
        cells.where(F.col("cell_type") == "code")
        .select("notebook", F.explode(F.array_distinct(F.concat(forms, one))).alias("num"))
        .distinct()
    )


def _without_source(candidates: DataFrame, cells: DataFrame) -> DataFrame:
    """Candidates whose number no code output of the same notebook contains."""
    return candidates.join(printed_numbers(cells), ["notebook", "num"], "left_anti").select("notebook", "f.*")


def _citation_candidates(cells: DataFrame) -> DataFrame:
    return cited_numbers(cells).where(F.col("ctx") != "").select("notebook", "num", F.struct(*finding(
        "N1", "warn",
        F.concat(F.lit("cited number '"), "num", F.lit("' (context '"), F.substring("ctx", 1, 30),
                 F.lit("') is in no code output")),
        _at("markdown"), F.concat(F.lit("ctx="), "ctx", F.lit(", num="), "num"),
    )).alias("f"))


def _hedge_candidates(cells: DataFrame) -> DataFrame:
    return hedged_numbers(cells).select("notebook", "num", F.struct(*finding(
        "N5", "block",
        F.concat(F.lit("hedge '"), "marker", F.lit("' near a number without source: "), "num"),
        _at("markdown"), F.concat(F.lit("marker="), "marker", F.lit(", num="), "num"),
    )).alias("f"))


def unsupported_citations(cells: DataFrame) -> DataFrame:
    """N1."""
    return _without_source(_citation_candidates(cells), cells)


def unsupported_hedges(cells: DataFrame) -> DataFrame:
    """N5."""
    return _without_source(_hedge_candidates(cells), cells)


def metric_citations(cells: DataFrame) -> DataFrame:
    """(notebook, cell, metric, value) of every quoted metric."""
    pat = F.lit(METRIC_VALUE)
    pairs = F.explode(
        F.arrays_zip(
            F.regexp_extract_all("source", pat, F.lit(1)).alias("metric"),
            F.regexp_extract_all("source", pat, F.lit(2)).alias("value"),
        )
    ).alias("pair")
    return _markdown(cells).select("notebook", "cell_index", pairs).select(
        "notebook", "cell_index",
        F.regexp_replace(F.upper("pair.metric"), "[ -]", "").alias("metric"),
        F.col("pair.value").cast("double").alias("value"),
    )


def inconsistent_metrics(cells: DataFrame) -> DataFrame:
    """N2. State per metric is bounded: values have at most four decimals."""
    per_value = metric_citations(cells).groupBy("notebook", "metric", "value").agg(
        F.count("*").alias("n"), F.min("cell_index").alias("first_cell")
    )
    per_metric = per_value.groupBy("notebook", "metric").agg(
        F.count("*").alias("n_values"),
        F.sum("n").alias("n_cited"),
        F.min("first_cell").alias("first_cell"),
        F.concat_ws(",", F.array_sort(F.collect_list("value")).cast("array<string>")).alias("vals"),
    )
    return per_metric.where(F.col("n_values") > 1).select("notebook", *finding(
        "N2", "block",
        F.concat(F.lit("metric '"), "metric", F.lit("' is quoted with "), "n_values", F.lit(" values")),
        F.concat(F.lit("first cell["), "first_cell", F.lit("], "), "n_cited", F.lit(" citations")),
        F.concat(F.lit("values="), "vals"),
    ))


def _contradiction() -> Column:
    t = F.col("source")
    return (
        (F.col("cell_type") == "markdown") & (F.length(t) >= 100)
        & any_of(t, CONCLUSION) & any_of(t, POSITIVE) & any_of(t, NEGATIVE)
    )


def _blank_output() -> Column:
    blank = F.regexp_replace("output_text", r"\s", "") == ""
    return (F.col("cell_type") == "code") & (F.col("n_outputs") > 0) & blank


def _n3() -> list[Column]:
    return finding(
        "N3", "warn", F.lit("conclusion mixes positive and negative words"), _at("markdown"),
        F.concat(F.substring("source", 1, 80), F.lit("...")),
    )


def _n6() -> list[Column]:
    return finding("N6", "block", F.lit("code cell with blank output"), _at("code"), F.lit("blank text"))


def contradictions(cells: DataFrame) -> DataFrame:
    """N3."""
    return cells.where(_contradiction()).select("notebook", *_n3())


def blank_outputs(cells: DataFrame) -> DataFrame:
    """N6."""
    return cells.where(_blank_output()).select("notebook", *_n6())


def cell_findings(cells: DataFrame) -> DataFrame:
    """N3 and N6: a cell is of one type, so at most one of them holds."""
    found = F.when(_contradiction(), F.struct(*_n3())).when(_blank_output(), F.struct(*_n6()))
    return cells.select("notebook", found.alias("f")).where(F.col("f").isNotNull()).select("notebook", "f.*")


def _section_flags() -> list[Column]:
    md = F.col("cell_type") == "markdown"
    return [F.bool_or(md & any_of(F.col("source"), w)).alias(f"s{i}") for i, w in enumerate(SECTIONS.values())]


def _domain_counts() -> list[Column]:
    md, t = F.col("cell_type") == "markdown", F.lower("source")
    return [F.count_if(md & any_of(t, w)).alias(d) for d, w in DOMAINS.items()]


def _n4() -> Column:
    absent = F.array_sort(
        F.array_compact(F.array(*[F.when(~F.col(f"s{i}"), F.lit(c)) for i, c in enumerate(SECTIONS)]))
    )
    names = F.concat_ws(",", absent)
    return F.when(F.size(absent) > 0, F.struct(*finding(
        "N4", "warn", F.concat(F.lit("missing sections: "), names), "whole notebook", F.concat(F.lit("missing="), names),
    )))


def _n7() -> Column:
    active = F.array_compact(
        F.array(*[F.when(F.col(d) > 0, F.concat(F.lit(f"{d}="), F.col(d))) for d in DOMAINS])
    )
    names = F.concat_ws(",", active)
    return F.when(F.size(active) >= 2, F.struct(*finding(
        "N7", "warn", F.concat(F.lit("words of several domains: "), names), "whole notebook", names,
    )))


def _notebook_findings(cells: DataFrame, flags: list[Column], *rules: Column) -> DataFrame:
    """Flags of each notebook are combined map-side; a notebook of any size is one row."""
    seen = cells.groupBy("notebook").agg(*flags)
    return seen.select("notebook", F.explode(F.array_compact(F.array(*rules))).alias("f")).select("notebook", "f.*")


def missing_sections(cells: DataFrame) -> DataFrame:
    """N4. A notebook without markdown misses all sections."""
    return _notebook_findings(cells, _section_flags(), _n4())


def domain_residue(cells: DataFrame) -> DataFrame:
    """N7."""
    return _notebook_findings(cells, _domain_counts(), _n7())


def hedged_numbers(cells: DataFrame) -> DataFrame:
    """Numbers near the first occurrence of each hedge word of a cell."""
    t = F.col("source")
    words = F.filter(F.array(*[F.lit(h) for h in HEDGES]), lambda h: t.contains(h))
    marked = _markdown(cells).select("notebook", "cell_index", "source", F.explode(words).alias("marker"))
    at = F.instr(F.col("source"), F.col("marker"))  # 1-based
    start = F.greatest(at - 30, F.lit(1))
    near = F.substring(F.col("source"), start, at + 50 - start)
    return marked.withColumn("near", near).select(
        "notebook", "cell_index", "marker", F.explode(F.regexp_extract_all("near", F.lit(NUMBER), F.lit(0))).alias("num")
    )


def image_references(cells: DataFrame) -> DataFrame:
    return _markdown(cells).select(
        "notebook", "cell_index", F.explode(F.regexp_extract_all("source", F.lit(IMAGE), F.lit(1))).alias("path")
    )


def missing_images(cells: DataFrame, files: DataFrame) -> DataFrame:
    """N8. ``files`` lists existing paths in the form the cells use."""
    return image_references(cells).join(files.select("path"), "path", "left_anti").select(
        "notebook", *finding(
            "N8", "warn", F.concat(F.lit("image '"), "path", F.lit("' does not exist")), _at("markdown"),
            F.concat(F.lit("checked="), "path"),
        )
    )


def audit(cells: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """All checks as one findings table.

    Checks that look at the same rows share a pass: numbers without source, cells,
    notebooks, quoted metrics.
    """
    candidates = _citation_candidates(cells).unionByName(_hedge_candidates(cells))
    parts = [
        _without_source(candidates, cells),
        inconsistent_metrics(cells),
        cell_findings(cells),
        _notebook_findings(cells, [*_section_flags(), *_domain_counts()], _n4(), _n7()),
    ]
    if files is not None:
        parts.append(missing_images(cells, files))
    return union_findings(parts)
