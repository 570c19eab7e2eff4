"""Notebook corpora: one row per cell."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# text fields may be a string or a list of strings; read as raw text, joined below
NOTEBOOK_SCHEMA = (
    "cells array<struct<cell_type: string, source: string, "
    "outputs: array<struct<output_type: string, text: string, "
    "data: struct<`text/plain`: string>, printout: string>>>>"
)


def joined_text(raw: Column) -> Column:
    """A JSON list of strings joined, or the string itself."""
    parts = F.from_json(raw, "array<string>")
    return F.when(raw.startswith("["), F.coalesce(F.concat_ws("", parts), raw)).otherwise(raw)


def output_text(outputs: Column) -> Column:
    """Text of all outputs of a cell: ``text``, else the plain ``data``, and ``printout``."""
    parts = F.flatten(
        F.transform(
            outputs,
            lambda o: F.array(
                F.coalesce(joined_text(o["text"]), joined_text(o["data"]["text/plain"])), o["printout"]
            ),
        )
    )
    return F.concat_ws("\n", parts)


def cells_of(notebooks: DataFrame, key: str = "notebook") -> DataFrame:
    """Cell table from rows with a ``cells`` array.

    A notebook without cells, or one that does not parse, keeps one empty row without
    index and type, so that checks for missing parts see it.
    """
    rows = notebooks.select(key, F.posexplode_outer("cells").alias("cell_index", "cell"))
    is_code = F.col("cell.cell_type") == "code"
    return rows.select(
        key,
        F.col("cell_index").cast("bigint").alias("cell_index"),
        F.col("cell.cell_type").alias("cell_type"),
        F.coalesce(joined_text(F.col("cell.source")), F.lit("")).alias("source"),
        F.when(is_code, F.coalesce(F.size("cell.outputs"), F.lit(0))).otherwise(0).cast("bigint").alias("n_outputs"),
        F.when(is_code, F.coalesce(output_text(F.col("cell.outputs")), F.lit(""))).otherwise("").alias("output_text"),
    )


def read_notebooks(spark: SparkSession, folder: str) -> DataFrame:
    """Cells of every ``*.ipynb`` below the folder."""
    raw = (
        spark.read.schema(NOTEBOOK_SCHEMA)
        .option("multiLine", True)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.ipynb")
        .json(folder)
        .select(F.col("_metadata.file_path").alias("notebook"), "cells")
    )
    return cells_of(raw)


def list_files(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """Paths below a folder, without reading the contents."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(folder)
        .select("path", F.col("modificationTime").alias("modified"))
    )
