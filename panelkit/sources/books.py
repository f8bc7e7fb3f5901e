"""The workbooks of a folder, by path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def list_workbooks(spark: SparkSession, root: str) -> DataFrame:
    """Recursive listing of ``.xlsx`` files under ``root``: the catalogue.

    ``binaryFile`` with a glob filter lists files in parallel; only the path
    column is selected, so file contents are never read.
    """
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.xlsx")
        .option("recursiveFileLookup", "true")
        .load(root)
        .select("path")
    )
