"""Latest-snapshot discovery and the non-empty data gate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: suffix of superseded ("previous") snapshots.
SUPERSEDED_SUFFIX = "ant.sas7bdat"


# Fixed value: file-name prefix of the monthly register snapshots.
SNAPSHOT_PREFIX = "pafinalmes"


def list_snapshots(spark, directory: str, prefix: str = SNAPSHOT_PREFIX) -> DataFrame:
    """Files of ``directory`` whose names start with ``prefix`` (path only;
    file contents are never read)."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", f"{prefix}*")
        .load(directory)
        .select("path")
    )


def snapshot_files(paths: DataFrame, path_col: str = "path") -> DataFrame:
    """File name, and dataset name without extension, of each listed path.

    Superseded snapshots (names ending ``ant.sas7bdat``) are dropped.
    """
    name = F.element_at(F.split(F.col(path_col), "/"), -1)
    return (
        paths.select(F.col(path_col).alias("path"), name.alias("full_periodo"))
        .where(~F.col("full_periodo").endswith(SUPERSEDED_SUFFIX))
        .withColumn("periodo", F.element_at(F.split(F.col("full_periodo"), r"\."), 1))
    )


def latest_snapshot(paths: DataFrame, path_col: str = "path") -> DataFrame:
    """Rows whose period equals the greatest period (ties are all kept).

    The maximum is a one-row aggregate joined back on equality, i.e. a
    semi join against a scalar; the one-row side is broadcast by plan.
    """
    files = snapshot_files(paths, path_col)
    top = files.agg(F.max("periodo").alias("periodo"))
    return files.join(F.broadcast(top), "periodo").select("path", "full_periodo", "periodo")


def non_empty_report(df: DataFrame, name: str) -> DataFrame:
    """One row: dataset name, whether it holds at least one row.

    ``limit(1)`` keeps the check to one row per task whatever the size.
    """
    probe = df.limit(1).agg(F.count(F.lit(1)).alias("n"))
    return probe.select(F.lit(name).alias("dataset"), (F.col("n") > 0).alias("non_empty"))


def require_non_empty(df: DataFrame, name: str = "extract") -> DataFrame:
    """Raise when the dataset is empty, else return it unchanged."""
    if df.isEmpty():
        raise ValueError(f"{name} is empty")
    return df
