"""Registered checks of a new month against a stored trailing state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.operators import trailing as T
from panelkit.operators.analytics import SERIES_KEY
from panelkit.registry.analytics import ORACLE as ANALYTICS
from panelkit.registry.common import rv
from panelkit.registry.quality import ORACLE as QUALITY
from panelkit.registry.store import split_history
from panelkit.session import scratch_path


def stored_state(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """The state of the history, built up to its last month, advanced by that month and stored each time; and the new month."""
    hist, new, _ = split_history(spark, sf)
    last = hist.agg(F.max("date")).first()[0]
    states = [T.trailing_state(hist.where(F.col("date") < F.lit(last)))]
    for month in (hist.where(F.col("date") == F.lit(last)), None):
        path = scratch_path(spark, "trailing-state")
        states[-1].write.parquet(path)
        stored = spark.read.parquet(path)
        if month is None:
            return stored, new
        states.append(T.advanced_state(stored, month))


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumns({c: rv(c) for c in df.columns if c not in (*SERIES_KEY, "date")})


def q_new_month_outliers(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(T.month_outliers(*stored_state(spark, sf)))


def q_new_month_changes(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(T.month_changes(*stored_state(spark, sf)))


QUERIES = {"new_month_outliers": q_new_month_outliers, "new_month_changes": q_new_month_changes}

# The full runs, cut to the last month of their input.
_LAST = "date = (SELECT max(date) FROM a)"
ORACLE = {"new_month_outliers": f"{QUALITY['range_outliers']} AND {_LAST}", "new_month_changes": f"{ANALYTICS['mom_yoy_change']} WHERE {_LAST}"}
