"""Month continuity: the update gate and the gap report over a history."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SERIES_KEY = ["level", "series", "disaggregation", "sheet_name", "book_name", "clave_delegacion", "clave_subdelegacion"]


def continuity_report(stored: DataFrame, new: DataFrame, candidate: str = "new") -> DataFrame:
    """One row: the new data must hold exactly one month, the month after
    the last stored one.  Both sides are read in one aggregation pass."""
    both = stored.select("date", F.lit(True).alias("stored")).unionByName(new.select("date", F.lit(False).alias("stored")))
    r = both.agg(
        F.max(F.when(F.col("stored"), F.col("date"))).alias("last_stored"),
        F.min(F.when(~F.col("stored"), F.col("date"))).alias("new_min"),
        F.max(F.when(~F.col("stored"), F.col("date"))).alias("new_max"),
        F.count_distinct(F.when(~F.col("stored"), F.col("date"))).cast("bigint").alias("n_new_months"),
    )
    expected = F.add_months(F.col("last_stored"), 1)
    ok = (F.col("n_new_months") == 1) & (F.col("new_min") == expected)
    return r.select(
        F.lit(candidate).alias("candidate"),
        "last_stored",
        "new_min",
        "new_max",
        "n_new_months",
        expected.alias("expected_month"),
        F.coalesce(ok, F.lit(False)).alias("accepted"),
    )


def require_continuity(stored: DataFrame, new: DataFrame):
    """Raise unless the new data is exactly the next month (scalar check);
    return that month."""
    row = continuity_report(stored, new).first()
    if row is not None and row["n_new_months"] == 0:
        raise ValueError("the new month holds no rows")
    if row is None or not row["accepted"]:
        raise ValueError(f"month continuity gate refused the update: {row.asDict() if row else None}")
    return row["new_min"]


def month_gaps(panel: DataFrame, key: list[str] | None = None) -> DataFrame:
    """Per series and entity, consecutive stored months more than one month
    apart.  The window is partitioned by the series key, so each task holds
    one series' months (bounded by the number of months, never by data)."""
    key = key or SERIES_KEY
    w = Window.partitionBy(*key).orderBy("date")
    nxt = F.lead("date").over(w)
    out = panel.select(*key, "date", nxt.alias("next_date"))
    return out.where(F.col("next_date").isNotNull() & (F.col("next_date") != F.add_months(F.col("date"), 1))).select(
        *key,
        "date",
        "next_date",
        (F.months_between(F.col("next_date"), F.col("date")).cast("int") - 1).alias("missing_months"),
    )
