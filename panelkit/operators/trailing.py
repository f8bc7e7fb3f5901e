"""Checks of a new month against a stored trailing state instead of the history.

The state holds, per series, the last ROWS rows (date and value) in order.  It
is built once from the history, advanced by each month's rows, and replaces the
history wherever a check looks back no further: outliers against the trailing
rows, month-on-month and year-on-year changes.  One row of a series and month
is expected, as everywhere in the panel.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.operators.analytics import SERIES_KEY

ROWS = 12


def _last(rows: Column, count: int) -> Column:
    """The last ``count`` elements of a sorted array."""
    return F.slice(rows, F.greatest(F.lit(1), F.size(rows) - count + 1), F.lit(count))


def trailing_state(panel: DataFrame, key: list[str] | None = None, rows: int = ROWS) -> DataFrame:
    """The state of a history: one row per series, ``rows`` sorted by date."""
    key = key or SERIES_KEY
    return panel.groupBy(*key).agg(_last(F.sort_array(F.collect_list(F.struct("date", "value"))), rows).alias("rows"))


def _joined(state: DataFrame, new: DataFrame, key: list[str], how: str) -> DataFrame:
    held = state.select(*[F.col(k).alias(f"_{k}") for k in key], "rows")
    same = F.lit(True)
    for k in key:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return new.select(*key, "date", "value").join(held, same, how)


def advanced_state(state: DataFrame, new: DataFrame, key: list[str] | None = None, rows: int = ROWS) -> DataFrame:
    """The state after the new month, whose rows come after all stored ones; series without a row keep theirs."""
    key = key or SERIES_KEY
    joined = _joined(state, new, key, "full_outer")
    own = F.array_compact(F.array(F.when(F.col("date").isNotNull(), F.struct("date", "value"))))
    merged = F.concat(F.coalesce("rows", F.array().cast("array<struct<date: date, value: double>>")), own)
    return joined.select(*[F.coalesce(F.col(k), F.col(f"_{k}")).alias(k) for k in key], _last(merged, rows).alias("rows"))


def month_outliers(state: DataFrame, new: DataFrame, key: list[str] | None = None, k_sd: float = 3.0) -> DataFrame:
    """The new month's rows of ``quality.range_outliers``, from the state alone."""
    key = key or SERIES_KEY
    values = F.filter(F.transform("rows", lambda r: r["value"]), lambda v: v.isNotNull())
    joined = _joined(state, new, key, "inner").withColumn("values", values)
    n = F.size("values")
    mean = F.try_divide(F.aggregate("values", F.lit(0.0), lambda a, v: a + v), n)
    joined = joined.withColumn("trailing_mean", mean)
    squares = F.aggregate(F.transform("values", lambda v: (v - F.col("trailing_mean")) * (v - F.col("trailing_mean"))), F.lit(0.0), lambda a, v: a + v)
    joined = joined.withColumn("trailing_sd", F.when(n > 1, F.sqrt(squares / (n - 1))))
    out = joined.select(*key, "date", "value", "trailing_mean", "trailing_sd")
    return out.where(F.abs(F.col("value") - F.col("trailing_mean")) > F.lit(k_sd) * F.col("trailing_sd"))


def month_changes(state: DataFrame, new: DataFrame, key: list[str] | None = None) -> DataFrame:
    """The new month's rows of ``analytics.changes``, from the state alone; NULL across a gap."""
    key = key or SERIES_KEY

    def back(months: int) -> Column:
        return F.get(F.filter("rows", lambda r: r["date"] == F.add_months("date", -months)), F.lit(0))["value"]

    joined = _joined(state, new, key, "left").withColumns({"prev_month_value": back(1), "prev_year_value": back(12)})
    out = []
    for name, prev in (("mom", "prev_month_value"), ("yoy", "prev_year_value")):
        change = F.col("value") - F.col(prev)
        out += [change.alias(f"{name}_change"), (F.try_divide(change, F.col(prev)) * 100.0).alias(f"{name}_pct")]
    return joined.select(*key, "date", "value", "prev_month_value", "prev_year_value", *out)
