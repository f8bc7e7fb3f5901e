"""Explorer flow over the stored panel, one call per user step.

Choice lists are sorted small DataFrames (bounded by the label and
geography dimensions); the slice, its total and its wide form stay
distributed until the caller writes or shows them.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.operators import explore as X
from panelkit.schema import EXPLORER_COLUMNS
from panelkit.sources.store import read_panel, store_digests, store_ids


def open_panel(spark: SparkSession, store_path: str) -> DataFrame:
    """The explorer's 10-column projection of the store (pruned at the scan)."""
    return read_panel(spark, store_path, EXPLORER_COLUMNS)


def open_labels(spark: SparkSession, store_path: str) -> DataFrame:
    """The labels the store holds, month by month, with their row counts (``n_rows``).

    The digest table next to the store: one row per series and month, written
    anew for a month with each update and revision.  Every choice list, date
    bound and row count comes from it without reading the store.
    """
    return store_digests(spark, store_path)


ID_LIMIT = 1000


def pruned_slice(spark: SparkSession, path: str, series: str, disaggregation: str, sheet_name: str) -> DataFrame:
    """One sheet's rows from the store, reading only that sheet's row groups.

    The names resolve to (book_id, sheet_id) in the store's small id table, a
    handful of rows.  As literals the ids reach the scan, whose files are
    sorted by them, so the statistics skip every other series; over ID_LIMIT
    ids only the names are pushed.
    """
    named = (F.col("series") == series) & (F.col("disaggregation") == disaggregation) & (F.col("sheet_name") == sheet_name)
    store = read_panel(spark, path).where(named)  # one id can hold several disaggregations of a level's book and sheet
    ids = store_ids(spark, path).where(named).select("book_id", "sheet_id").distinct().limit(ID_LIMIT + 1).collect()
    if len(ids) <= ID_LIMIT and all(r.book_id is not None and r.sheet_id is not None for r in ids):
        store = store.where(F.col("book_id").isin(sorted({r.book_id for r in ids})) & F.col("sheet_id").isin(sorted({r.sheet_id for r in ids})))
    return store.select(*EXPLORER_COLUMNS)


def series_choices(panel: DataFrame) -> DataFrame:
    return X.list_series(panel).orderBy("series")


def level_choices(panel: DataFrame, series: str) -> DataFrame:
    return X.list_levels(panel, series).orderBy("level")


def member_choices(panel: DataFrame, series: str, level: str) -> DataFrame:
    return X.list_members(panel, series, level).orderBy("label")


def concept_choices(panel: DataFrame, series: str, level: str) -> DataFrame:
    return X.list_concepts(panel, series, level).orderBy("disaggregation")


def sheet_choices(panel: DataFrame, series: str, level: str, disaggregation: str) -> DataFrame:
    return X.list_sheets(panel, series, level, disaggregation).orderBy("sheet_name")


def default_choice(choices: DataFrame, column: str):
    """First choice in sort order (``min``), or None when there is none."""
    return choices.agg(F.min(column)).first()[0]


def slice_bounds(panel: DataFrame, series: str, level: str, disaggregation: str, sheet_name: str):
    """(first, last) month of a slice; (None, None) for an empty slice."""
    row = (
        panel.where(
            (F.col("series") == series)
            & (F.col("level") == level)
            & (F.col("disaggregation") == disaggregation)
            & (F.col("sheet_name") == sheet_name)
        )
        .agg(F.min("date"), F.max("date"))
        .first()
    )
    return (row[0], row[1]) if row is not None and row[0] is not None else (None, None)


def prepared_data(
    panel: DataFrame,
    series: str,
    level: str,
    disaggregation: str,
    sheet_name: str,
    member_keys: DataFrame,
    start: dt.date | None,
    end: dt.date | None,
    aggregate: bool = False,
) -> DataFrame:
    """The selected entities' lines, or their monthly total."""
    s = X.series_slice(panel, series, level, disaggregation, sheet_name, member_keys, start, end)
    return X.slice_total(s) if aggregate else s


def plot_order(df: DataFrame) -> DataFrame:
    return df.orderBy("grupo", "date")


def make_export(df: DataFrame, shape: str = "long", months: list[dt.date] | None = None, series: str | None = None) -> DataFrame:
    """Long as is, or wide with one column per month (``series`` says whether values of one cell may be summed)."""
    if shape != "wide":
        return df
    ids = tuple(c for c in df.columns if c not in ("date", "value"))
    return X.to_wide(df, months, ids=ids, series=series)
