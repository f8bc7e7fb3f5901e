"""Explorer queries over the stored panel: dimension lists, slices, totals,
wide pivots and CSV export.  All stay distributed; only the explicit month
list of a pivot (a plan parameter) is ever brought to the driver."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.functions.labels import member_key, member_label
from panelkit.operators.panel import one_value
from panelkit.schema import SERIES_WAGE

MEMBER_COLUMNS = ["clave_delegacion", "delegacion", "clave_subdelegacion", "subdelegacion"]
SLICE_COLUMNS = MEMBER_COLUMNS + ["date", "value"]
# Fixed value: label of the aggregated line.
TOTAL_LABEL = "Total seleccionado"


def _where(panel: DataFrame, **eq) -> DataFrame:
    cond = F.lit(True)
    for k, v in eq.items():
        if v is not None:
            cond = cond & (F.col(k) == F.lit(v))
    return panel.where(cond)


def list_series(panel: DataFrame) -> DataFrame:
    return panel.select("series").distinct()


def list_levels(panel: DataFrame, series: str | None = None) -> DataFrame:
    return _where(panel, series=series).select("series", "level").distinct()


def list_members(panel: DataFrame, series: str | None = None, level: str | None = None) -> DataFrame:
    """Entities of a series and level, with display label and member key."""
    m = _where(panel, series=series, level=level).select("series", "level", *MEMBER_COLUMNS).distinct()
    return m.withColumns({"label": member_label(), "member_key": member_key()})


def list_concepts(panel: DataFrame, series: str | None = None, level: str | None = None) -> DataFrame:
    return _where(panel, series=series, level=level).select("series", "level", "disaggregation").distinct()


def list_sheets(
    panel: DataFrame, series: str | None = None, level: str | None = None, disaggregation: str | None = None
) -> DataFrame:
    return (
        _where(panel, series=series, level=level, disaggregation=disaggregation)
        .select("series", "level", "disaggregation", "sheet_name")
        .distinct()
    )


def date_bounds(panel: DataFrame, by: tuple[str, ...] = ("series", "level", "disaggregation", "sheet_name")) -> DataFrame:
    """First and last month per slice, computed inside the aggregation."""
    return panel.groupBy(*by).agg(F.min("date").alias("min_date"), F.max("date").alias("max_date"))


def parse_member_keys(keys: DataFrame, key_col: str = "member_key", keep: tuple[str, ...] = ()) -> DataFrame:
    """``"<del>_<subdel>"`` → two integer codes; a missing or non-numeric
    part (``NA``, absent) becomes NULL.  ``keep`` columns pass through."""
    parts = F.split(F.col(key_col), "_")
    return keys.select(
        *keep,
        F.col(key_col).alias("member_key"),
        F.try_element_at(parts, F.lit(1)).try_cast("int").alias("clave_delegacion"),
        F.try_element_at(parts, F.lit(2)).try_cast("int").alias("clave_subdelegacion"),
    )


def series_slice(
    panel: DataFrame,
    series: str,
    level: str | tuple[str, ...],
    disaggregation: str,
    sheet_name: str,
    member_keys: DataFrame,
    start: dt.date | str | None = None,
    end: dt.date | str | None = None,
) -> DataFrame:
    """Selected entities of one sheet between two months (inclusive).

    The selection is a semi join on the parsed codes, NULL matching NULL so
    delegation rows (no subdelegation code) can be selected.  The key side
    is distinct; Spark broadcasts it when its size statistics allow.

    Several levels can be sliced in one pass: pass a tuple of levels and
    member keys carrying a ``level`` column; the output then keeps
    ``level``.
    """
    multi = not isinstance(level, str)
    kcols = [F.col("level").alias("k_level")] if multi else []
    parsed = parse_member_keys(member_keys.select("member_key", *(["level"] if multi else [])), keep=("level",) if multi else ())
    keys = parsed.select(
        *kcols, F.col("clave_delegacion").alias("k_del"), F.col("clave_subdelegacion").alias("k_sub")
    ).distinct()
    cond = F.col("clave_delegacion").eqNullSafe(F.col("k_del")) & F.col("clave_subdelegacion").eqNullSafe(F.col("k_sub"))
    if multi:
        cond = cond & (F.col("level") == F.col("k_level"))
        p = _where(panel, series=series, disaggregation=disaggregation, sheet_name=sheet_name).where(
            F.col("level").isin(*level)
        )
    else:
        p = _where(panel, series=series, level=level, disaggregation=disaggregation, sheet_name=sheet_name)
    if start is not None:
        p = p.where(F.col("date") >= F.lit(start).cast("date"))
    if end is not None:
        p = p.where(F.col("date") <= F.lit(end).cast("date"))
    out = p.join(keys, cond, "left_semi").select(*(["level"] if multi else []), *SLICE_COLUMNS)
    return out.withColumn("grupo", member_label())


def slice_total(sliced: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Sum of the selected entities per month (NULLs ignored, empty → 0).

    Wages are summed like any series here, as the explorer does; the result
    is a sum of means and is documented as such.
    """
    return sliced.groupBy(*by, "date").agg(
        F.coalesce(F.sum("value"), F.lit(0.0)).alias("value")
    ).withColumn("grupo", F.lit(TOTAL_LABEL))


def month_column(d: dt.date) -> str:
    return f"m_{d.year:04d}_{d.month:02d}"


def to_wide(
    sliced: DataFrame,
    months: list[dt.date] | None = None,
    ids: tuple[str, ...] = (*MEMBER_COLUMNS, "grupo"),
    series: str | None = None,
) -> DataFrame:
    """Long → wide: one column per month, named ``m_YYYY_MM``.

    Several values of one cell are summed if ``series`` (the slice's own, or
    its ``series`` column) is additive, and raise otherwise.

    Passing the month list avoids the extra distinct job; without it the
    (small, bounded) month list of the slice is computed first.
    """
    if months is None:
        months = [r[0] for r in sliced.select("date").distinct().orderBy("date").collect()]
    named = F.col("series") if series is None and "series" in sliced.columns else F.lit(series)
    wide = sliced.groupBy(*ids).pivot("date", months).agg(one_value(named != SERIES_WAGE))
    return wide.select(*ids, *[F.col(f"`{m.isoformat()}`").alias(month_column(m)) for m in months])


def export_csv(df: DataFrame, path: str) -> str:
    """CSV with header, NULL written as empty; part files in ``path``."""
    df.write.mode("overwrite").option("header", True).option("nullValue", "").option("emptyValue", "").csv(path)
    return path


def export_name(series: str, day: dt.date) -> str:
    return f"time_series_{series}_{day.isoformat()}"
