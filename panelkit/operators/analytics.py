"""Series analytics declared on the roadmap: changes, anomalies, summaries,
seasonal profiles and correlations.

All of them partition by the series key, so one task holds one series'
months (bounded by the calendar, never by the register size).  Previous
month / previous year values come from a *range* frame over a month index,
which finds the value exactly 1 or 12 months earlier and gives NULL across
a gap, where ``lag`` would silently take the previous *row*; no self join,
one shuffle.  Two codes of one sheet give two rows of a series and month;
``monthly`` makes them one first, in the same shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelkit.operators.panel import one_value
from panelkit.schema import SERIES_WAGE

SERIES_KEY = ["level", "series", "disaggregation", "sheet_name", "book_name", "clave_delegacion", "clave_subdelegacion"]
ENTITY_KEY = ["level", "clave_delegacion", "clave_subdelegacion"]


def month_index(d: Column | str = "date") -> Column:
    c = F.col(d) if isinstance(d, str) else d
    return F.year(c) * 12 + F.month(c)


def monthly(panel: DataFrame, key: list[str]) -> DataFrame:
    """One row per key and month: rows of additive series are summed, several wages of one month raise."""
    series = F.col("series") if "series" in panel.columns else F.lit(None).cast("string")
    return panel.repartition(*key).groupBy(*key, "date").agg(one_value(series != SERIES_WAGE))


def _value_months_back(key: list[str], months: int) -> Column:
    w = Window.partitionBy(*key).orderBy(month_index()).rangeBetween(-months, -months)
    return F.first("value").over(w)


def _pct(cur: Column, prev: Column) -> Column:
    return F.try_divide(cur - prev, prev) * F.lit(100.0)


def changes(panel: DataFrame, key: list[str] | None = None) -> DataFrame:
    """Month-on-month and year-on-year change of each series value."""
    key = key or SERIES_KEY
    out = monthly(panel, key).select(
        *key,
        "date",
        "value",
        _value_months_back(key, 1).alias("prev_month_value"),
        _value_months_back(key, 12).alias("prev_year_value"),
    )
    return out.withColumns(
        {
            "mom_change": F.col("value") - F.col("prev_month_value"),
            "mom_pct": _pct(F.col("value"), F.col("prev_month_value")),
            "yoy_change": F.col("value") - F.col("prev_year_value"),
            "yoy_pct": _pct(F.col("value"), F.col("prev_year_value")),
        }
    )


def anomalies(panel: DataFrame, key: list[str] | None = None, window_rows: int = 12, k_sd: float = 3.0) -> DataFrame:
    """Month-on-month changes far from the trailing mean of earlier changes."""
    key = key or SERIES_KEY
    ch = changes(panel, key).where(F.col("mom_change").isNotNull())
    w = Window.partitionBy(*key).orderBy("date").rowsBetween(-window_rows, -1)
    m, sd = F.avg("mom_change").over(w), F.stddev_samp("mom_change").over(w)
    out = ch.select(*key, "date", "value", "mom_change", m.alias("trailing_mean"), sd.alias("trailing_sd"))
    return out.where(F.abs(F.col("mom_change") - F.col("trailing_mean")) > F.lit(k_sd) * F.col("trailing_sd"))


def summary(panel: DataFrame, key: list[str] | None = None) -> DataFrame:
    """Per series: span, latest value, range, mean and change on the
    previous month.  The last month is a window max on the same partitioning
    as the aggregate, so Spark reuses one shuffle."""
    key = key or SERIES_KEY
    last = F.max("date").over(Window.partitionBy(*key))
    p = monthly(panel, key).withColumn("last_date", last)
    agg = p.groupBy(*key).agg(
        F.count(F.lit(1)).cast("bigint").alias("n_months"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        F.max(F.when(F.col("date") == F.col("last_date"), F.col("value"))).alias("last_value"),
        F.max(F.when(F.col("date") == F.add_months(F.col("last_date"), -1), F.col("value"))).alias("prev_value"),
        F.min("value").alias("min_value"),
        F.max("value").alias("max_value"),
        F.avg("value").alias("mean_value"),
    )
    return agg.withColumns(
        {"change": F.col("last_value") - F.col("prev_value"), "pct_change": _pct(F.col("last_value"), F.col("prev_value"))}
    )


def seasonal_profile(panel: DataFrame, key: list[str] | None = None) -> DataFrame:
    """Mean ratio of each calendar month to its year's mean, per series."""
    key = key or SERIES_KEY
    # Same-year frame inside the series partition: the aggregate below groups
    # by the series key plus month, so it reuses this partitioning (one
    # shuffle in total instead of one per key).
    same_year = Window.partitionBy(*key).orderBy(F.year("date")).rangeBetween(0, 0)
    year_mean = F.avg("value").over(same_year)
    r = monthly(panel, key).select(*key, F.month("date").alias("month"), F.try_divide(F.col("value"), year_mean).alias("ratio"))
    return r.groupBy(*key, "month").agg(
        F.avg("ratio").alias("seasonal_index"), F.count("ratio").cast("bigint").alias("n_years")
    )


def series_correlation(
    panel: DataFrame,
    reference_series: str = "Asegurados",
    reference_disaggregation: str = "Modalidad",
    key: list[str] | None = None,
    entity: list[str] | None = None,
    min_months: int = 3,
) -> DataFrame:
    """Correlation over time between each series and the entity's reference
    series (total of the reference sheets for the same entity and month).

    The reference is aggregated per entity and month, with a map-side pass,
    and joined back: a large entity never sits in one task.  Series of fewer
    than ``min_months`` months, or constant ones, get NULL.
    """
    key = key or SERIES_KEY
    entity = entity or ENTITY_KEY
    is_ref = (F.col("series") == reference_series) & (F.col("disaggregation") == reference_disaggregation)
    sums = panel.where(is_ref).groupBy(*[F.col(c).alias(f"r_{c}") for c in entity], F.col("date").alias("r_date")).agg(F.sum("value").alias("reference_value"))
    same = F.col("date") == F.col("r_date")
    for c in entity:
        same = same & F.col(c).eqNullSafe(F.col(f"r_{c}"))
    p = panel.join(sums, same).where(F.col("reference_value").isNotNull())
    agg = p.groupBy(*key).agg(
        F.count(F.lit(1)).cast("bigint").alias("n_months"),
        F.covar_pop("value", "reference_value").alias("cov"),
        F.stddev_pop("value").alias("sd_v"),
        F.stddev_pop(F.when(F.col("value").isNotNull(), F.col("reference_value"))).alias("sd_r"),
    )
    ok = (F.col("n_months") >= min_months) & (F.col("sd_v") > 0) & (F.col("sd_r") > 0)
    corr = F.try_divide(F.col("cov"), F.col("sd_v") * F.col("sd_r"))
    return agg.select(*key, "n_months", F.when(ok, corr).alias("correlation"))


SHEET = ["series", "disaggregation", "sheet_name"]
MOMENTS = ["n_months", "mean_a", "mean_b", "m_aa", "m_bb", "m_ab"]


def _pair_key(entity: list[str]) -> list[str]:
    return [*entity, *[f"{c}_{side}" for side in "ab" for c in SHEET]]


def pair_moments(panel: DataFrame, entity: list[str] | None = None) -> DataFrame:
    """Central co-moments over time of every two sheets of an entity: n_months, means and summed (cross) products of deviations.

    The sheets of an entity's month come together first (rows of additive
    series are summed, two wages raise), then each pair of them gives one
    row: the square of the dictionary per entity and month, whatever the
    register holds.  NULL values take no part.
    """
    entity = entity or ENTITY_KEY
    cells = monthly(panel.where(F.col("value").isNotNull()), [*entity, *SHEET])
    own = F.sort_array(F.collect_list(F.struct(*SHEET, "value"))).alias("sheets")
    sheets = cells.groupBy(*entity, "date").agg(own)
    firsts = sheets.select(*entity, "date", "sheets", F.posexplode("sheets").alias("i", "a"))
    rest = F.slice("sheets", F.col("i") + 2, F.size("sheets"))
    pairs = firsts.select(*entity, "a", F.explode(rest).alias("b"))
    names = [F.col(f"{side}.{c}").alias(f"{c}_{side}") for side in "ab" for c in SHEET]
    x, y, n = F.col("a.value"), F.col("b.value"), F.count(F.lit(1))
    flat = pairs.select(*entity, *names, x.alias("x"), y.alias("y"))
    return flat.groupBy(*_pair_key(entity)).agg(
        n.cast("bigint").alias("n_months"), F.avg("x").alias("mean_a"), F.avg("y").alias("mean_b"),
        (F.var_pop("x") * n).alias("m_aa"), (F.var_pop("y") * n).alias("m_bb"), (F.covar_pop("x", "y") * n).alias("m_ab"),
    )


def merge_pair_moments(parts: DataFrame, entity: list[str] | None = None) -> DataFrame:
    """One row per pair from the moments of disjoint months, so a new month needs no history."""
    entity = entity or ENTITY_KEY
    n = F.sum("n_months")

    def mean(side: str) -> Column:
        return F.sum(F.col("n_months") * F.col(f"mean_{side}")) / n

    def moment(a: str, b: str) -> Column:
        between = F.sum(F.col("n_months") * F.col(f"mean_{a}") * F.col(f"mean_{b}")) - n * mean(a) * mean(b)
        return F.sum(f"m_{a}{b}") + between

    return parts.groupBy(*_pair_key(entity)).agg(
        n.cast("bigint").alias("n_months"), mean("a").alias("mean_a"), mean("b").alias("mean_b"),
        moment("a", "a").alias("m_aa"), moment("b", "b").alias("m_bb"), moment("a", "b").alias("m_ab"),
    )


def pair_correlation(moments: DataFrame, entity: list[str] | None = None, min_months: int = 3) -> DataFrame:
    """Correlation of every two sheets of an entity; NULL for fewer than ``min_months`` common months or a constant side."""
    ok = (F.col("n_months") >= min_months) & (F.col("m_aa") > 0) & (F.col("m_bb") > 0)
    return moments.select(*_pair_key(entity or ENTITY_KEY), "n_months", F.when(ok, F.col("m_ab") / (F.sqrt("m_aa") * F.sqrt("m_bb"))).alias("correlation"))
