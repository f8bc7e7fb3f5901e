"""Quality checks: control totals, referential integrity, revisions,
range outliers, months in common, panel statistics and coverage lists.

Every check is a report DataFrame (testable, distributed); gates that must
stop a pipeline call ``.first()`` / ``isEmpty()`` on a report, never
``collect()`` on data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelkit.operators.panel import FAMILIES, _dictionary_side, family_rows
from panelkit.schema import LEVEL_DELEGATION, LEVEL_SUBDELEGATION, NATIONAL_CODE, SERIES_WAGE

LABEL_KEY = ["date", "series", "disaggregation", "sheet_name", "book_name"]
REVISION_KEY = [
    "book_id", "sheet_id", "date", "clave_delegacion", "clave_subdelegacion", "delegacion", "subdelegacion",
    "series", "disaggregation", "sheet_name", "book_name", "level",
]
# Fixed value: tolerated absolute revision of a stored value.
REVISION_TOLERANCE = 1.0


def _close(a: Column, b: Column, tol: float = 1e-6) -> Column:
    return F.coalesce(F.abs(a - b) <= F.lit(tol), a.isNull() & b.isNull())


def control_totals(panel: DataFrame) -> DataFrame:
    """Σ subdelegation = delegation, Σ delegation = both national rows.

    One ``GROUPING SETS`` pass over the additive series: the set with the
    delegation code checks each delegation, the set without it checks the
    national rows of both level labels.
    """
    add = panel.where(F.col("series") != SERIES_WAGE)
    lv, d = F.col("level"), F.col("clave_delegacion")
    nat = d == NATIONAL_CODE
    sub = (lv == LEVEL_SUBDELEGATION) & ~nat
    dele = (lv == LEVEL_DELEGATION) & ~nat
    g = add.withColumn("dkey", F.when(~nat, d)).groupingSets(
        [LABEL_KEY + ["dkey"], LABEL_KEY], *LABEL_KEY, "dkey"
    ).agg(
        F.sum(F.when(sub, F.col("value"))).alias("sub_sum"),
        F.sum(F.when(dele, F.col("value"))).alias("del_sum"),
        F.max(F.when(nat & (lv == LEVEL_DELEGATION), F.col("value"))).alias("nat_del"),
        F.max(F.when(nat & (lv == LEVEL_SUBDELEGATION), F.col("value"))).alias("nat_sub"),
        F.grouping("dkey").alias("g"),
    )
    per_del = F.col("g") == 0
    lower = F.when(per_del, F.col("sub_sum")).otherwise(F.col("del_sum"))
    upper = F.when(per_del, F.col("del_sum")).otherwise(F.col("nat_del"))
    upper2 = F.when(per_del, F.col("del_sum")).otherwise(F.col("nat_sub"))
    out = g.where(~(per_del & F.col("dkey").isNull())).select(
        F.when(per_del, F.lit("delegation")).otherwise(F.lit("national")).alias("check"),
        *LABEL_KEY,
        F.col("dkey").alias("clave_delegacion"),
        lower.alias("lower_sum"),
        upper.alias("upper_value"),
        upper2.alias("upper_value_2"),
    )
    return out.withColumn("ok", _close(F.col("lower_sum"), F.col("upper_value")) & _close(F.col("lower_sum"), F.col("upper_value_2")))


def referential_check(clean: DataFrame, dic: DataFrame, panel: DataFrame | None = None, geo: DataFrame | None = None) -> DataFrame:
    """Codes of the cube absent from the code dictionary, with the measure
    they carry (lost silently by the panel), and panel geography codes
    absent from the geography dictionary.  Anti joins are null-safe."""
    rows = family_rows(clean, FAMILIES)
    d = _dictionary_side(dic)
    cond = (
        (F.col("series") == F.col("d_series"))
        & (F.col("disaggregation") == F.col("d_dis"))
        & F.col("code").eqNullSafe(F.col("d_code"))
    )
    lost = (
        rows.join(d, cond, "left_anti")
        .groupBy("series", "disaggregation", "code")
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.sum("v").cast("double").alias("lost_value"),
            F.sum("wd").cast("double").alias("lost_weight"),
        )
        .withColumn("check", F.lit("code"))
    )
    if panel is None or geo is None:
        return lost
    # Delegation rows carry no subdelegation code: every known delegation
    # also accepts (code, NULL).
    pairs = geo.select(F.col("clave_delegacion").alias("g_del"), F.col("clave_subdelegacion").alias("g_sub"))
    dels = geo.select(F.col("clave_delegacion").alias("g_del"), F.lit(None).cast("int").alias("g_sub"))
    g = pairs.unionByName(dels).distinct()
    gcond = F.col("clave_delegacion").eqNullSafe(F.col("g_del")) & F.col("clave_subdelegacion").eqNullSafe(F.col("g_sub"))
    geo_lost = (
        panel.join(g, gcond, "left_anti")
        .groupBy("clave_delegacion", "clave_subdelegacion")
        .agg(F.count(F.lit(1)).alias("n_rows"), F.sum("value").alias("lost_value"))
        .select(
            F.lit(None).cast("string").alias("series"),
            F.lit(None).cast("string").alias("disaggregation"),
            F.concat_ws("_", F.coalesce(F.col("clave_delegacion").cast("string"), F.lit("NA")),
                        F.coalesce(F.col("clave_subdelegacion").cast("string"), F.lit("NA"))).alias("code"),
            "n_rows",
            "lost_value",
            F.lit(None).cast("double").alias("lost_weight"),
            F.lit("geography").alias("check"),
        )
    )
    return lost.unionByName(geo_lost)


def dictionary_duplicates(dic: DataFrame) -> DataFrame:
    """Dictionary keys (series, disaggregation, code; NULL code included)
    that map to more than one row: each would multiply panel rows."""
    return (
        dic.groupBy("series", "disaggregation", "sheet_name_code")
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .where(F.col("n_rows") > 1)
    )


def require_unique_dictionary(dic: DataFrame) -> None:
    dup = dictionary_duplicates(dic)
    if not dup.isEmpty():
        raise ValueError(f"code dictionary has duplicate keys: {dup.limit(20).collect()}")


def months_in_common(a: DataFrame, b: DataFrame) -> DataFrame:
    """Months present on both sides.  Each side is first reduced to its
    distinct months (partial aggregation), so the intersection shuffles a
    calendar's worth of rows, not the history."""
    return a.select("date").distinct().intersect(b.select("date").distinct())


def revision_diff(
    new: DataFrame, stored: DataFrame, tol: float = REVISION_TOLERANCE, key: list[str] | None = None, common_months: bool = True
) -> DataFrame:
    """Compare a recomputation with the stored panel over their common months.

    Both sides are first cut to the months they share (a small month list;
    not with ``common_months=False``, where the caller has done it), then full-outer joined null-safe on the panel key.  Rows
    reported: ``changed`` (|new − stored| > tol), ``missing_new``,
    ``missing_stored`` and ``stored_null``.  Each input is read twice (its
    months, its rows): pass stored tables or checkpointed frames.
    """
    key = key or [k for k in REVISION_KEY if k in new.columns and k in stored.columns]
    if common_months:
        common = months_in_common(new, stored)
        new, stored = (side.join(common, "date", "left_semi") for side in (new, stored))
    n = new.select(
        *[F.col(k).alias(f"n_{k}") for k in key], F.col("value").alias("new_value"), F.lit(True).alias("n_present")
    )
    s = stored.select(
        *[F.col(k).alias(f"s_{k}") for k in key], F.col("value").alias("stored_value"), F.lit(True).alias("s_present")
    )
    cond = None
    for k in key:
        c = F.col(f"n_{k}").eqNullSafe(F.col(f"s_{k}"))
        cond = c if cond is None else cond & c
    j = n.join(s, cond, "full_outer")
    # Side markers tell a missing row from a row whose values are NULL.
    n_present = F.col("n_present").isNotNull()
    s_present = F.col("s_present").isNotNull()
    diff = F.col("new_value") - F.col("stored_value")
    status = (
        F.when(~s_present, F.lit("missing_stored"))
        .when(~n_present, F.lit("missing_new"))
        .when(F.col("stored_value").isNull(), F.lit("stored_null"))
        .when(F.abs(diff) > F.lit(tol), F.lit("changed"))
    )
    out = j.select(
        *[F.coalesce(F.col(f"n_{k}"), F.col(f"s_{k}")).alias(k) for k in key],
        "new_value",
        "stored_value",
        diff.alias("diff"),
        status.alias("status"),
    )
    return out.where(F.col("status").isNotNull())


def range_outliers(panel: DataFrame, key: list[str], window_rows: int = 12, k_sd: float = 3.0) -> DataFrame:
    """Values more than ``k_sd`` standard deviations from the mean of the
    previous ``window_rows`` rows of the same series (current row excluded).
    Partitioned by series key: a partition holds one series' months."""
    w = Window.partitionBy(*key).orderBy("date").rowsBetween(-window_rows, -1)
    m, sd = F.avg("value").over(w), F.stddev_samp("value").over(w)
    out = panel.select(*key, "date", "value", m.alias("trailing_mean"), sd.alias("trailing_sd"))
    return out.where(F.abs(F.col("value") - F.col("trailing_mean")) > F.lit(k_sd) * F.col("trailing_sd"))


def panel_stats(panel: DataFrame, rows: str | None = None) -> DataFrame:
    """Rows, months and series of a panel, or of a label table whose column ``rows`` counts the panel's rows."""
    return panel.agg(
        (F.coalesce(F.sum(rows), F.lit(0)).cast("bigint") if rows else F.count(F.lit(1))).alias("n_rows"),
        F.min("date").alias("min_date"),
        F.max("date").alias("max_date"),
        F.count_distinct(F.concat_ws(" ", F.coalesce("series", F.lit("NA")), F.coalesce("disaggregation", F.lit("NA"))))
        .cast("bigint").alias("n_series"),
    )


def panel_coverage(panel: DataFrame) -> DataFrame:
    return panel.select("series", "disaggregation", "level").distinct()


def panel_labels(panel: DataFrame) -> DataFrame:
    return panel.select("series", "disaggregation", "sheet_name", "book_name").distinct()
