"""Registered quality and review queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.operators import quality as Q
from panelkit.operators import review as R
from panelkit.operators.explore import export_csv
from panelkit.operators.snapshot import non_empty_report
from panelkit.registry import oracle_base as O
from panelkit.registry.common import clean, panel, rv, stored_labels, stored_panel
from panelkit.registry.store import HIST, hist_with_ids, split_history
from panelkit.schema import LEVEL_DELEGATION, PANEL_COLUMNS
from panelkit.plans.monthly import stored_revision_diff
from panelkit.session import cut_lineage, scratch_path
from panelkit.sources.register import code_dictionary, geo_dictionary
from panelkit.sources.store import reset_panel

# Cut-off of the employer export; revision fixture rules.
EXPORT_SINCE = dt.date(2000, 1, 1)
REVISED_EVERY, DROPPED_SUBDEL, REVISION_BUMP = 7, 3, 2.0
BROKEN_DELEGATION, BROKEN_MONTH = 2, 5

OUTLIER_KEY = ["level", "series", "disaggregation", "sheet_name", "book_name", "clave_delegacion", "clave_subdelegacion"]


def revised_history(h: DataFrame) -> DataFrame:
    """F-REV: the history with some values revised and one subdelegation
    missing, as a recomputation might come back."""
    sub = F.col("clave_subdelegacion")
    return h.where(~sub.eqNullSafe(F.lit(DROPPED_SUBDEL))).withColumn(
        "value", F.when(sub % REVISED_EVERY == 0, F.col("value") + REVISION_BUMP).otherwise(F.col("value"))
    )


def q_non_empty_gate(spark: SparkSession, sf: str) -> DataFrame:
    hist, new, _ = split_history(spark, sf)
    return (
        non_empty_report(hist, "hist")
        .unionByName(non_empty_report(new, "new"))
        .unionByName(non_empty_report(new.where(F.lit(False)), "empty"))
    )


def broken_totals(panel_df: DataFrame) -> DataFrame:
    """A panel in which one delegation's totals of one calendar month are off by one."""
    hit = (F.col("level") == LEVEL_DELEGATION) & (F.col("clave_delegacion") == BROKEN_DELEGATION) & (F.month("date") == BROKEN_MONTH)
    return panel_df.withColumn("value", F.when(hit, F.col("value") + 1).otherwise(F.col("value")))


def q_control_totals(spark: SparkSession, sf: str) -> DataFrame:
    return Q.control_totals(broken_totals(panel(spark, sf)))


def q_referential_check(spark: SparkSession, sf: str) -> DataFrame:
    c = clean(spark, sf)
    out = Q.referential_check(c, code_dictionary(spark), panel(spark, sf), geo_dictionary(spark, sf))
    # Sums over series that are not additive depend on the order of the rows.
    return out.withColumn("lost_value", F.when(F.col("check") == "geography", rv("lost_value")).otherwise(F.col("lost_value")))


def q_revision_diff(spark: SparkSession, sf: str) -> DataFrame:
    """The recomputed history against a store that holds the published one."""
    h, _, _, _ = hist_with_ids(spark, sf)
    path = scratch_path(spark, "panel-store")
    reset_panel(h, path)
    return stored_revision_diff(spark, path, cut_lineage(revised_history(h)))


def q_range_outliers(spark: SparkSession, sf: str) -> DataFrame:
    out = Q.range_outliers(stored_panel(spark, sf), OUTLIER_KEY)
    return out.withColumns({c: rv(c) for c in ("trailing_mean", "trailing_sd")})


def q_months_in_common(spark: SparkSession, sf: str) -> DataFrame:
    h, _, new, _ = hist_with_ids(spark, sf)
    return Q.months_in_common(revised_history(h).unionByName(new.withColumns({"book_id": F.lit(None).cast("int"), "sheet_id": F.lit(None).cast("int")})), h)


def q_panel_stats(spark: SparkSession, sf: str) -> DataFrame:
    return Q.panel_stats(stored_labels(spark, sf), "n_rows")


def q_panel_coverage(spark: SparkSession, sf: str) -> DataFrame:
    return Q.panel_coverage(stored_labels(spark, sf))


def q_panel_labels(spark: SparkSession, sf: str) -> DataFrame:
    return Q.panel_labels(stored_labels(spark, sf))


def q_review_national(spark: SparkSession, sf: str) -> DataFrame:
    return R.review_national(stored_panel(spark, sf))


def q_review_by_delegation(spark: SparkSession, sf: str) -> DataFrame:
    return R.review_by_delegation(stored_panel(spark, sf))


def q_national_by_modality(spark: SparkSession, sf: str) -> DataFrame:
    return R.national_by_modality(stored_panel(spark, sf))


def q_employers_since(spark: SparkSession, sf: str) -> DataFrame:
    df = R.since(stored_panel(spark, sf), "Patrones", LEVEL_DELEGATION, EXPORT_SINCE)
    path = scratch_path(spark, "patrones_delegacional")
    export_csv(df, path)
    return spark.read.schema(df.schema).option("header", True).option("nullValue", "").csv(path)


QUERIES = {
    "non_empty_gate": q_non_empty_gate,
    "control_totals": q_control_totals,
    "referential_check": q_referential_check,
    "revision_diff": q_revision_diff,
    "range_outliers": q_range_outliers,
    "months_in_common": q_months_in_common,
    "panel_stats": q_panel_stats,
    "panel_coverage": q_panel_coverage,
    "panel_labels": q_panel_labels,
    "review_national": q_review_national,
    "review_by_delegation": q_review_by_delegation,
    "national_by_modality": q_national_by_modality,
    "employers_since": q_employers_since,
}

_LK = "date, series, disaggregation, sheet_name, book_name"
_RK = ("book_id, sheet_id, date, clave_delegacion, clave_subdelegacion, delegacion, subdelegacion, "
       "series, disaggregation, sheet_name, book_name, level").split(", ")
_COLS = ", ".join(c for c in PANEL_COLUMNS if c != "value")
_OK = "coalesce(abs({a} - {b}) <= 1e-6, {a} IS NULL AND {b} IS NULL)"

REV = """,
rev AS (SELECT {cols}, CASE WHEN clave_subdelegacion % 7 = 0 THEN value + 2 ELSE value END AS value
        FROM hist_ids WHERE clave_subdelegacion IS DISTINCT FROM 3)""".format(cols=_COLS)

_REV_JOIN = " AND ".join(f"n.{k} IS NOT DISTINCT FROM s.{k}" for k in _RK)
_REV_SEL = ", ".join(f"coalesce(n.{k}, s.{k}) AS {k}" for k in _RK)

_REVIEW = " OR ".join(
    f"(series = '{s}' AND disaggregation = '{d}' AND regexp_matches(sheet_name, '{p}'))" for s, d, p in R.REVIEW_PATTERNS
)

ORACLE = {
    "non_empty_gate": f"""{O.PANEL_BASE}{HIST}
        SELECT 'hist' AS dataset, (SELECT count(*) FROM hist) > 0 AS non_empty
        UNION ALL SELECT 'new', (SELECT count(*) FROM newm) > 0
        UNION ALL SELECT 'empty', (SELECT count(*) FROM newm WHERE false) > 0""",
    "control_totals": f"""{O.PANEL_BASE}, a AS (SELECT * REPLACE (CASE WHEN level = 'Delegación' AND clave_delegacion = {BROKEN_DELEGATION}
            AND month(date) = {BROKEN_MONTH} THEN value + 1 ELSE value END AS value) FROM panel_full WHERE series <> 'Salario'),
        per_del AS (
          SELECT 'delegation' AS "check", {_LK}, clave_delegacion,
            sum(CASE WHEN level = 'Subdelegación' THEN value END) AS lower_sum,
            sum(CASE WHEN level = 'Delegación' THEN value END) AS upper_value,
            sum(CASE WHEN level = 'Delegación' THEN value END) AS upper_value_2
          FROM a WHERE clave_delegacion <> 99 GROUP BY {_LK}, clave_delegacion),
        per_nat AS (
          SELECT 'national' AS "check", {_LK}, CAST(NULL AS INT) AS clave_delegacion,
            sum(CASE WHEN level = 'Delegación' AND clave_delegacion <> 99 THEN value END) AS lower_sum,
            max(CASE WHEN level = 'Delegación' AND clave_delegacion = 99 THEN value END) AS upper_value,
            max(CASE WHEN level = 'Subdelegación' AND clave_delegacion = 99 THEN value END) AS upper_value_2
          FROM a GROUP BY {_LK}),
        u AS (SELECT * FROM per_del UNION ALL SELECT * FROM per_nat)
        SELECT "check", {_LK}, clave_delegacion, lower_sum, upper_value, upper_value_2,
          {_OK.format(a='lower_sum', b='upper_value')} AND {_OK.format(a='lower_sum', b='upper_value_2')} AS ok FROM u""",
    "months_in_common": q_months_in_common,
    "panel_stats": q_panel_stats,
    "panel_coverage": q_panel_coverage,
    "panel_labels": q_panel_labels,
    "review_national": q_review_national,
    "review_by_delegation": q_review_by_delegation,
    "national_by_modality": q_national_by_modality,
    "employers_since": q_employers_since,
}

_LK = "date, series, disaggregation, sheet_name, book_name"
_RK = ("book_id, sheet_id, date, clave_delegacion, clave_subdelegacion, delegacion, subdelegacion, "
       "series, disaggregation, sheet_name, book_name, level").split(", ")
_COLS = ", ".join(c for c in PANEL_COLUMNS if c != "value")
_OK = "coalesce(abs({a} - {b}) <= 1e-6, {a} IS NULL AND {b} IS NULL)"

REV = """,
rev AS (SELECT {cols}, CASE WHEN clave_subdelegacion % 7 = 0 THEN value + 2 ELSE value END AS value
        FROM hist_ids WHERE clave_subdelegacion IS DISTINCT FROM 3)""".format(cols=_COLS)

_REV_JOIN = " AND ".join(f"n.{k} IS NOT DISTINCT FROM s.{k}" for k in _RK)
_REV_SEL = ", ".join(f"coalesce(n.{k}, s.{k}) AS {k}" for k in _RK)

_REVIEW = " OR ".join(
    f"(series = '{s}' AND disaggregation = '{d}' AND regexp_matches(sheet_name, '{p}'))" for s, d, p in R.REVIEW_PATTERNS
)

ORACLE = {
    "non_empty_gate": f"""{O.PANEL_BASE}{HIST}
        SELECT 'hist' AS dataset, (SELECT count(*) FROM hist) > 0 AS non_empty
        UNION ALL SELECT 'new', (SELECT count(*) FROM newm) > 0
        UNION ALL SELECT 'empty', (SELECT count(*) FROM newm WHERE false) > 0""",
    "control_totals": f"""{O.PANEL_BASE}, a AS (SELECT * REPLACE (CASE WHEN level = 'Delegación' AND clave_delegacion = {BROKEN_DELEGATION}
            AND month(date) = {BROKEN_MONTH} THEN value + 1 ELSE value END AS value) FROM panel_full WHERE series <> 'Salario'),
        per_del AS (
          SELECT 'delegation' AS "check", {_LK}, clave_delegacion,
            sum(CASE WHEN level = 'Subdelegación' THEN value END) AS lower_sum,
            sum(CASE WHEN level = 'Delegación' THEN value END) AS upper_value,
            sum(CASE WHEN level = 'Delegación' THEN value END) AS upper_value_2
          FROM a WHERE clave_delegacion <> 99 GROUP BY {_LK}, clave_delegacion),
        per_nat AS (
          SELECT 'national' AS "check", {_LK}, CAST(NULL AS INT) AS clave_delegacion,
            sum(CASE WHEN level = 'Delegación' AND clave_delegacion <> 99 THEN value END) AS lower_sum,
            max(CASE WHEN level = 'Delegación' AND clave_delegacion = 99 THEN value END) AS upper_value,
            max(CASE WHEN level = 'Subdelegación' AND clave_delegacion = 99 THEN value END) AS upper_value_2
          FROM a GROUP BY {_LK}),
        u AS (SELECT * FROM per_del UNION ALL SELECT * FROM per_nat)
        SELECT "check", {_LK}, clave_delegacion, lower_sum, upper_value, upper_value_2,
          {_OK.format(a='lower_sum', b='upper_value')} AND {_OK.format(a='lower_sum', b='upper_value_2')} AS ok FROM u""",
    "months_in_common": f"""{O.PANEL_BASE}{HIST}{REV}
        SELECT date FROM (SELECT date FROM rev UNION ALL SELECT date FROM newm) x INTERSECT SELECT date FROM hist_ids""",
    "revision_diff": f"""{O.PANEL_BASE}{HIST}{REV},
        common AS (SELECT date FROM rev INTERSECT SELECT date FROM hist_ids),
        n AS (SELECT *, TRUE AS present FROM rev WHERE date IN (SELECT date FROM common)),
        s AS (SELECT *, TRUE AS present FROM hist_ids WHERE date IN (SELECT date FROM common)),
        j AS (SELECT {_REV_SEL}, n.value AS new_value, s.value AS stored_value, n.value - s.value AS diff,
          CASE WHEN s.present IS NULL THEN 'missing_stored'
               WHEN n.present IS NULL THEN 'missing_new'
               WHEN s.value IS NULL THEN 'stored_null'
               WHEN abs(n.value - s.value) > 1.0 THEN 'changed' END AS status
          FROM n FULL OUTER JOIN s ON {_REV_JOIN})
        SELECT {', '.join(_RK)}, new_value, stored_value, diff, status
        FROM j WHERE status IS NOT NULL""",
    "range_outliers": f"""{O.PANEL_BASE}, a AS (SELECT * FROM panel_full),
        w AS (SELECT {', '.join(OUTLIER_KEY)}, date, value,
          avg(value) OVER (PARTITION BY {', '.join(OUTLIER_KEY)} ORDER BY date ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING) AS trailing_mean,
          stddev_samp(value) OVER (PARTITION BY {', '.join(OUTLIER_KEY)} ORDER BY date ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING) AS trailing_sd
          FROM a)
        SELECT {', '.join(OUTLIER_KEY)}, date, value, {O.rv('trailing_mean')} AS trailing_mean,
          {O.rv('trailing_sd')} AS trailing_sd FROM w WHERE abs(value - trailing_mean) > 3.0 * trailing_sd""",
    "panel_stats": f"""{O.PANEL_BASE} SELECT CAST(count(*) AS BIGINT) AS n_rows, min(date) AS min_date, max(date) AS max_date,
        CAST(count(DISTINCT coalesce(series, 'NA') || ' ' || coalesce(disaggregation, 'NA')) AS BIGINT) AS n_series FROM panel_geo""",
    "panel_coverage": f"{O.PANEL_BASE} SELECT DISTINCT series, disaggregation, level FROM panel_geo",
    "panel_labels": f"{O.PANEL_BASE} SELECT DISTINCT series, disaggregation, sheet_name, book_name FROM panel_geo",
    "review_national": f"""{O.PANEL_BASE} SELECT series, disaggregation, sheet_name, date, value FROM panel_geo
        WHERE level = 'Delegación' AND delegacion = 'Nacional'""",
    "review_by_delegation": f"""{O.PANEL_BASE} SELECT series, disaggregation, sheet_name, clave_delegacion, delegacion, date,
        value FROM panel_geo WHERE level = 'Delegación' AND ({_REVIEW})""",
    "national_by_modality": f"""{O.PANEL_BASE} SELECT date, level, clave_delegacion, clave_subdelegacion, series, disaggregation,
        sheet_name, book_name, value, subdelegacion, delegacion FROM panel_geo
        WHERE series = 'Asegurados' AND disaggregation = 'Modalidad' AND clave_delegacion = 99 AND clave_subdelegacion IS NULL""",
    "employers_since": f"""{O.PANEL_BASE} SELECT date, level, clave_delegacion, clave_subdelegacion, series, disaggregation,
        sheet_name, book_name, value, subdelegacion, delegacion FROM panel_geo
        WHERE series = 'Patrones' AND level = 'Delegación' AND date >= DATE '2000-01-01'""",
}

# Code side: family rows of the cube (active registrations) without a
# dictionary match; geography side: panel codes without a name.
_FAM = """
fam AS (
  SELECT 'Asegurados' AS series, 'Modalidad' AS disaggregation, cve_modalidad AS code, asegurados AS v, CAST(NULL AS BIGINT) AS wd FROM clean WHERE ta = 1
  UNION ALL SELECT 'Asegurados', 'Sector económico', CAST(div_final AS VARCHAR), asegurados, NULL FROM clean WHERE ta = 1 AND div_final IS NOT NULL
  UNION ALL SELECT 'Patrones', 'Modalidad', mod || '.1', coalesce(patrones, 0), NULL FROM clean WHERE ta = 1
  UNION ALL SELECT 'Patrones', 'Rango de trabajadores', size_cierre, coalesce(patrones, 0), NULL FROM clean WHERE ta = 1
  UNION ALL SELECT 'Salario', 'Modalidad', cve_modalidad, NULL, CASE WHEN salario IS NOT NULL THEN asegurados END FROM clean WHERE ta = 1)"""
ORACLE["referential_check"] = f"""{O.PANEL_BASE},{_FAM}
    SELECT series, disaggregation, code, CAST(count(*) AS BIGINT) AS n_rows, CAST(sum(v) AS DOUBLE) AS lost_value,
      CAST(sum(wd) AS DOUBLE) AS lost_weight, 'code' AS "check"
    FROM fam f WHERE NOT EXISTS (SELECT 1 FROM f_dict d WHERE d.sheet_name IS NOT NULL AND d.series = f.series
      AND d.disaggregation = f.disaggregation AND d.sheet_name_code IS NOT DISTINCT FROM f.code)
    GROUP BY series, disaggregation, code
    UNION ALL
    SELECT NULL, NULL, coalesce(CAST(clave_delegacion AS VARCHAR), 'NA') || '_' || coalesce(CAST(clave_subdelegacion AS VARCHAR), 'NA'),
      CAST(count(*) AS BIGINT), {O.rv('sum(value)')}, NULL, 'geography'
    FROM panel_full p WHERE NOT EXISTS (SELECT 1 FROM (SELECT clave_delegacion, clave_subdelegacion FROM f_geo
      UNION ALL SELECT clave_delegacion, CAST(NULL AS INT) FROM f_geo) g WHERE g.clave_delegacion IS NOT DISTINCT FROM p.clave_delegacion
      AND g.clave_subdelegacion IS NOT DISTINCT FROM p.clave_subdelegacion)
    GROUP BY clave_delegacion, clave_subdelegacion"""
