"""Registered roadmap analytics (SURVEY §7.3 step 8, beyond the reference's code)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelkit.operators import analytics as A
from panelkit.registry import oracle_base as O
from panelkit.registry.common import rv, stored_panel

# Fixed value: where the months are cut into two parts.
SPLIT = "1998-06-01"
K = ", ".join(A.SERIES_KEY)
E = ", ".join(A.ENTITY_KEY)


def _input(spark: SparkSession, sf: str) -> DataFrame:
    return stored_panel(spark, sf)


def _round(df: DataFrame, cols) -> DataFrame:
    return df.withColumns({c: rv(c) for c in cols})


def q_mom_yoy_change(spark: SparkSession, sf: str) -> DataFrame:
    cols = ["value", "prev_month_value", "prev_year_value", "mom_change", "mom_pct", "yoy_change", "yoy_pct"]
    return _round(A.changes(_input(spark, sf)), cols)


def q_series_anomalies(spark: SparkSession, sf: str) -> DataFrame:
    return _round(A.anomalies(_input(spark, sf)), ["value", "mom_change", "trailing_mean", "trailing_sd"])


def q_series_summary(spark: SparkSession, sf: str) -> DataFrame:
    cols = ["last_value", "prev_value", "min_value", "max_value", "mean_value", "change", "pct_change"]
    return _round(A.summary(_input(spark, sf)), cols)


def q_seasonal_profile(spark: SparkSession, sf: str) -> DataFrame:
    return _round(A.seasonal_profile(_input(spark, sf)), ["seasonal_index"])


def q_series_correlation(spark: SparkSession, sf: str) -> DataFrame:
    return _round(A.series_correlation(_input(spark, sf)), ["correlation"])


def q_series_pair_correlation(spark: SparkSession, sf: str) -> DataFrame:
    """Moments of the years before and from 1998 on, merged."""
    p = _input(spark, sf)
    halves = [A.pair_moments(p.where(f"date {side} DATE '{SPLIT}'")) for side in ("<", ">=")]
    return _round(A.pair_correlation(A.merge_pair_moments(halves[0].unionByName(halves[1]))), ["correlation"])


QUERIES = {
    "series_pair_correlation": q_series_pair_correlation,
    "mom_yoy_change": q_mom_yoy_change,
    "series_anomalies": q_series_anomalies,
    "series_summary": q_series_summary,
    "seasonal_profile": q_seasonal_profile,
    "series_correlation": q_series_correlation,
}

INPUT = ", a AS (SELECT * FROM panel_full)"
JOIN_KEY = " AND ".join(f"p.{k} IS NOT DISTINCT FROM c.{k}" for k in A.SERIES_KEY)
CHANGES = f""",
ch AS (
  SELECT c.*, m.value AS prev_month_value, y.value AS prev_year_value
  FROM a c
  LEFT JOIN a m ON {JOIN_KEY.replace('p.', 'm.')} AND m.date = CAST(c.date - INTERVAL 1 MONTH AS DATE)
  LEFT JOIN a y ON {JOIN_KEY.replace('p.', 'y.')} AND y.date = CAST(c.date - INTERVAL 12 MONTH AS DATE)),
ch2 AS (
  SELECT {K}, date, value, prev_month_value, prev_year_value,
    value - prev_month_value AS mom_change, (value - prev_month_value) / NULLIF(prev_month_value, 0) * 100.0 AS mom_pct,
    value - prev_year_value AS yoy_change, (value - prev_year_value) / NULLIF(prev_year_value, 0) * 100.0 AS yoy_pct
  FROM ch)"""


def _r(*cols: str) -> str:
    return ", ".join(f"{O.rv(c)} AS {c}" for c in cols)


ORACLE = {
    "series_pair_correlation": f"""{O.PANEL_BASE}{INPUT},
        c AS (SELECT {E}, date, series, disaggregation, sheet_name, sum(value) AS v FROM a WHERE value IS NOT NULL
          GROUP BY {E}, date, series, disaggregation, sheet_name),
        g AS (SELECT x.level, x.clave_delegacion, x.clave_subdelegacion, x.series AS series_a, x.disaggregation AS disaggregation_a,
            x.sheet_name AS sheet_name_a, y.series AS series_b, y.disaggregation AS disaggregation_b, y.sheet_name AS sheet_name_b,
            CAST(count(*) AS BIGINT) AS n_months, corr(x.v, y.v) AS r, stddev_pop(x.v) AS sd_x, stddev_pop(y.v) AS sd_y
          FROM c x JOIN c y ON x.level = y.level AND x.clave_delegacion IS NOT DISTINCT FROM y.clave_delegacion
            AND x.clave_subdelegacion IS NOT DISTINCT FROM y.clave_subdelegacion AND x.date = y.date
            AND (x.series, x.disaggregation, x.sheet_name) < (y.series, y.disaggregation, y.sheet_name)
          GROUP BY ALL)
        SELECT * EXCLUDE (r, sd_x, sd_y), {O.rv('CASE WHEN n_months >= 3 AND sd_x > 0 AND sd_y > 0 THEN r END')} AS correlation FROM g""",
    "mom_yoy_change": f"""{O.PANEL_BASE}{INPUT}{CHANGES}
        SELECT {K}, date, {_r('value', 'prev_month_value', 'prev_year_value', 'mom_change', 'mom_pct', 'yoy_change', 'yoy_pct')} FROM ch2""",
    "series_anomalies": f"""{O.PANEL_BASE}{INPUT}{CHANGES},
        w AS (SELECT {K}, date, value, mom_change,
          avg(mom_change) OVER (PARTITION BY {K} ORDER BY date ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING) AS trailing_mean,
          stddev_samp(mom_change) OVER (PARTITION BY {K} ORDER BY date ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING) AS trailing_sd
          FROM ch2 WHERE mom_change IS NOT NULL)
        SELECT {K}, date, {_r('value', 'mom_change', 'trailing_mean', 'trailing_sd')} FROM w
        WHERE abs(mom_change - trailing_mean) > 3.0 * trailing_sd""",
    "series_summary": f"""{O.PANEL_BASE}{INPUT},
        s AS (SELECT {K}, CAST(count(*) AS BIGINT) AS n_months, min(date) AS first_date, max(date) AS last_date,
                min(value) AS min_value, max(value) AS max_value, avg(value) AS mean_value FROM a GROUP BY {K}),
        j AS (SELECT s.*, l.value AS last_value, pv.value AS prev_value FROM s
          LEFT JOIN a l ON {JOIN_KEY.replace('p.', 'l.').replace('c.', 's.')} AND l.date = s.last_date
          LEFT JOIN a pv ON {JOIN_KEY.replace('p.', 'pv.').replace('c.', 's.')} AND pv.date = CAST(s.last_date - INTERVAL 1 MONTH AS DATE))
        SELECT {K}, n_months, first_date, last_date, {_r('last_value', 'prev_value', 'min_value', 'max_value', 'mean_value')},
          {O.rv('last_value - prev_value')} AS change, {O.rv('(last_value - prev_value) / NULLIF(prev_value, 0) * 100.0')} AS pct_change
        FROM j""",
    "seasonal_profile": f"""{O.PANEL_BASE}{INPUT},
        r AS (SELECT {K}, month(date) AS month,
          value / NULLIF(avg(value) OVER (PARTITION BY {K}, year(date)), 0) AS ratio FROM a)
        SELECT {K}, CAST(month AS INT) AS month, {O.rv('avg(ratio)')} AS seasonal_index, CAST(count(ratio) AS BIGINT) AS n_years
        FROM r GROUP BY {K}, month""",
    "series_correlation": f"""{O.PANEL_BASE}{INPUT},
        ref AS (SELECT {E}, date, sum(value) AS reference_value FROM a
          WHERE series = 'Asegurados' AND disaggregation = 'Modalidad' GROUP BY {E}, date),
        p AS (SELECT a.*, ref.reference_value FROM a JOIN ref ON a.level = ref.level
          AND a.clave_delegacion IS NOT DISTINCT FROM ref.clave_delegacion
          AND a.clave_subdelegacion IS NOT DISTINCT FROM ref.clave_subdelegacion AND a.date = ref.date),
        g AS (SELECT {K}, CAST(count(*) AS BIGINT) AS n_months, corr(value, reference_value) AS c,
          stddev_pop(value) AS sd_v, stddev_pop(reference_value) AS sd_r FROM p GROUP BY {K})
        SELECT {K}, n_months, {O.rv('CASE WHEN n_months >= 3 AND sd_v > 0 AND sd_r > 0 THEN c END')} AS correlation FROM g""",
}
