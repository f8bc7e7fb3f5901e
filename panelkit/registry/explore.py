"""Registered explorer queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.functions.labels import member_key
from panelkit.operators import explore as X
from panelkit.registry import oracle_base as O
from panelkit.registry.common import stored_labels, stored_panel
from panelkit.schema import LEVEL_DELEGATION, LEVEL_SUBDELEGATION
from panelkit.session import scratch_path
from panelkit.sources.register import geo_dictionary

# The default explorer slice of the fixtures.
SLICE_SERIES, SLICE_DIS, SLICE_SHEET = "Asegurados", "Modalidad", "Modalidad 10.1"
SLICE_START, SLICE_END = dt.date(1995, 1, 1), dt.date(1996, 12, 1)
SLICE_MONTHS = [dt.date(1995 + i // 12, i % 12 + 1, 1) for i in range(24)]
LEVELS = (LEVEL_DELEGATION, LEVEL_SUBDELEGATION)


def q_list_series(spark: SparkSession, sf: str) -> DataFrame:
    return X.list_series(stored_labels(spark, sf))


def q_list_levels(spark: SparkSession, sf: str) -> DataFrame:
    return X.list_levels(stored_labels(spark, sf))


def q_list_members(spark: SparkSession, sf: str) -> DataFrame:
    return X.list_members(stored_panel(spark, sf))


def q_list_concepts(spark: SparkSession, sf: str) -> DataFrame:
    return X.list_concepts(stored_labels(spark, sf))


def q_list_sheets(spark: SparkSession, sf: str) -> DataFrame:
    return X.list_sheets(stored_labels(spark, sf))


def q_date_bounds(spark: SparkSession, sf: str) -> DataFrame:
    return X.date_bounds(stored_labels(spark, sf))


def key_texts(panel: DataFrame) -> DataFrame:
    """Member keys as the explorer sends them, plus bare delegation codes.
    Both come from one distinct (del, subdel) set, so the panel is
    aggregated once."""
    pairs = panel.select("clave_delegacion", "clave_subdelegacion").distinct()
    full = pairs.select(member_key().alias("member_key"))
    bare = pairs.select(F.col("clave_delegacion").cast("string").alias("member_key")).distinct()
    return full.unionByName(bare)


def q_parse_member_keys(spark: SparkSession, sf: str) -> DataFrame:
    return X.parse_member_keys(key_texts(stored_panel(spark, sf)))


def member_keys(spark: SparkSession, sf: str, level: str) -> DataFrame:
    """Every member of a level as the explorer lists it, from the geography
    dimension: delegations (with the national code) at delegation level,
    subdelegations (with the national pair) at subdelegation level."""
    geo = geo_dictionary(spark, sf)
    if level == LEVEL_DELEGATION:
        return geo.select(member_key("clave_delegacion", F.lit(None).cast("int")).alias("member_key")).distinct()
    return geo.where(F.col("clave_subdelegacion").isNotNull()).select(member_key().alias("member_key"))


def slices(spark: SparkSession, sf: str) -> DataFrame:
    """Default slice at both levels in one pass; every member selected."""
    p = stored_panel(spark, sf)
    keys = member_keys(spark, sf, LEVELS[0]).withColumn("level", F.lit(LEVELS[0]))
    for lv in LEVELS[1:]:
        keys = keys.unionByName(member_keys(spark, sf, lv).withColumn("level", F.lit(lv)))
    return X.series_slice(p, SLICE_SERIES, LEVELS, SLICE_DIS, SLICE_SHEET, keys, SLICE_START, SLICE_END)


def q_series_slice(spark: SparkSession, sf: str) -> DataFrame:
    return slices(spark, sf)


def q_series_slice_total(spark: SparkSession, sf: str) -> DataFrame:
    return X.slice_total(slices(spark, sf), by=("level",))


def q_series_wide(spark: SparkSession, sf: str) -> DataFrame:
    wide = X.to_wide(slices(spark, sf), SLICE_MONTHS, ids=("level", *X.MEMBER_COLUMNS, "grupo"), series=SLICE_SERIES)
    return wide


def q_export_csv(spark: SparkSession, sf: str) -> DataFrame:
    s = slices(spark, sf)
    path = scratch_path(spark, X.export_name(SLICE_SERIES, SLICE_END))
    X.export_csv(s, path)
    return spark.read.schema(s.schema).option("header", True).option("nullValue", "").csv(path)


QUERIES = {
    "list_series": q_list_series,
    "list_levels": q_list_levels,
    "list_members": q_list_members,
    "list_concepts": q_list_concepts,
    "list_sheets": q_list_sheets,
    "date_bounds": q_date_bounds,
    "parse_member_keys": q_parse_member_keys,
    "series_slice": q_series_slice,
    "series_slice_total": q_series_slice_total,
    "series_wide": q_series_wide,
    "export_csv": q_export_csv,
}

_LABEL = """CASE WHEN {s} IS NOT NULL AND {s} <> '' THEN
  coalesce(printf('%02d', {d}), 'NA') || '-' || coalesce(printf('%03d', {c}), 'NA') || ' | ' || coalesce({dn}, 'NA') || ' - ' || {s}
  ELSE coalesce(printf('%02d', {d}), 'NA') || ' | ' || coalesce({dn}, 'NA') END"""
LABEL = _LABEL.format(s="subdelegacion", d="clave_delegacion", c="clave_subdelegacion", dn="delegacion")
KEY = "coalesce(CAST(clave_delegacion AS VARCHAR), 'NA') || '_' || coalesce(CAST(clave_subdelegacion AS VARCHAR), 'NA')"
PARSE = """SELECT member_key, TRY_CAST(nullif(split_part(member_key, '_', 1), '') AS INT) AS clave_delegacion,
  TRY_CAST(nullif(split_part(member_key, '_', 2), '') AS INT) AS clave_subdelegacion FROM {src}"""

SLICE_CTE = f""",
members AS (
  SELECT DISTINCT 'Delegación' AS level, CAST(clave_delegacion AS VARCHAR) || '_NA' AS member_key FROM f_geo
  UNION ALL SELECT 'Subdelegación', {KEY} FROM f_geo WHERE clave_subdelegacion IS NOT NULL),
mkeys AS (SELECT level, k.* FROM members, LATERAL ({PARSE.format(src='(SELECT members.member_key)')}) k),
sl AS (
  SELECT p.level, p.clave_delegacion, p.delegacion, p.clave_subdelegacion, p.subdelegacion, p.date, p.value,
    {_LABEL.format(s='p.subdelegacion', d='p.clave_delegacion', c='p.clave_subdelegacion', dn='p.delegacion')} AS grupo
  FROM panel_geo p
  WHERE p.series = 'Asegurados' AND p.disaggregation = 'Modalidad' AND p.sheet_name = 'Modalidad 10.1'
    AND p.level IN ('Delegación', 'Subdelegación') AND p.date BETWEEN DATE '1995-01-01' AND DATE '1996-12-01'
    AND EXISTS (SELECT 1 FROM mkeys k WHERE k.level = p.level AND k.clave_delegacion IS NOT DISTINCT FROM p.clave_delegacion
                AND k.clave_subdelegacion IS NOT DISTINCT FROM p.clave_subdelegacion))"""

_WIDE_COLS = ", ".join(
    f"max(CASE WHEN date = DATE '{m.isoformat()}' THEN value END) AS {X.month_column(m)}" for m in SLICE_MONTHS
)

ORACLE = {
    "list_series": f"{O.PANEL_BASE} SELECT DISTINCT series FROM panel_geo",
    "list_levels": f"{O.PANEL_BASE} SELECT DISTINCT series, level FROM panel_geo",
    "list_members": f"""{O.PANEL_BASE} SELECT series, level, clave_delegacion, delegacion, clave_subdelegacion, subdelegacion,
        {LABEL} AS label, {KEY} AS member_key
        FROM (SELECT DISTINCT series, level, clave_delegacion, delegacion, clave_subdelegacion, subdelegacion FROM panel_geo) m""",
    "list_concepts": f"{O.PANEL_BASE} SELECT DISTINCT series, level, disaggregation FROM panel_geo",
    "list_sheets": f"{O.PANEL_BASE} SELECT DISTINCT series, level, disaggregation, sheet_name FROM panel_geo",
    "date_bounds": f"""{O.PANEL_BASE} SELECT series, level, disaggregation, sheet_name, min(date) AS min_date, max(date) AS max_date
        FROM panel_geo GROUP BY series, level, disaggregation, sheet_name""",
    "parse_member_keys": f"""{O.PANEL_BASE}, keys AS (
        SELECT DISTINCT {KEY} AS member_key FROM panel_geo
        UNION ALL SELECT DISTINCT CAST(clave_delegacion AS VARCHAR) FROM panel_geo)
        {PARSE.format(src='keys')}""",
    "series_slice": f"{O.PANEL_BASE}{SLICE_CTE} SELECT * FROM sl",
    "series_slice_total": f"""{O.PANEL_BASE}{SLICE_CTE} SELECT level, date, coalesce(sum(value), 0) AS value,
        'Total seleccionado' AS grupo FROM sl GROUP BY level, date""",
    "series_wide": f"""{O.PANEL_BASE}{SLICE_CTE} SELECT level, clave_delegacion, delegacion, clave_subdelegacion, subdelegacion, grupo,
        {_WIDE_COLS} FROM sl GROUP BY level, clave_delegacion, delegacion, clave_subdelegacion, subdelegacion, grupo""",
    "export_csv": f"{O.PANEL_BASE}{SLICE_CTE} SELECT * FROM sl",
}
