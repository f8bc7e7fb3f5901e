"""Registered queries of the store and update step."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.operators.continuity import continuity_report, month_gaps
from panelkit.operators.ids import assign_series_ids, label_ids
from panelkit.plans.monthly import replace_month, update_store
from panelkit.registry import oracle_base as O
from panelkit.registry.common import panel, panel_geo
from panelkit.schema import EXPLORER_COLUMNS, LEVEL_SUBDELEGATION, PANEL_COLUMNS
from panelkit.session import cut_lineage, scratch_path
from panelkit.plans.explorer import pruned_slice
from panelkit.sources.entity_store import entity_slice, refresh_entities
from panelkit.sources.store import backup_store, compact_store, display_order, preview, read_panel, reset_panel

# The slice used by the pruning scan.
SLICE = {"series": "Asegurados", "disaggregation": "Modalidad", "sheet_name": "Modalidad 10.1"}
NEW_SHEET, DROPPED_SHEET = "Modalidad nueva", "Modalidad 14"
# The entity sliced over all series, and the rows of a preview.
ENTITY = (LEVEL_SUBDELEGATION, 2, 7)
PREVIEW_ROWS = 25


def _max_date(df: DataFrame):
    return df.agg(F.max("date")).first()[0]


def split_history(spark: SparkSession, sf: str):
    """F-HIST (all but the last month), F-NEW (last month), F-GAP (F-HIST
    without its last month).  The cut-off months are scalars."""
    # Checkpointed once: the three splits and the scalars reuse it.
    p = cut_lineage(panel_geo(spark, sf))
    # The two latest months in one small job (top-2 of the distinct months).
    last, last_hist = [r[0] for r in p.select("date").distinct().orderBy(F.desc("date")).limit(2).collect()]
    hist = p.where(F.col("date") < F.lit(last))
    new = p.where(F.col("date") == F.lit(last))
    gap = hist.where(F.col("date") < F.lit(last_hist))
    return hist, new, gap


def hist_with_ids(spark: SparkSession, sf: str):
    hist, new, gap = split_history(spark, sf)
    ids = cut_lineage(label_ids(hist))
    return cut_lineage(assign_series_ids(hist, ids)), ids, new, gap


def _fresh_store(spark: SparkSession, df: DataFrame) -> str:
    path = scratch_path(spark, "panel-store")
    reset_panel(df, path)
    return path


def q_assign_series_ids(spark: SparkSession, sf: str) -> DataFrame:
    _, ids, new, _ = hist_with_ids(spark, sf)
    return assign_series_ids(new, ids)


def q_month_continuity(spark: SparkSession, sf: str) -> DataFrame:
    hist, new, gap = split_history(spark, sf)
    return (
        continuity_report(hist, new, "next")
        .unionByName(continuity_report(hist.unionByName(new), new, "repeat"))
        .unionByName(continuity_report(gap, new, "gap"))
    )


def q_month_gaps(spark: SparkSession, sf: str) -> DataFrame:
    return month_gaps(panel(spark, sf))


def q_panel_write_read(spark: SparkSession, sf: str) -> DataFrame:
    h, _, _, _ = hist_with_ids(spark, sf)
    return read_panel(spark, _fresh_store(spark, h))


def q_panel_update(spark: SparkSession, sf: str) -> DataFrame:
    h, _, new, _ = hist_with_ids(spark, sf)
    path = _fresh_store(spark, h)
    return update_store(spark, path, new)


def q_partition_prune_scan(spark: SparkSession, sf: str) -> DataFrame:
    h, _, _, _ = hist_with_ids(spark, sf)
    path = _fresh_store(spark, h)
    return pruned_slice(spark, path, **SLICE)


def q_panel_reset(spark: SparkSession, sf: str) -> DataFrame:
    h, ids, new, gap = hist_with_ids(spark, sf)
    path = _fresh_store(spark, h)
    update_store(spark, path, new)
    reset_panel(assign_series_ids(gap, ids), path)
    return read_panel(spark, path)


def q_monthly_stream_update(spark: SparkSession, sf: str) -> DataFrame:
    """The last month's register lands in a drop folder; the streaming job
    appends its panel to a store holding the history."""
    from panelkit.sources.register import code_dictionary, geo_dictionary, micro_register
    from panelkit.streaming.monthly_drop import run_monthly_drop

    h, _, new, _ = hist_with_ids(spark, sf)
    last = _max_date(new)
    store = _fresh_store(spark, h)
    drop = scratch_path(spark, "register-drop")
    micro_register(spark, sf).where(F.col("date") == F.lit(last)).write.parquet(drop)
    run_monthly_drop(spark, drop, store, code_dictionary(spark), geo_dictionary(spark, sf))
    return read_panel(spark, store)


def with_new_series(new: DataFrame) -> DataFrame:
    """The month with one more sheet than the history knows: copies of a family's rows under a new name."""
    family = (F.col("series") == SLICE["series"]) & (F.col("disaggregation") == SLICE["disaggregation"])
    copy = new.where(family).withColumn("sheet_name", F.lit(NEW_SHEET))
    return new.unionByName(copy)


def q_panel_update_new_series(spark: SparkSession, sf: str) -> DataFrame:
    h, _, new, _ = hist_with_ids(spark, sf)
    path = _fresh_store(spark, h)
    return update_store(spark, path, with_new_series(new))


def q_pruned_slice_new_series(spark: SparkSession, sf: str) -> DataFrame:
    h, _, new, _ = hist_with_ids(spark, sf)
    path = _fresh_store(spark, h)
    update_store(spark, path, with_new_series(new))
    return pruned_slice(spark, path, **(SLICE | {"sheet_name": NEW_SHEET}))


def q_panel_replace_month(spark: SparkSession, sf: str) -> DataFrame:
    """The stored last month is published again, revised and without one series."""
    h, _, new, _ = hist_with_ids(spark, sf)
    path = _fresh_store(spark, h)
    update_store(spark, path, new)
    revised = new.where(F.col("sheet_name") != DROPPED_SHEET).withColumn("value", F.col("value") + 1)
    replace_month(spark, path, revised)
    compact_store(spark, path)
    return read_panel(spark, path)


def q_panel_replace_month_new_series(spark: SparkSession, sf: str) -> DataFrame:
    """The stored last month is published again with a series the store did not know, then once more, revised."""
    h, _, new, _ = hist_with_ids(spark, sf)
    path = _fresh_store(spark, h)
    update_store(spark, path, new)
    replace_month(spark, path, with_new_series(new))
    replace_month(spark, path, with_new_series(new).withColumn("value", F.col("value") + 1))
    return read_panel(spark, path)


def q_entity_slice(spark: SparkSession, sf: str) -> DataFrame:
    """One entity over all series: its history from the entity-first copy, the month appended since from the store."""
    h, _, new, _ = hist_with_ids(spark, sf)
    path = _fresh_store(spark, h)
    refresh_entities(spark, path)
    update_store(spark, path, new)
    return entity_slice(spark, path, *ENTITY)


def q_store_backup(spark: SparkSession, sf: str) -> DataFrame:
    """A backup taken before the store is replaced by less; the rows of the backup."""
    h, ids, _, gap = hist_with_ids(spark, sf)
    path, dest = _fresh_store(spark, h), scratch_path(spark, "panel-backup")
    backup_store(spark, path, dest)
    reset_panel(assign_series_ids(gap, ids), path)
    return read_panel(spark, dest)


def q_store_preview(spark: SparkSession, sf: str) -> DataFrame:
    """The first rows of the stored panel in display order (the limit is the feature)."""
    h, _, _, _ = hist_with_ids(spark, sf)
    order = ["book_id", "sheet_id", "disaggregation", "date", "clave_delegacion", "clave_subdelegacion"]
    return preview(display_order(read_panel(spark, _fresh_store(spark, h)), order), PREVIEW_ROWS)


QUERIES = {
    "entity_slice": q_entity_slice,
    "store_backup": q_store_backup,
    "store_preview": q_store_preview,
    "panel_update_new_series": q_panel_update_new_series,
    "pruned_slice_new_series": q_pruned_slice_new_series,
    "panel_replace_month": q_panel_replace_month,
    "panel_replace_month_new_series": q_panel_replace_month_new_series,
    "monthly_stream_update": q_monthly_stream_update,
    "assign_series_ids": q_assign_series_ids,
    "month_continuity": q_month_continuity,
    "month_gaps": q_month_gaps,
    "panel_write_read": q_panel_write_read,
    "panel_update": q_panel_update,
    "partition_prune_scan": q_partition_prune_scan,
    "panel_reset": q_panel_reset,
}

HIST = """,
hist AS (SELECT * FROM panel_geo WHERE date < (SELECT max(date) FROM panel_geo)),
newm AS (SELECT * FROM panel_geo WHERE date = (SELECT max(date) FROM panel_geo)),
gap AS (SELECT * FROM hist WHERE date < (SELECT max(date) FROM hist)),
ids AS (
  SELECT CAST(dense_rank() OVER (ORDER BY level, book_name) AS INT) AS book_id,
         CAST(dense_rank() OVER (ORDER BY level, book_name, sheet_name) AS INT) AS sheet_id, level, book_name, sheet_name
  FROM (SELECT DISTINCT level, book_name, sheet_name FROM hist) l),
hist_ids AS (
  SELECT h.*, i.book_id, i.sheet_id FROM hist h LEFT JOIN ids i
  ON h.sheet_name IS NOT DISTINCT FROM i.sheet_name AND h.book_name IS NOT DISTINCT FROM i.book_name AND h.level IS NOT DISTINCT FROM i.level),
new_ids AS (
  SELECT n.*, i.book_id, i.sheet_id FROM newm n LEFT JOIN ids i
  ON n.sheet_name IS NOT DISTINCT FROM i.sheet_name AND n.book_name IS NOT DISTINCT FROM i.book_name AND n.level IS NOT DISTINCT FROM i.level),
gap_ids AS (
  SELECT g.*, i.book_id, i.sheet_id FROM gap g LEFT JOIN ids i
  ON g.sheet_name IS NOT DISTINCT FROM i.sheet_name AND g.book_name IS NOT DISTINCT FROM i.book_name AND g.level IS NOT DISTINCT FROM i.level)"""

# The month with one more sheet; its labels get the next free numbers in sorted order.
NEW_SERIES = HIST + """,
new2 AS (SELECT * FROM newm UNION ALL SELECT * REPLACE ('Modalidad nueva' AS sheet_name) FROM newm
  WHERE series = 'Asegurados' AND disaggregation = 'Modalidad'),
fresh AS (SELECT DISTINCT level, book_name, sheet_name FROM new2 WHERE sheet_name = 'Modalidad nueva'),
ids2 AS (
  SELECT book_id, sheet_id, level, book_name, sheet_name FROM ids
  UNION ALL
  SELECT b.book_id, CAST((SELECT max(sheet_id) FROM ids) + row_number() OVER (ORDER BY f.level, f.book_name, f.sheet_name) AS INT),
         f.level, f.book_name, f.sheet_name
  FROM fresh f JOIN (SELECT DISTINCT book_id, level, book_name FROM ids) b ON b.level = f.level AND b.book_name = f.book_name),
new2_ids AS (
  SELECT n.*, i.book_id, i.sheet_id FROM new2 n LEFT JOIN ids2 i
  ON n.sheet_name IS NOT DISTINCT FROM i.sheet_name AND n.book_name IS NOT DISTINCT FROM i.book_name AND n.level IS NOT DISTINCT FROM i.level)"""

_COLS = ", ".join(c for c in PANEL_COLUMNS if c != "value")
_XCOLS = ", ".join(c for c in EXPLORER_COLUMNS if c != "value")


def _report(stored: str, new: str, name: str) -> str:
    return f"""SELECT '{name}' AS candidate, s.last_stored, n.new_min, n.new_max, n.n_new_months,
  CAST(s.last_stored + INTERVAL 1 MONTH AS DATE) AS expected_month,
  coalesce(n.n_new_months = 1 AND n.new_min = CAST(s.last_stored + INTERVAL 1 MONTH AS DATE), false) AS accepted
FROM (SELECT max(date) AS last_stored FROM {stored}) s,
     (SELECT min(date) AS new_min, max(date) AS new_max, CAST(count(DISTINCT date) AS BIGINT) AS n_new_months FROM {new}) n"""


_GKEY = "level, series, disaggregation, sheet_name, book_name, clave_delegacion, clave_subdelegacion"

ORACLE = {
    "entity_slice": f"""{O.PANEL_BASE} SELECT {_XCOLS}, value FROM panel_geo
        WHERE level = 'Subdelegación' AND clave_delegacion = 2 AND clave_subdelegacion = 7""",
    "store_backup": f"{O.PANEL_BASE}{HIST} SELECT {_COLS}, value FROM hist_ids",
    "store_preview": f"""{O.PANEL_BASE}{HIST} SELECT {_COLS}, value FROM hist_ids ORDER BY book_id NULLS LAST, sheet_id NULLS LAST,
        disaggregation NULLS LAST, date NULLS LAST, clave_delegacion NULLS LAST, clave_subdelegacion NULLS LAST LIMIT 25""",
    "panel_update_new_series": f"""{O.PANEL_BASE}{NEW_SERIES} SELECT {_COLS}, value FROM
        (SELECT {_COLS}, value FROM hist_ids UNION ALL SELECT {_COLS}, value FROM new2_ids) u""",
    "panel_replace_month_new_series": f"""{O.PANEL_BASE}{NEW_SERIES} SELECT {_COLS}, value FROM
        (SELECT {_COLS}, value FROM hist_ids UNION ALL SELECT {_COLS}, value + 1 AS value FROM new2_ids) u""",
    "pruned_slice_new_series": f"""{O.PANEL_BASE}{NEW_SERIES} SELECT {_XCOLS}, value FROM new2_ids
        WHERE series = 'Asegurados' AND disaggregation = 'Modalidad' AND sheet_name = 'Modalidad nueva'""",
    "panel_replace_month": f"""{O.PANEL_BASE}{HIST} SELECT {_COLS}, value FROM
        (SELECT {_COLS}, value FROM hist_ids UNION ALL
         SELECT {_COLS}, value + 1 AS value FROM new_ids WHERE sheet_name <> 'Modalidad 14') u""",
    "monthly_stream_update": f"""{O.PANEL_BASE}{HIST} SELECT {_COLS}, value FROM
        (SELECT {_COLS}, value FROM hist_ids UNION ALL SELECT {_COLS}, value FROM new_ids) u""",
    "assign_series_ids": f"{O.PANEL_BASE}{HIST} SELECT {_COLS}, value FROM new_ids",
    "month_continuity": f"""{O.PANEL_BASE}{HIST}
        {_report('hist', 'newm', 'next')} UNION ALL
        {_report('(SELECT date FROM hist UNION ALL SELECT date FROM newm)', 'newm', 'repeat')} UNION ALL
        {_report('gap', 'newm', 'gap')}""",
    "month_gaps": f"""{O.PANEL_BASE} SELECT {_GKEY}, date, next_date, CAST(date_diff('month', date, next_date) - 1 AS INT) AS missing_months
        FROM (SELECT {_GKEY}, date, lead(date) OVER (PARTITION BY {_GKEY} ORDER BY date) AS next_date FROM panel_full) t
        WHERE next_date IS NOT NULL AND next_date <> CAST(date + INTERVAL 1 MONTH AS DATE)""",
    "panel_write_read": f"{O.PANEL_BASE}{HIST} SELECT {_COLS}, value FROM hist_ids",
    "panel_update": f"""{O.PANEL_BASE}{HIST} SELECT {_COLS}, value FROM
        (SELECT {_COLS}, value FROM hist_ids UNION ALL SELECT {_COLS}, value FROM new_ids) u""",
    "partition_prune_scan": f"""{O.PANEL_BASE}{HIST} SELECT {_XCOLS}, value FROM hist_ids
        WHERE series = 'Asegurados' AND disaggregation = 'Modalidad' AND sheet_name = 'Modalidad 10.1'""",
    "panel_reset": f"{O.PANEL_BASE}{HIST} SELECT {_COLS}, value FROM gap_ids",
}
