"""Historical rebuild: landed workbooks → long panel with ids and names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.operators import books as B
from panelkit.operators.panel import with_geo
from panelkit.session import cut_lineage

SHEET = ["path", "position"]
ENTITY = ["clave_delegacion", "clave_subdelegacion"]


def indexed_sheets(catalogue: DataFrame, index: DataFrame, tabs: DataFrame, check: bool = True) -> DataFrame:
    """Classified books ⋈ their index and tabs, with book and sheet ids."""
    books = B.classify_catalogue(catalogue)
    joined = B.join_index(B.extract_index(index), B.sheet_positions(tabs)).join(books.select("path"), "path", "left_semi")
    if check:
        B.require_no_conflicts(B.index_conflicts(joined))
    sheets = B.assign_sheet_ids(books, joined)
    return sheets.join(books.drop("book_id"), "path")


def repaired_long(wide: DataFrame) -> DataFrame:
    """Unpivot every sheet, repair undecodable months, drop empty cells.

    ``wide`` is one table over a common month grid, or landed rows with a
    ``cells`` column, each book with its own columns.  The cells are
    checkpointed: the repair reads them for its report and for the rows.
    """
    long = B.unpivot_rows(wide, drop_missing=False) if "cells" in wide.columns else B.unpivot_sheets(wide, SHEET, drop_missing=False)
    return B.drop_incomplete(B.repair_dates(cut_lineage(long), SHEET))


def historical_panel(
    catalogue: DataFrame, index: DataFrame, tabs: DataFrame, wide: DataFrame, geo: DataFrame, check: bool = True
) -> DataFrame:
    sheets = indexed_sheets(catalogue, index, tabs, check).select(
        "path", "position", "book_id", "sheet_id",
        F.col("name").alias("book_name"), F.col("contenido").alias("sheet_name"),
        "level", "series", "disaggregation",
    )
    labelled = B.clean_labels(sheets)
    data = repaired_long(wide).select("path", "position", *ENTITY, "date", "value")
    long = data.join(labelled, SHEET).drop(*SHEET)
    long = B.split_codes(long)
    out = with_geo(long, geo)
    return out.select(
        "book_id", "sheet_id", "book_name", "sheet_name", "level", "date", "clave_delegacion",
        "clave_subdelegacion", "delegacion", "subdelegacion", "series", "disaggregation", "value",
    )
