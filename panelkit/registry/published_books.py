"""The books fixture of the registered queries: landed historical workbooks, published from a panel.

The historical books are the official wide sheets of the same series.  They
are derived here from a panel (so their size follows the data): one
workbook per (level, series, disaggregation) with a table of contents, the
sheet tabs and one wide sheet per panel sheet — entities in rows, months in
columns named by spreadsheet serial day.  All sheets land in one wide table
(``path``, ``position`` identify the sheet) over the panel's month grid; a
sheet with no value for an entity and month has an empty cell.

Defects are planted the way such books have them: a month header that
holds a digit but is not a number, padded index text, summary and empty
index rows, non-data tabs, and unrelated files in the same folders.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from panelkit.operators.panel import one_value
from panelkit.schema import SERIES_WAGE
from panelkit.session import literal_table

# Published workbook titles per (series, disaggregation).
BOOK_TITLES = [
    ("Asegurados", "Modalidad", "Asegurados Trabajadores por Modalidad"),
    ("Asegurados", "Sector económico", "Asegurados Trabajadores por Sector"),
    ("Patrones", "Modalidad", "Patrones por Modalidad"),
    ("Patrones", "Rango de trabajadores", "Patrones por  Rango"),
    ("Salario", "Modalidad", "Salario Trabajadores por Modalidad"),
]
# Series folders and level folders / file-name suffixes.
SERIES_FOLDERS = [("Asegurados", "ASEGURADOS TRABAJADORES"), ("Patrones", "PATRONES"), ("Salario", "SALARIO")]
LEVEL_FOLDERS = [("Delegación", "DELEGACIONES", "Delegaciones"), ("Subdelegación", "SUBDELEGACIONES", "Subdelegaciones")]
# Other files found in the same folders.
EXTRA_BOOKS = [
    "/raw/DELEGACIONES/ASEGURADOS TRABAJADORES/Asegurados Trabajadores por Modalidad_Delegaciones.xlsx",
    "/raw/SUBDELEGACIONES/ASEGURADOS TRABAJADORES/Asegurados Trabajadores por Sector_Subdelegaciones.xlsx",
    "/raw/SUBDELEGACIONES/PATRONES/Patrones por  Rango.xlsx",
    "/raw/DELEGACIONES/PATRONES/Patrones por Modalidad.xlsx",
    "/raw/DELEGACIONES/SALARIO/Salario por rango salarial.xlsx",
    "/raw/DELEGACIONES/SALARIO/Salario Trabajadores.xlsx",
    "/raw/DELEGACIONES/ASEGURADOS TRABAJADORES/Masa salarial.xlsx",
    "/raw/DELEGACIONES/POBLACIONES/Población adscrita.xlsx",
]
# The planted bad month header and which grid month carries it.
BAD_HEADER, BAD_HEADER_INDEX = "9x", 4
# Published id column headers.
H_DEL, H_DEL_NAME, H_SUB, H_SUB_NAME = "Clave del", "Delegación", "Clave subdelegación", "Subdelegación"
NATIONAL_TITLE = "TOTAL NACIONAL"
EXCEL_EPOCH = dt.date(1899, 12, 30)


def _map(pairs):
    return F.create_map(*[F.lit(x) for kv in pairs for x in kv])


def book_path() -> F.Column:
    title = _map([((s + "|" + d), t) for s, d, t in BOOK_TITLES])[F.concat_ws("|", "series", "disaggregation")]
    folder = _map(SERIES_FOLDERS)[F.col("series")]
    lvl_dir = _map([(lv, d) for lv, d, _ in LEVEL_FOLDERS])[F.col("level")]
    lvl_suffix = _map([(lv, s) for lv, _, s in LEVEL_FOLDERS])[F.col("level")]
    return F.concat(F.lit("/raw/"), lvl_dir, F.lit("/"), folder, F.lit("/"), title, F.lit("_"), lvl_suffix, F.lit(".xlsx"))


def published_sheets(panel: DataFrame) -> DataFrame:
    """One row per published sheet: workbook path and its index number."""
    labels = panel.select("level", "series", "disaggregation", "sheet_name").distinct()
    labels = labels.withColumn("path", book_path())
    hoja = F.dense_rank().over(Window.partitionBy("path").orderBy("sheet_name"))
    labels = labels.withColumn("hoja", hoja.cast("int"))
    # The book's sheet count from the same path partition (no extra shuffle).
    return labels.withColumn("n_sheets", F.max("hoja").over(Window.partitionBy("path")))


def _books(sheets: DataFrame) -> DataFrame:
    """One row per workbook: its last sheet (sheet names are distinct)."""
    return sheets.where(F.col("hoja") == F.col("n_sheets")).select("path", F.col("n_sheets").alias("n"))


def book_catalogue(spark: SparkSession, sheets: DataFrame) -> DataFrame:
    extra = literal_table(spark, [(p,) for p in EXTRA_BOOKS], StructType([StructField("path", StringType())]))
    return _books(sheets).select("path").unionByName(extra).distinct()


def book_index(sheets: DataFrame) -> DataFrame:
    """Rows of each workbook's table of contents (raw text cells)."""
    entries = sheets.select(
        "path",
        F.concat(F.lit(" Hoja "), F.col("hoja").cast("string")).alias("hoja"),
        F.concat(F.lit("  "), F.regexp_replace("sheet_name", " ", "  "), F.lit(" ")).alias("contenido"),
    )
    books = _books(sheets)
    summary = books.select("path", F.concat(F.lit("Hoja "), (F.col("n") + 1).cast("string")).alias("hoja"),
                           F.lit("Resumen nacional").alias("contenido"))
    empty = books.select("path", F.lit(None).cast("string").alias("hoja"), F.lit("Notas").alias("contenido"))
    return entries.unionByName(summary).unionByName(empty)


def raw_book_index(sheets: DataFrame) -> DataFrame:
    """The contents sheet as landed: generic columns, a header row, a row
    counter and a notes column next to the two useful columns."""
    idx = book_index(sheets)
    body = idx.select(
        "path",
        F.lit(None).cast("string").alias("col_1"),
        F.col("hoja").alias("col_2"),
        F.col("contenido").alias("col_3"),
        F.when(F.col("contenido").contains("Resumen"), F.lit("ver notas")).alias("col_4"),
    )
    header = _books(sheets).select(
        "path",
        F.lit("No.").alias("col_1"),
        F.lit("Hoja").alias("col_2"),
        F.lit("Contenido").alias("col_3"),
        F.lit("Notas").alias("col_4"),
    )
    return header.unionByName(body)


def book_tabs(sheets: DataFrame) -> DataFrame:
    """Sheet tabs of each workbook, in order: contents first, then one
    numbered tab per sheet, then two non-data tabs."""
    data = sheets.select("path", (F.col("hoja") + 1).alias("position"), F.col("hoja").cast("string").alias("sheet_name"))
    books = _books(sheets)
    first = books.select("path", F.lit(1).alias("position"), F.lit("Contenido").alias("sheet_name"))
    notes = books.select("path", (F.col("n") + 2).alias("position"), F.lit(f"{BAD_HEADER_INDEX}.1").alias("sheet_name"))
    paren = books.select("path", (F.col("n") + 3).alias("position"), F.lit("(1)").alias("sheet_name"))
    return first.unionByName(data).unionByName(notes).unionByName(paren).withColumn("position", F.col("position").cast("int"))


def month_grid(panel: DataFrame) -> list[dt.date]:
    """Sorted months of the panel: a calendar-bounded plan parameter."""
    return [r[0] for r in panel.select("date").distinct().orderBy("date").collect()]


def month_headers(months: list[dt.date]) -> list[str]:
    return [BAD_HEADER if i == BAD_HEADER_INDEX else str((m - EXCEL_EPOCH).days) for i, m in enumerate(months)]


def landed_sheets(panel: DataFrame, sheets: DataFrame, months: list[dt.date] | None = None) -> DataFrame:
    """All published sheets as one wide table over the month grid.

    A sheet that two codes share holds the sum of an additive series; two
    wages of one cell raise."""
    months = months or month_grid(panel)
    headers = month_headers(months)
    serial = F.datediff(F.col("date"), F.lit(EXCEL_EPOCH)).cast("string")
    header = serial
    if len(months) > BAD_HEADER_INDEX:
        header = F.when(F.col("date") == F.lit(months[BAD_HEADER_INDEX]), F.lit(BAD_HEADER)).otherwise(serial)
    sub_level = F.col("level") == "Subdelegación"
    d2 = F.lpad(F.col("clave_delegacion").cast("string"), 2, "0")
    cells = panel.join(sheets, ["level", "series", "disaggregation", "sheet_name"]).select(
        "path",
        (F.col("hoja") + 1).cast("int").alias("position"),
        d2.alias(H_DEL),
        F.when(F.col("clave_delegacion") == 99, F.lit(NATIONAL_TITLE)).otherwise(F.col("delegacion")).alias(H_DEL_NAME),
        F.when(sub_level, F.concat(d2, F.lpad(F.col("clave_subdelegacion").cast("string"), 2, "0"))).alias(H_SUB),
        F.when(sub_level, F.col("subdelegacion")).alias(H_SUB_NAME),
        header.alias("header"),
        "series",
        "value",
    )
    return cells.groupBy("path", "position", H_DEL, H_DEL_NAME, H_SUB, H_SUB_NAME).pivot("header", headers).agg(
        one_value(F.col("series") != SERIES_WAGE)
    )
