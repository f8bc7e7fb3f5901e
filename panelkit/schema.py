"""Declared schemas of the engine's tables."""

from pyspark.sql.types import (
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

# Long panel: one row per (series, sheet, level, geography, month).
PANEL = StructType(
    [
        StructField("book_id", IntegerType()),
        StructField("sheet_id", IntegerType()),
        StructField("book_name", StringType()),
        StructField("sheet_name", StringType()),
        StructField("level", StringType()),
        StructField("date", DateType()),
        StructField("clave_delegacion", IntegerType()),
        StructField("clave_subdelegacion", IntegerType()),
        StructField("delegacion", StringType()),
        StructField("subdelegacion", StringType()),
        StructField("series", StringType()),
        StructField("disaggregation", StringType()),
        StructField("value", DoubleType()),
    ]
)

PANEL_COLUMNS = [f.name for f in PANEL.fields]

# Projection used by the explorer (10 of the 13 columns).
EXPLORER_COLUMNS = [
    "series",
    "level",
    "clave_delegacion",
    "delegacion",
    "clave_subdelegacion",
    "subdelegacion",
    "disaggregation",
    "sheet_name",
    "date",
    "value",
]

# Micro register: one row per insured worker per month.
MICRO = StructType(
    [
        StructField("date", DateType()),
        StructField("nss", LongType()),
        StructField("ta", IntegerType()),
        StructField("div_final", IntegerType()),
        StructField("size_cierre", StringType()),
        StructField("cve_del_final", IntegerType()),
        StructField("cve_subdel_final", IntegerType()),
        StructField("mod", StringType()),
        StructField("tipotrc", StringType()),
        StructField("aseg_cierre", IntegerType()),
        StructField("aseg", IntegerType()),
        StructField("sal_cierre", DoubleType()),
        StructField("empresas3", IntegerType()),
    ]
)

CUBE_KEYS = ["date", "ta", "cve_del_final", "cve_subdel_final", "mod", "tipotrc", "div_final", "size_cierre"]

CODE_DICT = StructType(
    [
        StructField("series", StringType()),
        StructField("disaggregation", StringType()),
        StructField("sheet_name_code", StringType()),
        StructField("sheet_name", StringType()),
        StructField("book_name", StringType()),
    ]
)

GEO_DICT = StructType(
    [
        StructField("clave_delegacion", IntegerType()),
        StructField("delegacion", StringType()),
        StructField("clave_subdelegacion", IntegerType()),
        StructField("subdelegacion", StringType()),
    ]
)

# Fixed label values of the panel (they are its public API).
LEVEL_DELEGATION = "Delegación"
LEVEL_SUBDELEGATION = "Subdelegación"
SERIES_INSURED = "Asegurados"
SERIES_EMPLOYERS = "Patrones"
SERIES_WAGE = "Salario"
DIS_MODALITY = "Modalidad"
DIS_SECTOR = "Sector económico"
DIS_SIZE = "Rango de trabajadores"
NATIONAL_CODE = 99
