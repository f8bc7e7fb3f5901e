"""Review queries of the published panel (notebook and README examples)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.schema import LEVEL_DELEGATION

# Per (series, disaggregation), the sheet-label pattern the
# review looks at by delegation ('.' is a regex wildcard, as in the review).
REVIEW_PATTERNS = [
    ("Asegurados", "Modalidad", "10.1"),
    ("Asegurados", "Sector económico", "comercio"),
    ("Patrones", "Modalidad", "10"),
    ("Patrones", "Rango de trabajadores", "Más de 1000"),
    ("Salario", "Modalidad", "10.1"),
]
NATIONAL_NAME = "Nacional"


def review_national(panel: DataFrame) -> DataFrame:
    """Delegation-level national lines of every sheet."""
    return panel.where((F.col("level") == LEVEL_DELEGATION) & (F.col("delegacion") == NATIONAL_NAME)).select(
        "series", "disaggregation", "sheet_name", "date", "value"
    )


def review_by_delegation(panel: DataFrame) -> DataFrame:
    """Per family, the sheets matching its review pattern, every delegation."""
    cond = F.lit(False)
    for series, dis, pattern in REVIEW_PATTERNS:
        cond = cond | (
            (F.col("series") == series) & (F.col("disaggregation") == dis) & F.col("sheet_name").rlike(pattern)
        )
    return panel.where((F.col("level") == LEVEL_DELEGATION) & cond).select(
        "series", "disaggregation", "sheet_name", "clave_delegacion", "delegacion", "date", "value"
    )


def national_by_modality(panel: DataFrame, series: str = "Asegurados") -> DataFrame:
    """National rows (code 99, no subdelegation) of one series by modality."""
    return panel.where(
        (F.col("series") == series)
        & (F.col("disaggregation") == "Modalidad")
        & (F.col("clave_delegacion") == 99)
        & F.col("clave_subdelegacion").isNull()
    )


def since(panel: DataFrame, series: str, level: str, start: dt.date) -> DataFrame:
    return panel.where((F.col("series") == series) & (F.col("level") == level) & (F.col("date") >= F.lit(start)))
