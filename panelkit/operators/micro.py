"""Register → count cube, and cube cleaning."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.functions.codes import modality_code, size_label
from panelkit.functions.means import amount, exact_mean
from panelkit.schema import CUBE_KEYS


def microdata_counts(micro: DataFrame, keys: list[str] | None = None, sort: bool = False) -> DataFrame:
    """Aggregate the register into the count cube.

    Only records with both insured flags set count.  Per cell: non-NULL
    worker ids (``count``, not distinct), mean wage (exact, see
    ``functions/means.py``) and summed employer flags.  NULL keys form their own groups.  The hash aggregate runs a
    partial (map-side) pass first, so a hot cell costs one row per task
    before the shuffle, whatever its size.
    """
    keys = keys or CUBE_KEYS
    wage = amount("sal_cierre")
    cube = (
        micro.where((F.col("aseg_cierre") == 1) & (F.col("aseg") == 1))
        .groupBy(*keys)
        .agg(
            F.count("nss").alias("asegurados"),
            exact_mean(F.sum(wage), F.count(wage)).alias("salario"),
            F.sum("empresas3").cast("bigint").alias("patrones"),
        )
    )
    return cube.orderBy(*keys) if sort else cube


def clean_counts(cube: DataFrame, month: dt.date | str | None = None) -> DataFrame:
    """Rename geography keys, derive the modality code, clean the size label.

    When ``month`` is given, only the cells of that month are taken, and cells
    without a date (an extract without one) belong to it; otherwise the
    cube's own ``date`` column is kept.
    """
    out = cube.withColumnsRenamed({"cve_del_final": "clave_delegacion", "cve_subdel_final": "clave_subdelegacion"})
    if month is not None:
        own = F.lit(month).cast("date")
        if "date" in out.columns:
            out = out.where(F.col("date").isNull() | (F.col("date") == own))
        out = out.withColumn("date", own)
    return out.withColumns({"cve_modalidad": modality_code("mod", "tipotrc"), "size_cierre": size_label("size_cierre")})
