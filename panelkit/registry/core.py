"""Registered queries of the register → panel build."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

from panelkit.functions.codes import normalize_code
from panelkit.functions.dates import reference_month
from panelkit.operators.panel import ADDITIVE_FAMILIES, family_table
from panelkit.operators.snapshot import latest_snapshot
from panelkit.registry import oracle_base as O
from panelkit.registry.common import clean, cube, panel, panel_geo
from panelkit.session import literal_table
from panelkit.sources.register import code_dictionary
from panelkit.sources.tables import read_table

# Extra as-of days that exercise month-end and day-5 edges.
EDGE_AS_OF = [dt.date(2025, 3, 31), dt.date(2025, 1, 4), dt.date(2025, 1, 5), dt.date(2024, 2, 29)]
# Fixed value: a superseded snapshot name planted in the listing.
SUPERSEDED_PATH = "/data/pafinalmes209912ant.sas7bdat"


def q_microdata_counts(spark: SparkSession, sf: str) -> DataFrame:
    return cube(spark, sf)


def q_clean_counts(spark: SparkSession, sf: str) -> DataFrame:
    return clean(spark, sf)


def code_candidates(spark: SparkSession, sf: str) -> DataFrame:
    """Dictionary-like codes derived from the cleaned cube: short codes,
    float artefacts, long integers, long non-numeric text and NULLs."""
    c = clean(spark, sf)
    raw = F.array(
        F.col("cve_modalidad"),
        F.concat(F.col("cve_modalidad"), F.lit("00000000000001")),
        (F.col("asegurados") * 1000 + 1000000).cast("string"),
        F.concat(F.lit("codigo "), F.col("mod")),
        F.col("size_cierre"),
    )
    return c.select(F.explode(raw).alias("sheet_name_code_raw"))


def q_dictionary_code_normalize(spark: SparkSession, sf: str) -> DataFrame:
    return code_candidates(spark, sf).select(
        "sheet_name_code_raw", normalize_code("sheet_name_code_raw").alias("sheet_name_code")
    )


def as_of_days(spark: SparkSession, sf: str) -> DataFrame:
    od = read_table(spark, sf, "orders", "o_orderdate").select(F.col("o_orderdate").cast("date").alias("as_of"))
    edges = literal_table(spark, [(d,) for d in EDGE_AS_OF], StructType([StructField("as_of", DateType())]))
    return od.unionByName(edges).distinct()


def q_reference_month(spark: SparkSession, sf: str) -> DataFrame:
    return as_of_days(spark, sf).select("as_of", reference_month("as_of").alias("month"))


def snapshot_listing(spark: SparkSession, sf: str) -> DataFrame:
    d = F.col("o_orderdate")
    period = (F.year(d) * 100 + F.month(d)).cast("string")
    od = read_table(spark, sf, "orders", "o_orderdate").select(
        F.concat(F.lit("/data/pafinalmes"), period, F.lit(".sas7bdat")).alias("path")
    )
    return od.distinct().unionByName(literal_table(spark, [(SUPERSEDED_PATH,)], StructType([StructField("path", StringType())])))


def q_latest_period_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    return latest_snapshot(snapshot_listing(spark, sf))


def _family(name: str):
    def q(spark: SparkSession, sf: str) -> DataFrame:
        return family_table(clean(spark, sf), code_dictionary(spark), name)

    return q


def _panel(levels, families=None, geo=False):
    def q(spark: SparkSession, sf: str) -> DataFrame:
        if geo:
            df = panel_geo(spark, sf)
        elif families is None:
            df = panel(spark, sf, levels)
        else:
            df = panel(spark, sf, levels, families)
        return df

    return q


QUERIES = {
    "microdata_counts": q_microdata_counts,
    "clean_counts": q_clean_counts,
    "dictionary_code_normalize": q_dictionary_code_normalize,
    "reference_month": q_reference_month,
    "latest_period_snapshot": q_latest_period_snapshot,
    "insured_by_modality": _family("insured_modality"),
    "insured_by_sector": _family("insured_sector"),
    "employers_by_modality": _family("employers_modality"),
    "employers_by_size": _family("employers_size"),
    "wage_by_modality": _family("wage_modality"),
    "panel_subdelegation": _panel(("subdelegation",)),
    "panel_delegation": _panel(("delegation",), ADDITIVE_FAMILIES),
    "wage_delegation": _panel(("delegation",), ("wage_modality",)),
    "panel_national": _panel(("national",), ADDITIVE_FAMILIES),
    "wage_national": _panel(("national",), ("wage_modality",)),
    "panel_full": _panel(("subdelegation", "delegation", "national")),
    "panel_with_geo": _panel(None, geo=True),
}

_PCOLS = "date, level, clave_delegacion, clave_subdelegacion, series, disaggregation, sheet_name, book_name"
_FCOLS = "date, clave_delegacion, clave_subdelegacion, series, disaggregation, sheet_name, book_name"


def _fam_sql(cte: str) -> str:
    return f"{O.PANEL_BASE} SELECT {_FCOLS}, value FROM ({O.family_joined(cte)}) f"


def _panel_sql(src: str, where: str = "TRUE") -> str:
    return f"{O.PANEL_BASE} SELECT {_PCOLS}, value FROM {src} WHERE {where}"


ORACLE = {
    "microdata_counts": f"""{O.BASE} SELECT date, ta, cve_del_final, cve_subdel_final, mod, tipotrc, div_final, size_cierre,
        asegurados, salario, patrones FROM cube""",
    "clean_counts": f"""{O.BASE} SELECT date, ta, clave_delegacion, clave_subdelegacion, mod, tipotrc, div_final, size_cierre,
        cve_modalidad, asegurados, salario, patrones FROM clean""",
    "dictionary_code_normalize": f"""{O.BASE}, codes AS (
        SELECT cve_modalidad AS raw FROM clean UNION ALL SELECT cve_modalidad || '00000000000001' FROM clean
        UNION ALL SELECT CAST(asegurados * 1000 + 1000000 AS VARCHAR) FROM clean
        UNION ALL SELECT 'codigo ' || mod FROM clean UNION ALL SELECT size_cierre FROM clean)
        SELECT raw AS sheet_name_code_raw,
          CASE WHEN length(raw) > 5 THEN regexp_replace(CAST(CAST(round(TRY_CAST(raw AS DOUBLE), 1) AS DECIMAL(38,1)) AS VARCHAR), '\\.0$', '')
               ELSE raw END AS sheet_name_code
        FROM codes""",
    "reference_month": """WITH f_asof AS (
        SELECT DISTINCT CAST(o_orderdate AS DATE) AS as_of FROM orders
        UNION SELECT * FROM (VALUES (DATE '2025-03-31'), (DATE '2025-01-04'), (DATE '2025-01-05'), (DATE '2024-02-29')) t(as_of))
        SELECT as_of, CAST(date_trunc('month', as_of) - to_months(CASE WHEN day(as_of) >= 5 THEN 1 ELSE 2 END) AS DATE) AS month
        FROM f_asof""",
    "latest_period_snapshot": """WITH f_snap AS (
        SELECT DISTINCT '/data/pafinalmes' || CAST(year(o_orderdate) * 100 + month(o_orderdate) AS VARCHAR(6)) || '.sas7bdat' AS path FROM orders
        UNION ALL SELECT * FROM (VALUES ('/data/pafinalmes209912ant.sas7bdat')) t(path)),
        files AS (SELECT path, string_split(path, '/')[-1] AS full_periodo FROM f_snap),
        kept AS (SELECT path, full_periodo, split_part(full_periodo, '.', 1) AS periodo FROM files
                 WHERE NOT full_periodo LIKE '%ant.sas7bdat')
        SELECT path, full_periodo, periodo FROM kept WHERE periodo = (SELECT max(periodo) FROM kept)""",
    "insured_by_modality": _fam_sql("fam_aseg_mod"),
    "insured_by_sector": _fam_sql("fam_aseg_sector"),
    "employers_by_modality": _fam_sql("fam_pat_mod"),
    "employers_by_size": _fam_sql("fam_pat_size"),
    "wage_by_modality": _fam_sql("fam_wage"),
    "panel_subdelegation": _panel_sql("sheets_new", "level = 'Subdelegación'"),
    "panel_delegation": _panel_sql("sheets_new", "level = 'Delegación' AND series <> 'Salario'"),
    "wage_delegation": _panel_sql("sheets_new", "level = 'Delegación' AND series = 'Salario'"),
    "panel_national": _panel_sql("nat_add"),
    "wage_national": _panel_sql("wage_nat"),
    "panel_full": _panel_sql("panel_full"),
    "panel_with_geo": f"""{O.PANEL_BASE} SELECT {_PCOLS}, delegacion, subdelegacion, value FROM panel_geo""",
}
