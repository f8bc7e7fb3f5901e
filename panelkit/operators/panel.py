"""Count cube → long panel at subdelegation, delegation and national level.

The reference builds five family tables, joins each to the code dictionary,
sums additive series up to delegation and national level and recomputes the
weighted wage at each level from the cube.  Here the same result comes from
one pass over the cube:

1. every cube row is expanded into its (up to five) family rows with
   ``inline(filter(array(struct…)))`` — a narrow, codegen'd projection;
2. one join with the small code dictionary, broadcast by the planner (null-safe on the
   code, so a NULL size range can match a NULL dictionary code);
3. one ``GROUPING SETS`` aggregation produces the three levels at once.
   Wages carry ``Σ wage·weight`` (an exact decimal) and ``Σ weight`` so each
   level's mean is recomputed from the cube, never averaged from the level
   below, and does not depend on the order of the rows;
4. national rows are emitted once per level label with ``inline``.

Two shuffles in total (cube, panel), independent of the number of families.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.functions.codes import code_text, employer_modality_code
from panelkit.functions.means import exact_mean, weighted
from panelkit.schema import (
    DIS_MODALITY,
    DIS_SECTOR,
    DIS_SIZE,
    LEVEL_DELEGATION,
    LEVEL_SUBDELEGATION,
    NATIONAL_CODE,
    SERIES_EMPLOYERS,
    SERIES_INSURED,
    SERIES_WAGE,
)

FAMILIES = ("insured_modality", "insured_sector", "employers_modality", "employers_size", "wage_modality")
ADDITIVE_FAMILIES = FAMILIES[:4]
LEVELS = ("subdelegation", "delegation", "national")

PANEL_OUT = [
    "date",
    "level",
    "clave_delegacion",
    "clave_subdelegacion",
    "series",
    "disaggregation",
    "sheet_name",
    "book_name",
    "value",
]


def _family_struct(name: str) -> Column:
    n = F.col("asegurados").cast("bigint")
    p = F.coalesce(F.col("patrones").cast("bigint"), F.lit(0).cast("bigint"))
    s = F.col("salario").cast("double")
    worth = weighted(s, n)
    null_long = F.lit(None).cast("bigint")
    no_worth = F.lit(None).cast("decimal(37,8)")
    true = F.lit(True)
    if name == "insured_modality":
        spec = (SERIES_INSURED, DIS_MODALITY, F.col("cve_modalidad"), n, no_worth, null_long, true)
    elif name == "insured_sector":
        spec = (
            SERIES_INSURED, DIS_SECTOR, code_text("div_final"), n, no_worth, null_long,
            F.col("div_final").isNotNull(),
        )
    elif name == "employers_modality":
        spec = (SERIES_EMPLOYERS, DIS_MODALITY, employer_modality_code("mod"), p, no_worth, null_long, true)
    elif name == "employers_size":
        spec = (SERIES_EMPLOYERS, DIS_SIZE, F.col("size_cierre"), p, no_worth, null_long, true)
    elif name == "wage_modality":
        # Rows without a wage drop out of numerator and denominator alike.
        spec = (
            SERIES_WAGE, DIS_MODALITY, F.col("cve_modalidad"), null_long,
            worth, F.when(s.isNotNull(), n), true,
        )
    else:
        raise ValueError(f"unknown family {name!r}")
    series, dis, code, v, wn, wd, keep = spec
    return F.struct(
        F.lit(series).alias("series"),
        F.lit(dis).alias("disaggregation"),
        code.cast("string").alias("code"),
        v.alias("v"),
        wn.alias("wn"),
        wd.cast("bigint").alias("wd"),
        keep.alias("keep"),
    )


def family_rows(clean: DataFrame, families: tuple[str, ...] = FAMILIES) -> DataFrame:
    """Active-registration cube rows expanded into their family rows."""
    arr = F.filter(F.array(*[_family_struct(f) for f in families]), lambda x: x["keep"])
    return (
        clean.where(F.col("ta") == 1)
        .select("date", "clave_delegacion", "clave_subdelegacion", F.inline(arr))
        .drop("keep")
    )


def _dictionary_side(dic: DataFrame) -> DataFrame:
    """Dictionary rows with a sheet name (a missing name drops the row, as in
    the reference).  The dictionary is a small dimension; the planner
    broadcasts it (an inline dictionary already carries the hint)."""
    return dic.where(F.col("sheet_name").isNotNull()).select(
        F.col("series").alias("d_series"),
        F.col("disaggregation").alias("d_dis"),
        F.col("sheet_name_code").alias("d_code"),
        "sheet_name",
        "book_name",
    )


def _join_dictionary(rows: DataFrame, dic: DataFrame, how: str = "inner") -> DataFrame:
    d = _dictionary_side(dic)
    cond = (
        (F.col("series") == F.col("d_series"))
        & (F.col("disaggregation") == F.col("d_dis"))
        & F.col("code").eqNullSafe(F.col("d_code"))
    )
    return rows.join(d, cond, how).drop("d_series", "d_dis", "d_code")


def _value() -> Column:
    wage = exact_mean(F.col("sum_wn"), F.col("sum_wd"))
    return F.when(F.col("series") == SERIES_WAGE, wage).otherwise(F.col("sum_v").cast("double"))


def one_value(additive: Column) -> Column:
    """Aggregate of the rows of one cell (entity, sheet and month).

    Two codes of one sheet give two rows: those of an additive series are
    summed; two wages have no mean without their weights, so they raise.
    """
    several = F.raise_error(F.lit("several values of a series that is not additive in one cell: two codes share a sheet"))
    return (
        F.when(F.count("value") <= 1, F.max("value"))
        .when(F.coalesce(F.bool_and(additive), F.lit(False)), F.sum("value"))
        .otherwise(several.cast("double"))
        .alias("value")
    )


def family_table(clean: DataFrame, dic: DataFrame, family: str) -> DataFrame:
    """One family at subdelegation level, left-joined to the dictionary.

    Codes missing from the dictionary stay with a NULL ``sheet_name`` (the
    panel drops them later).  Wages with zero total weight are NULL here.
    """
    rows = family_rows(clean, (family,))
    agg = rows.groupBy("date", "clave_delegacion", "clave_subdelegacion", "series", "disaggregation", "code").agg(
        F.sum("v").alias("sum_v"), F.sum("wn").alias("sum_wn"), F.sum("wd").alias("sum_wd")
    )
    out = _join_dictionary(agg, dic, "left").withColumn("value", _value())
    return out.select(
        "date", "clave_delegacion", "clave_subdelegacion", "series", "disaggregation", "sheet_name", "book_name", "value"
    )


def build_panel(
    clean: DataFrame,
    dic: DataFrame,
    levels: tuple[str, ...] = LEVELS,
    families: tuple[str, ...] = FAMILIES,
) -> DataFrame:
    """The long panel of one or many months (flagship operator)."""
    rows = _join_dictionary(family_rows(clean, families), dic)
    rows = rows.withColumn("k", F.when(F.col("series") == SERIES_WAGE, F.col("code")))
    base = ["date", "series", "disaggregation", "sheet_name", "book_name"]
    sets = {
        # Subdelegation: per code (two codes of one sheet stay two rows).
        "subdelegation": ["clave_delegacion", "clave_subdelegacion", "code"],
        # Delegation / national: additive series per sheet, wages per code.
        "delegation": ["clave_delegacion", "k"],
        "national": ["k"],
    }
    grouping_sets = [base + sets[lv] for lv in levels]
    all_cols = base + ["clave_delegacion", "clave_subdelegacion", "code", "k"]
    agg = rows.groupingSets(grouping_sets, *all_cols).agg(
        F.sum("v").alias("sum_v"),
        F.sum("wn").alias("sum_wn"),
        F.sum("wd").alias("sum_wd"),
        F.grouping("clave_delegacion").alias("g_del"),
        F.grouping("clave_subdelegacion").alias("g_sub"),
    )
    national = F.col("g_del") == 1
    null_int = F.lit(None).cast("int")

    def label(level: str, d: Column, s: Column) -> Column:
        return F.struct(
            F.lit(level).alias("level"), d.cast("int").alias("clave_delegacion"), s.cast("int").alias("clave_subdelegacion")
        )

    labels = (
        F.when(
            F.col("g_sub") == 0,
            F.array(label(LEVEL_SUBDELEGATION, F.col("clave_delegacion"), F.col("clave_subdelegacion"))),
        )
        .when(F.col("g_del") == 0, F.array(label(LEVEL_DELEGATION, F.col("clave_delegacion"), null_int)))
        .otherwise(
            F.array(
                label(LEVEL_DELEGATION, F.lit(NATIONAL_CODE), null_int),
                label(LEVEL_SUBDELEGATION, F.lit(NATIONAL_CODE), F.lit(NATIONAL_CODE)),
            )
        )
    )
    out = (
        agg.withColumn("value", _value())
        # Zero-weight wages vanish below national level but stay at national.
        .where(F.col("value").isNotNull() | national)
        .select("date", F.inline(labels), "series", "disaggregation", "sheet_name", "book_name", "value")
    )
    return out.select(*PANEL_OUT)


def with_geo(panel: DataFrame, geo: DataFrame) -> DataFrame:
    """Attach delegation / subdelegation names (null-safe on the codes)."""
    sub = geo.select(
        F.col("clave_delegacion").alias("g_del"),
        F.col("clave_subdelegacion").alias("g_sub"),
        "subdelegacion",
    ).distinct()
    dl = geo.select(F.col("clave_delegacion").alias("g_del2"), "delegacion").distinct()
    out = panel.join(
        sub,
        F.col("clave_delegacion").eqNullSafe(F.col("g_del")) & F.col("clave_subdelegacion").eqNullSafe(F.col("g_sub")),
        "left",
    ).drop("g_del", "g_sub")
    out = out.join(dl, F.col("clave_delegacion").eqNullSafe(F.col("g_del2")), "left").drop("g_del2")
    return out
