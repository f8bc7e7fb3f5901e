"""Registered queries of workbooks that each have their own columns and months."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.operators import books as B
from panelkit.operators.panel import one_value
from panelkit.plans import history as H
from panelkit.registry import books as R
from panelkit.schema import SERIES_WAGE
from panelkit.session import scratch_path
from panelkit.registry import published_books as S
from panelkit.sources.register import geo_dictionary

# Subdelegation books begin five months later, employer books end three months earlier and put names before codes;
# the third month of every book has a header that is no date.
LATE, EARLY, BAD_MONTH = 5, 3, 3
SUB_FOLDER, EMPLOYER_FOLDER = "SUBDELEGACIONES", "PATRONES"


def landed_rows(panel: DataFrame, sheets: DataFrame) -> DataFrame:
    """Every line of every published sheet with its own headers: path, position, cells."""
    months = S.month_grid(panel)
    d2 = F.lpad(F.col("clave_delegacion").cast("string"), 2, "0")
    sub = F.col("level") == "Subdelegación"
    line = [
        d2.alias("del"),
        F.when(F.col("clave_delegacion") == 99, F.lit(S.NATIONAL_TITLE)).otherwise(F.col("delegacion")).alias("del_name"),
        F.when(sub, F.concat(d2, F.lpad(F.col("clave_subdelegacion").cast("string"), 2, "0"))).alias("sub"),
        F.when(sub, F.col("subdelegacion")).alias("sub_name"),
    ]
    own = ["path", "position", "del", "del_name", "sub", "sub_name"]
    cells = panel.join(sheets, ["level", "series", "disaggregation", "sheet_name"]).select("path", (F.col("hoja") + 1).cast("int").alias("position"), *line, "date", "series", "value")
    values = cells.groupBy(*own, "date").agg(one_value(F.col("series") != SERIES_WAGE)).groupBy(*own).agg(F.map_from_entries(F.collect_list(F.struct("date", "value"))).alias("by_month"))
    late, early = F.when(F.col("path").contains(SUB_FOLDER), LATE).otherwise(0), F.when(F.col("path").contains(EMPLOYER_FOLDER), EARLY).otherwise(0)
    grid = F.slice(F.array(*[F.lit(m) for m in months]), late + 1, F.greatest(F.lit(0), len(months) - late - early))

    def cell(header: str, value: Column) -> Column:
        return F.struct(F.lit(header).alias("header"), value.alias("cell"))

    def month(d: Column, i: Column) -> Column:
        header = F.when(i == BAD_MONTH - 1, F.lit(S.BAD_HEADER)).otherwise(F.datediff(d, F.lit(S.EXCEL_EPOCH)).cast("string"))
        return F.struct(header.alias("header"), F.try_element_at("by_month", d).cast("string").alias("cell"))

    codes_first = F.array(cell(S.H_DEL, F.col("del")), cell(S.H_DEL_NAME, F.col("del_name")), cell(S.H_SUB, F.col("sub")), cell(S.H_SUB_NAME, F.col("sub_name")))
    names_first = F.array(cell(f" {S.H_DEL_NAME.upper()} ", F.col("del_name")), cell(S.H_DEL.upper(), F.col("del")), cell("Notas", F.lit("x")), cell(S.H_SUB_NAME, F.col("sub_name")), cell(S.H_SUB, F.col("sub")))
    keys = F.when(F.col("path").contains(EMPLOYER_FOLDER), names_first).otherwise(codes_first)
    return values.select("path", "position", F.concat(keys, F.transform(grid, month)).alias("cells"))


def _landed(spark: SparkSession, sf: str):
    """The lines as they land in the shared folder, and the books' sheets."""
    p, sh = R.published(spark, sf)
    path = scratch_path(spark, "landed-books")
    landed_rows(p, sh).write.parquet(path)
    return spark.read.parquet(path), sh


def q_mixed_books_unpivot(spark: SparkSession, sf: str) -> DataFrame:
    return B.unpivot_rows(_landed(spark, sf)[0])


def q_mixed_books_repair(spark: SparkSession, sf: str) -> DataFrame:
    return H.repaired_long(_landed(spark, sf)[0])


def q_mixed_books_panel(spark: SparkSession, sf: str) -> DataFrame:
    rows, sh = _landed(spark, sf)
    return H.historical_panel(S.book_catalogue(spark, sh), R._index(sh), S.book_tabs(sh), rows, geo_dictionary(spark, sf))


QUERIES = {"mixed_books_unpivot": q_mixed_books_unpivot, "mixed_books_repair": q_mixed_books_repair, "mixed_books_panel": q_mixed_books_panel}

#: The common grid of the other book queries, with months and numbers per book.
_HDR = R.GRID[R.GRID.index("hdr AS (") : R.GRID.index("cellsrc AS (")]
GRID = (
    R.GRID.replace(
        _HDR,
        f"""hdr0 AS (SELECT path, date, CAST(row_number() OVER (PARTITION BY path ORDER BY date) AS INT) AS col_pos
  FROM (SELECT DISTINCT path FROM pub) b CROSS JOIN (SELECT *, max(col_pos) OVER () AS n FROM grid) g
  WHERE (NOT contains(path, '{SUB_FOLDER}') OR g.col_pos > {LATE}) AND (NOT contains(path, '{EMPLOYER_FOLDER}') OR g.col_pos <= n - {EARLY})),
hdr AS (SELECT path, date, col_pos, CASE WHEN col_pos = {BAD_MONTH} THEN '{S.BAD_HEADER}'
  ELSE CAST(date_diff('day', DATE '1899-12-30', date) AS VARCHAR) END AS header FROM hdr0),
""",
    )
    .replace("FROM rowsrc r CROSS JOIN hdr h", "FROM rowsrc r JOIN hdr h ON h.path = r.path")
    .replace("LEFT JOIN hdr ON hdr.col_pos = bad.anchor_pos", "LEFT JOIN hdr ON hdr.path = bad.path AND hdr.col_pos = bad.anchor_pos")
)
ORACLE = {f"mixed_books_{name}": R.ORACLE[key].replace(R.GRID, GRID) for name, key in (("unpivot", "sheet_unpivot"), ("repair", "date_repair"), ("panel", "historical_panel"))}
