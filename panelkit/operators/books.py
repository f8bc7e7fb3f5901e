"""Historical workbooks → long panel: catalogue classification, index and
sheet-position extraction, conflict gate, ids, unpivot, date repair, label
cleaning and code split.

Workbooks arrive landed as flat tables (catalogue of paths, index rows,
sheet tabs, one wide table of all sheets).  The reference loops over files
and nested tables; here every step is a column expression, a join or a
window partitioned by book / sheet, so the file loop disappears.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.functions.dates import excel_serial_to_date
from panelkit.functions.text import (
    first_number,
    remove_first_dot,
    remove_first_suffix,
    sentence_case,
    squish,
    strip_accents,
)
from panelkit.operators.ids import ordered_numbers
from panelkit.session import cut_lineage

# Folder names of the series kept in the catalogue.
SERIES_FOLDERS = "ASEGURADOS TRABAJADORES|PATRONES|SALARIO"
# Series rules, first match wins (pattern on the clean name).
SERIES_RULES = [
    ("patrones", "Patrones"),
    ("masa", "Masa salarial"),
    ("salario", "Salario"),
    ("trabsal", "Trabsal"),
    ("asegurados trabajadores", "Asegurados trabajadores"),
    ("ema", "EMA"),
    ("ibc", "IBC"),
    ("inc", "INC"),
    ("metas", "Metas"),
    ("mora", "Mora"),
    ("recaudacion", "Recaudación"),
    ("consultorio", "Población derechohabiente adscrita a consultorio"),
    ("adscrita|pda", "Población derechohabiente adscrita"),
    ("potencial", "Población derechohabiente potencial"),
    ("derechohabiente", "Población derechohabiente"),
]
# Disaggregation rules on the clean name, then on the path.
DISAGGREGATION_RULES = [
    ("modalidad", "Modalidad"),
    ("sector", "Sector económico"),
    ("rango", "Rango de trabajadores"),
    ("umf", "UMF"),
]
DISAGGREGATION_PATH_RULE = ("ASEGURADOS", "Modalidad")
EXCLUDED_BOOKS = "rango salarial"
# Label cleaning filters and recodes.
EXCLUDED_SERIES_BOOKS = "Trabsal|Masa"
EXCLUDED_SHEETS = "total|Total|sector industrial|sector servicios"
WAGE_BOOK_NAME = "Salario trabajadores"
SHEET_RECODES = [
    ("Entre 501 y 1000 asegurados trabajadores", "Entre 501 y 1,000 asegurados trabajadores"),
    ("Más de 1000 asegurados trabajadores", "Más de 1,000 asegurados trabajadores"),
]
EMPLOYER_SHEET_PATTERN = "Patrones modalidad 10"
EMPLOYER_SHEET_LABEL = "Patrones modalidad 10. Trabajadores permanentes y eventuales de la ciudad"


def _rules(x: Column, rules: list[tuple[str, str]]) -> Column:
    out = None
    for pattern, label in rules:
        out = F.when(x.rlike(pattern), F.lit(label)) if out is None else out.when(x.rlike(pattern), F.lit(label))
    return out


def classify_catalogue(catalogue: DataFrame) -> DataFrame:
    """Workbook paths → clean name, level, series, disaggregation, book_id.

    Level: the file name decides first; in paths ``SUBDELEGACIONES`` is
    tested before ``DELEGACIONES`` (which it contains).  ``book_id`` numbers
    the kept books by path.
    """
    p = F.col("path")
    raw = F.regexp_extract(p, r"([^/]+)\.xlsx$", 1)
    level = (
        F.when(raw.contains("Delegaciones"), F.lit("Delegación"))
        .when(raw.contains("Subdelegaciones"), F.lit("Subdelegación"))
        .when(p.contains("SUBDELEGACIONES"), F.lit("Subdelegación"))
        .when(p.contains("DELEGACIONES"), F.lit("Delegación"))
    )
    name = F.lower(strip_accents(remove_first_dot(squish(remove_first_suffix(raw)))))
    c = catalogue.where(p.rlike(SERIES_FOLDERS)).select("path", name.alias("name"), level.alias("level"))
    n = F.col("name")
    dis = _rules(n, DISAGGREGATION_RULES).when(p.contains(DISAGGREGATION_PATH_RULE[0]), F.lit(DISAGGREGATION_PATH_RULE[1]))
    c = c.select("path", "name", "level", _rules(n, SERIES_RULES).alias("series"), dis.alias("disaggregation"))
    c = c.where(~n.rlike(EXCLUDED_BOOKS))
    c = cut_lineage(c)
    return c.join(ordered_numbers(c, ["path"], "book_id").withColumnRenamed("path", "_path"), F.col("path") == F.col("_path")).drop("_path")


CONTENT_MARKERS = "Hoja|Contenido"


def select_content_columns(raw: DataFrame, key: str = "path") -> DataFrame:
    """Of each book's index sheet, the two columns in which some cell mentions
    ``Hoja`` or ``Contenido``, named ``hoja``, ``contenido`` by position.

    Books differ in layout, so the choice is made per book: one aggregate with
    a flag per column, joined back.  A book without exactly two such columns
    is an error that names it.
    """
    cols = [c for c in raw.columns if c != key]
    flags = raw.groupBy(key).agg(*[F.max(F.col(f"`{c}`").rlike(CONTENT_MARKERS)).alias(f"f{i}") for i, c in enumerate(cols)])
    places = F.filter(F.array(*[F.when(F.col(f"f{i}"), F.lit(i)) for i in range(len(cols))]), lambda p: p.isNotNull())
    chosen = cut_lineage(flags.select(F.col(key).alias("_book"), places.alias("_places")))
    odd = chosen.where(F.size("_places") != 2)
    if n := odd.count():
        raise ValueError(f"{n} index sheets without exactly two Hoja / Contenido columns, first {odd.orderBy('_book').limit(20).collect()}")
    cells = F.array(*[F.col(f"`{c}`").cast("string") for c in cols])
    joined = raw.select(key, cells.alias("_cells")).join(chosen, F.col(key).eqNullSafe(F.col("_book")))
    return joined.select(key, F.get("_cells", F.col("_places")[0]).alias("hoja"), F.get("_cells", F.col("_places")[1]).alias("contenido"))


def extract_index(index: DataFrame) -> DataFrame:
    """Index sheet rows → (Hoja number, squished content); rows with a
    missing cell, without a number, or describing a summary are dropped."""
    c = index.dropna("any", subset=["hoja", "contenido"]).select(
        "path", squish("hoja").alias("hoja_text"), squish("contenido").alias("contenido")
    )
    c = c.select("path", first_number("hoja_text").alias("hoja"), "contenido").dropna("any", subset=["hoja", "contenido"])
    return c.where(~F.col("contenido").rlike("Resumen|resumen"))


def explode_tabs(workbooks: DataFrame) -> DataFrame:
    """(path, tabs in file order) → (path, position from 1, sheet name)."""
    return workbooks.select("path", F.posexplode("tabs").alias("at", "sheet_name")).select("path", (F.col("at") + 1).alias("position"), "sheet_name")


def sheet_positions(tabs: DataFrame) -> DataFrame:
    """Sheet tabs → (position, sheet name, Hoja number) for numeric tabs.

    Tabs containing a letter (any script), a comma, a dot or a parenthesis
    are not data sheets.
    """
    return tabs.where(~F.col("sheet_name").rlike(r"\p{L}|,|\.|\(")).select(
        "path", "position", "sheet_name", first_number("sheet_name").alias("hoja")
    )


def join_index(index: DataFrame, positions: DataFrame) -> DataFrame:
    """Index ⋈ positions on (book, Hoja), left join; the one-to-one rule is
    checked by :func:`index_conflicts`."""
    pos = positions.select(F.col("path").alias("p_path"), F.col("hoja").alias("p_hoja"), "position", "sheet_name")
    cond = (F.col("path") == F.col("p_path")) & (F.col("hoja") == F.col("p_hoja"))
    return index.join(pos, cond, "left").drop("p_path", "p_hoja")


def index_conflicts(joined: DataFrame) -> DataFrame:
    """Per book: Hoja numbers with several sheets or with no sheet.  A book
    can only be read when its count is 0."""
    per_hoja = joined.groupBy("path", "hoja").agg(
        F.count_distinct("sheet_name").alias("n_sheets"),
        F.count(F.lit(1)).alias("n_rows"),
        F.max(F.col("position").isNull().cast("int")).alias("missing"),
    )
    # A Hoja listed twice, matching two tabs, or matching none breaks the
    # one-to-one rule; every index row of such a Hoja counts.
    bad = (F.col("n_sheets") > 1) | (F.col("n_rows") > 1) | (F.col("missing") == 1)
    return per_hoja.groupBy("path").agg(
        F.coalesce(F.sum(F.when(bad, F.col("n_rows"))), F.lit(0)).cast("bigint").alias("conflicts")
    )


def require_no_conflicts(conflicts: DataFrame) -> None:
    bad = conflicts.where(F.col("conflicts") > 0)
    if n := bad.count():
        raise ValueError(f"index conflicts in {n} books, first {bad.orderBy('path').limit(20).collect()}")


def assign_sheet_ids(books: DataFrame, joined: DataFrame) -> DataFrame:
    """sheet_id numbers every indexed sheet by (book_id, position), on the
    index (one row per sheet), never on the data."""
    j = joined.join(books.select("path", "book_id"), "path")
    j = cut_lineage(j)
    order = ["book_id", "position", "hoja", "contenido"]
    ids = ordered_numbers(j, order, "sheet_id").select(*[F.col(c).alias(f"_{c}") for c in order], "sheet_id")
    same = F.lit(True)
    for c in order:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return j.join(ids, same).drop(*[f"_{c}" for c in order])


def snake_case(name: str) -> str:
    """Column-name cleaning (driver-side, on schema metadata only)."""
    t = name.translate(str.maketrans("áéíóúüñÁÉÍÓÚÜÑ", "aeiouunAEIOUUN")).strip().lower()
    t = re.sub(r"[^0-9a-z]+", "_", t).strip("_")
    return re.sub(r"clave_del$", "clave_delegacion", t)


def unpivot_sheets(wide: DataFrame, keys: list[str], drop_missing: bool = True) -> DataFrame:
    """Wide sheet(s) → long: every column whose header holds a digit is a
    month (Excel serial day), values cast to double, NULL where a cell is text; the header position is
    kept for date repair.  ``drop_missing`` drops rows with any NULL, as the
    plain reader does."""
    months = [c for c in wide.columns if re.search(r"\d", c) and c not in keys]
    ids = [c for c in wide.columns if c not in months]
    pos = F.create_map(*[x for i, c in enumerate(months) for x in (F.lit(c), F.lit(i + 1))])
    cast = wide.select(*ids, *[F.col(f"`{c}`").try_cast("double").alias(c) for c in months])
    long = cast.unpivot(ids, months, "header", "value")
    long = long.select(
        *[F.col(f"`{c}`").alias(snake_case(c)) for c in ids],
        pos[F.col("header")].alias("col_pos"),
        "header",
        excel_serial_to_date(F.regexp_replace(F.col("header"), "^m", "")).alias("date"),
        "value",
    )
    return drop_incomplete(long) if drop_missing else long


SHEET_KEYS = ["clave_delegacion", "delegacion", "clave_subdelegacion", "subdelegacion"]


def clean_header(header: Column) -> Column:
    """:func:`snake_case` of a header cell."""
    plain = F.lower(F.trim(F.translate(header, "áéíóúüñÁÉÍÓÚÜÑ", "aeiouunAEIOUUN")))
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(plain, "[^0-9a-z]+", "_"), "^_+|_+$", ""), "clave_del$", "clave_delegacion")


def unpivot_rows(rows: DataFrame, drop_missing: bool = True) -> DataFrame:
    """Landed sheet rows → long, for books that each have their own columns.

    A row holds its sheet (path, position) and ``cells``, the (header, cell)
    pairs of its line in the sheet's order.  Headers with a digit are the
    sheet's own months, numbered as they stand; the columns of SHEET_KEYS are
    found by their cleaned headers wherever they stand, and are NULL where the
    sheet has none; others (notes) are left out.  No column list is needed when
    the query is planned, so a new month or layout changes nothing.
    """
    dated = F.filter("cells", lambda c: c["header"].rlike(r"\d"))

    def key(name: str) -> Column:
        return F.get(F.filter("cells", lambda c: ~c["header"].rlike(r"\d") & (clean_header(c["header"]) == name)), F.lit(0))["cell"].alias(name)

    long = rows.select("path", "position", *[key(k) for k in SHEET_KEYS], F.posexplode(dated).alias("place", "month"))
    long = long.select(
        "path",
        "position",
        *SHEET_KEYS,
        (F.col("place") + 1).alias("col_pos"),
        F.col("month.header").alias("header"),
        excel_serial_to_date(F.regexp_replace("month.header", "^m", "")).alias("date"),
        F.col("month.cell").try_cast("double").alias("value"),
    )
    return drop_incomplete(long) if drop_missing else long


def drop_incomplete(long: DataFrame) -> DataFrame:
    """Drop rows with a missing cell.  Sheets of both layouts share one
    landed table, so the subdelegation columns count only where the sheet
    has them (either both set or both empty)."""
    need = [c for c in ("date", "value", "clave_delegacion", "delegacion") if c in long.columns]
    cond = F.lit(True)
    for c in need:
        cond = cond & F.col(c).isNotNull()
    if "clave_subdelegacion" in long.columns and "subdelegacion" in long.columns:
        cond = cond & (F.col("clave_subdelegacion").isNull() == F.col("subdelegacion").isNull())
    return long.where(cond)


def bad_date_report(long: DataFrame, sheet: list[str]) -> DataFrame:
    """Per sheet with cells under undecodable headers: how many headers and
    cells, and the first decodable header (place and date) to repair from,
    NULL if there is none."""
    cells = long.where(F.col("value").isNotNull())
    bad = F.col("date").isNull()
    anchor = F.min(F.when(~bad, F.struct("col_pos", "date")))
    found = cells.groupBy(*sheet).agg(
        F.count_distinct(F.when(bad, F.col("col_pos"))).alias("bad_headers"),
        F.sum(bad.cast("long")).alias("bad_cells"),
        anchor.alias("anchor"),
    )
    return found.where(F.col("bad_headers") > 0).select(
        *sheet, "bad_headers", "bad_cells", F.col("anchor.col_pos").alias("anchor_pos"), F.col("anchor.date").alias("anchor_date")
    )


def repair_dates(long: DataFrame, sheet: list[str]) -> DataFrame:
    """Sheets with cells under undecodable headers get a monthly sequence
    from their first decodable header, stepping by header place; other sheets
    are kept as they are.  A sheet without any decodable header keeps NULL
    dates and appears in :func:`bad_date_report` without an anchor.

    The repair is a map of one row per bad sheet joined to the cells: the
    cells are aggregated map-side for it and never shuffled by entity.
    """
    bad = bad_date_report(long, sheet).select(*[F.col(c).alias(f"_{c}") for c in sheet], "anchor_pos", "anchor_date", F.lit(True).alias("_bad"))
    same = F.lit(True)
    for c in sheet:
        same = same & (F.col(c) == F.col(f"_{c}"))
    fixed = F.add_months("anchor_date", F.col("col_pos") - F.col("anchor_pos"))
    date = F.when(F.col("_bad"), fixed).otherwise(F.col("date"))
    return long.join(bad, same, "left").withColumn("date", date).select(*long.columns)


def clean_labels(labels: DataFrame) -> DataFrame:
    """Sentence-case names, drop excluded books / sheets, keep Modalidad
    sheets only when the label has a digit, then recode canonical labels.
    A NULL predicate drops the row, as a plain filter does."""
    df = labels.withColumns({"book_name": sentence_case("book_name"), "sheet_name": sentence_case("sheet_name")})
    df = df.where(~F.col("book_name").rlike(EXCLUDED_SERIES_BOOKS))
    df = df.where(~F.col("sheet_name").rlike(EXCLUDED_SHEETS))
    dis = F.col("disaggregation")
    df = df.where(((dis == "Modalidad") & F.col("sheet_name").rlike(r"\d")) | (dis != "Modalidad"))
    series = F.col("series")
    sheet = F.col("sheet_name")
    recoded_sheet = F.when(sheet == SHEET_RECODES[0][0], F.lit(SHEET_RECODES[0][1]))
    for old, new in SHEET_RECODES[1:]:
        recoded_sheet = recoded_sheet.when(sheet == old, F.lit(new))
    recoded_sheet = recoded_sheet.when(
        sheet.contains(EMPLOYER_SHEET_PATTERN) & (series == "Patrones"), F.lit(EMPLOYER_SHEET_LABEL)
    ).otherwise(sheet)
    return df.withColumns(
        {
            "book_name": F.when(series == "Salario", F.lit(WAGE_BOOK_NAME)).otherwise(F.col("book_name")),
            "series": F.when(series.contains("Asegurados"), F.lit("Asegurados")).otherwise(series),
            "sheet_name": recoded_sheet,
        }
    )


def split_codes(df: DataFrame, del_col: str = "clave_delegacion", sub_col: str = "clave_subdelegacion") -> DataFrame:
    """Composite text codes → numbers: delegation = characters 1-2,
    subdelegation = characters 3-4; anything non-numeric becomes NULL."""
    d = F.substring(F.col(del_col).cast("string"), 1, 2)
    s = F.substring(F.col(sub_col).cast("string"), 3, 2)
    return df.withColumns(
        {del_col: F.nullif(d, F.lit("")).try_cast("int"), sub_col: F.nullif(s, F.lit("")).try_cast("int")}
    )
