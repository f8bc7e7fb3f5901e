"""Historical rebuild: unpivot ∘ pivot is the identity on values."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from panelkit.operators import books as B
from panelkit.plans import history as H
from panelkit.registry.common import panel_geo
from panelkit.registry import published_books as S
from panelkit.sources.register import geo_dictionary


def test_historical_rebuild_reproduces_panel_values(spark):
    p = panel_geo(spark, SF_SMALL)
    sh = S.published_sheets(p)
    hist = H.historical_panel(
        S.book_catalogue(spark, sh), S.book_index(sh), S.book_tabs(sh), S.landed_sheets(p, sh), geo_dictionary(spark, SF_SMALL)
    )
    key = ["level", "date", "clave_delegacion", "clave_subdelegacion", "disaggregation"]
    a = p.where("value IS NOT NULL").groupBy(*key).agg(F.count("value").alias("n"), F.sum("value").alias("s"))
    b = hist.groupBy(*[F.col(k).alias(f"h_{k}") for k in key]).agg(F.count("value").alias("n2"), F.sum("value").alias("s2"))
    cond = None
    for k in key:
        c = F.col(k).eqNullSafe(F.col(f"h_{k}"))
        cond = c if cond is None else cond & c
    diff = a.join(b, cond, "full_outer").where(
        ~F.coalesce(F.col("n") == F.col("n2"), F.lit(False)) | (F.abs(F.col("s") - F.col("s2")) > 1e-6)
    )
    assert diff.count() == 0
    assert hist.where(F.col("book_id").isNull() | F.col("sheet_id").isNull()).count() == 0


def test_plain_unpivot_loses_bad_header_month_and_repair_restores_it(spark):
    p = panel_geo(spark, SF_SMALL)
    wide = S.landed_sheets(p, S.published_sheets(p))
    plain = B.unpivot_sheets(wide, H.SHEET)
    repaired = H.repaired_long(wide)
    assert repaired.count() == p.where("value IS NOT NULL").count()
    assert plain.count() < repaired.count()
    assert repaired.where(F.col("date").isNull()).count() == 0


def test_level_rule_prefers_subdelegation_folder(spark):
    cat = spark.createDataFrame(
        [("/raw/SUBDELEGACIONES/PATRONES/Patrones por  Rango.xlsx",), ("/raw/DELEGACIONES/PATRONES/x_Subdelegaciones.xlsx",)],
        "path string",
    )
    got = {r.path: (r.level, r.name, r.series, r.disaggregation) for r in B.classify_catalogue(cat).collect()}
    assert got["/raw/SUBDELEGACIONES/PATRONES/Patrones por  Rango.xlsx"] == (
        "Subdelegación", "patrones por rango", "Patrones", "Rango de trabajadores")
    assert got["/raw/DELEGACIONES/PATRONES/x_Subdelegaciones.xlsx"][0] == "Subdelegación"


def test_code_split(spark):
    df = spark.createDataFrame([("01", "0103"), ("99", "01"), ("xx", None)], "clave_delegacion string, clave_subdelegacion string")
    got = [(r.clave_delegacion, r.clave_subdelegacion) for r in B.split_codes(df).collect()]
    assert got == [(1, 3), (99, None), (None, None)]


def test_index_conflict_gate(spark):
    idx = spark.createDataFrame(
        [("b1", "Hoja 1", "Modalidad 10"), ("b2", "Hoja 1", "Sector 1"), ("b2", "Hoja 9", "Sector sin hoja")],
        "path string, hoja string, contenido string",
    )
    tabs = spark.createDataFrame([("b1", 2, "1"), ("b2", 1, "1")], "path string, position int, sheet_name string")
    c = {r.path: r.conflicts for r in B.index_conflicts(B.join_index(B.extract_index(idx), B.sheet_positions(tabs))).collect()}
    assert c == {"b1": 0, "b2": 1}


def test_content_columns_are_chosen_by_their_cells(spark):
    raw = spark.createDataFrame(
        [("b", "1", "Hoja", "Contenido", "x"), ("b", "2", "Hoja 1", "Modalidad 10", None)],
        "path string, a string, b string, c string, d string",
    )
    out = B.select_content_columns(raw)
    assert out.columns == ["path", "hoja", "contenido"]
    got = [(r.hoja, r.contenido) for r in B.extract_index(out).collect()]
    assert got == [(1, "Modalidad 10")]


def test_content_columns_are_chosen_per_book(spark):
    rows = [("b1", "Hoja", "Contenido", "x"), ("b1", "Hoja 1", "Modalidad 10", None), ("b2", "1", "Hoja", "Contenido"), ("b2", "2", "Hoja 2", "Sector 3")]
    raw = spark.createDataFrame(rows, "path string, a string, b string, c string")
    got = sorted((r.path, r.hoja, r.contenido) for r in B.extract_index(B.select_content_columns(raw)).collect())
    assert got == [("b1", 1, "Modalidad 10"), ("b2", 2, "Sector 3")]
    with pytest.raises(ValueError, match="b3"):
        B.select_content_columns(raw.union(spark.createDataFrame([("b3", "Hoja", "nada", "x")], raw.schema)))


def _repaired(spark, rows, headers):
    wide = spark.createDataFrame(rows, "path string, position int, clave_delegacion string, clave_subdelegacion string, " + ", ".join(f"`{h}` string" for h in headers))
    long = B.unpivot_sheets(wide, H.SHEET, drop_missing=False)
    dates = {(r.position, r.clave_delegacion, r.value): str(r.date) for r in B.repair_dates(long, H.SHEET).where("value IS NOT NULL").collect()}
    return dates, {r.position: (r.bad_headers, r.bad_cells, r.anchor_pos) for r in B.bad_date_report(long, H.SHEET).collect()}


def test_a_bad_header_concerns_only_sheets_with_cells_under_it(spark):
    dates, report = _repaired(spark, [("b", 1, "01", None, "1", None, "3"), ("b", 2, "01", None, "4", "5", "6")], ["43831", "x2", "43891"])
    assert dates[(1, "01", 1.0)] == "2020-01-01" and dates[(1, "01", 3.0)] == "2020-03-01"
    assert dates[(2, "01", 5.0)] == "2020-02-01" and report == {2: (1, 1, 1)}


def test_a_bad_first_header_keeps_the_sheet(spark):
    dates, report = _repaired(spark, [("b", 1, "01", None, "1", "2", "3")], ["x1", "43862", "43891"])
    assert [dates[(1, "01", v)] for v in (1.0, 2.0, 3.0)] == ["2020-01-01", "2020-02-01", "2020-03-01"] and report == {1: (1, 1, 2)}


def test_two_rows_of_one_entity_keep_their_months_and_text_cells_become_null(spark):
    dates, report = _repaired(spark, [("b", 1, "01", None, "1", "2", "N/D"), ("b", 1, "01", None, "7", "8", "9")], ["43831", "x2", "43891"])
    assert dates == {(1, "01", 1.0): "2020-01-01", (1, "01", 2.0): "2020-02-01", (1, "01", 7.0): "2020-01-01", (1, "01", 8.0): "2020-02-01", (1, "01", 9.0): "2020-03-01"}


def test_sheet_ordinals_come_from_the_tab_list(spark):
    lists = spark.createDataFrame([("b", ["Contenido", "1", "Notas", "3"])], "path string, tabs array<string>")
    got = [(r.position, r.hoja) for r in B.sheet_positions(B.explode_tabs(lists)).collect()]
    assert got == [(2, 1), (4, 3)]


def test_rows_of_any_layout_are_unpivoted(spark):
    rows = [
        ("a", 1, [("Clave Del", "01"), ("Delegación", "Norte"), ("43831", "1"), ("Notas", "7"), ("43862", "N/D")]),
        ("a", 1, [("Clave Del", "02"), ("Delegación", None), ("43831", "4"), ("Notas", "7"), ("43862", "5")]),
        ("b", 2, [("43891", "9"), (" DELEGACIÓN ", "Sur"), ("CLAVE DEL", "03"), ("43922", None), ("x5", "8")]),
        ("c", 3, []),
        ("d", 4, None),
    ]
    df = spark.createDataFrame(rows, "path string, position int, cells array<struct<header: string, cell: string>>")
    whole = [(r.path, r.clave_delegacion, r.delegacion, r.col_pos, str(r.date), r.value) for r in B.unpivot_rows(df, drop_missing=False).collect()]
    assert sorted(whole, key=str) == sorted([
        ("a", "01", "Norte", 1, "2020-01-01", 1.0), ("a", "01", "Norte", 2, "2020-02-01", None),
        ("a", "02", None, 1, "2020-01-01", 4.0), ("a", "02", None, 2, "2020-02-01", 5.0),
        ("b", "03", "Sur", 1, "2020-03-01", 9.0), ("b", "03", "Sur", 2, "2020-04-01", None), ("b", "03", "Sur", 3, "None", 8.0),
    ], key=str)
    assert {(r.path, r.value) for r in B.unpivot_rows(df).collect()} == {("a", 1.0), ("b", 9.0)}
    assert {(r.path, str(r.date), r.value) for r in H.repaired_long(df).collect()} == {("a", "2020-01-01", 1.0), ("b", "2020-03-01", 9.0), ("b", "2020-05-01", 8.0)}


def test_wide_and_landed_rows_give_the_same_long_table(spark):
    from panelkit.registry import mixed_books as M

    p = panel_geo(spark, SF_SMALL)
    sh = S.published_sheets(p)
    long = H.repaired_long(M.landed_rows(p, sh))
    grid = S.month_grid(p)
    sub, employers = F.col("path").contains(M.SUB_FOLDER), F.col("path").contains(M.EMPLOYER_FOLDER)
    inside = (~sub | (F.col("date") >= F.lit(grid[M.LATE]))) & (~employers | (F.col("date") <= F.lit(grid[-M.EARLY - 1])))
    cols = ["path", "position", *B.SHEET_KEYS, "date", "value"]
    want = H.repaired_long(S.landed_sheets(p, sh)).where(inside).select(cols)
    assert want.exceptAll(long.select(cols)).isEmpty() and long.select(cols).exceptAll(want).isEmpty()
