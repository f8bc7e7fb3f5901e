"""Hand-made unit rows, one per trap."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from panelkit.functions import excel_serial_to_date, member_label, normalize_code, reference_month, size_label
from panelkit.operators.explore import parse_member_keys
from panelkit.operators.micro import clean_counts
from panelkit.operators.panel import build_panel, family_table
from panelkit.sources.register import code_dictionary

D = dt.date(2020, 1, 1)
CUBE = (
    "date date, ta int, cve_del_final int, cve_subdel_final int, mod string, tipotrc string, "
    "div_final int, size_cierre string, asegurados bigint, salario double, patrones bigint"
)


def cube(spark, rows):
    return clean_counts(spark.createDataFrame(rows, CUBE))


def test_all_null_employers_sum_to_zero(spark):
    c = cube(spark, [(D, 1, 1, 1, "10", "1", 1, "S1", 3, 10.0, None), (D, 1, 1, 1, "10", "1", 2, "S1", 4, 10.0, None)])
    out = family_table(c, code_dictionary(spark), "employers_size").collect()
    assert [(r.sheet_name, r.value) for r in out] == [("Un trabajador", 0.0)]


def test_weighted_mean_skips_null_wage(spark):
    rows = [
        (D, 1, 1, 1, "10", "1", 1, "S1", 2, 100.0, 1),
        (D, 1, 1, 1, "10", "1", 2, "S1", 5, None, 1),
        (D, 1, 1, 1, "10", "1", 3, "S1", 1, 40.0, 1),
    ]
    p = build_panel(cube(spark, rows), code_dictionary(spark)).where("series = 'Salario'")
    vals = {(r.level, r.clave_delegacion, r.clave_subdelegacion): r.value for r in p.collect()}
    assert vals[("Subdelegación", 1, 1)] == pytest.approx(80.0)
    assert vals[("Delegación", 1, None)] == pytest.approx(80.0)
    assert vals[("Delegación", 99, None)] == pytest.approx(80.0)
    assert vals[("Subdelegación", 99, 99)] == pytest.approx(80.0)


def test_zero_weight_wage_dropped_below_national_kept_at_national(spark):
    p = build_panel(cube(spark, [(D, 1, 1, 1, "10", "1", 1, "S1", 0, 100.0, 1)]), code_dictionary(spark))
    wage = p.where("series = 'Salario'").collect()
    assert sorted((r.level, r.clave_delegacion, r.value) for r in wage) == [
        ("Delegación", 99, None),
        ("Subdelegación", 99, None),
    ]


def test_null_worker_type_drops_insured_modality_only(spark):
    p = build_panel(cube(spark, [(D, 1, 1, 1, "10", None, 1, "S1", 5, 10.0, 1)]), code_dictionary(spark))
    sheets = {r.sheet_name for r in p.where("level = 'Subdelegación' AND clave_delegacion = 1").collect()}
    assert "Modalidad 10.1" not in sheets and "Salario 10.1" not in sheets
    assert "Patrones modalidad 10" in sheets and "Sector 1" in sheets


def test_modality_collapse_and_inactive_rows(spark):
    c = cube(spark, [(D, 1, 1, 1, "32", "2", 1, "S1", 5, 10.0, 1), (D, 2, 1, 1, "32", "1", 1, "S1", 7, 10.0, 1)])
    assert {r.cve_modalidad for r in c.collect()} == {"32.1"}
    p = build_panel(c, code_dictionary(spark)).where("sheet_name = 'Modalidad 32' AND level = 'Subdelegación'")
    assert [r.value for r in p.collect() if r.clave_delegacion == 1] == [5.0]


def test_size_labels(spark):
    df = spark.createDataFrame([("NA",), (None,), ("S1",)], "s string").select(size_label("s").alias("x"))
    assert [r.x for r in df.collect()] == [None, None, "s1"]


def test_null_size_matches_null_dictionary_code(spark):
    p = build_panel(cube(spark, [(D, 1, 1, 1, "10", "1", 1, "NA", 5, 10.0, 2)]), code_dictionary(spark))
    assert {r.value for r in p.where("sheet_name = 'Sin rango'").collect()} == {2.0}


def test_reference_month(spark):
    days = [dt.date(2025, 3, 31), dt.date(2025, 1, 4), dt.date(2025, 1, 5)]
    df = spark.createDataFrame([(d,) for d in days], "d date").select(reference_month("d").alias("m"))
    assert [r.m for r in df.collect()] == [dt.date(2025, 2, 1), dt.date(2024, 11, 1), dt.date(2024, 12, 1)]


def test_excel_serial(spark):
    df = spark.createDataFrame([("43466",), ("9x",), ("34700",)], "s string").select(excel_serial_to_date("s").alias("d"))
    assert [r.d for r in df.collect()] == [dt.date(2019, 1, 1), None, dt.date(1995, 1, 1)]


def test_normalize_code(spark):
    codes = ["10.100000000000001", "10.1", "s1", "1234567", "largo texto", None, "1000.10", "12345678"]
    df = spark.createDataFrame([(c,) for c in codes], "c string").select(normalize_code("c").alias("n"))
    assert [r.n for r in df.collect()] == ["10.1", "10.1", "s1", "1234567", None, None, "1000.1", "12345678"]


def test_member_keys_and_labels(spark):
    keys = spark.createDataFrame([("1_1",), ("2_NA",), ("3",), ("99_99",), ("x_1",)], "member_key string")
    got = {r.member_key: (r.clave_delegacion, r.clave_subdelegacion) for r in parse_member_keys(keys).collect()}
    assert got == {"1_1": (1, 1), "2_NA": (2, None), "3": (3, None), "99_99": (99, 99), "x_1": (None, 1)}
    lab = spark.createDataFrame(
        [(1, 6, "AFRICA", "KENYA"), (2, None, "AMERICA", None), (123, None, None, "")],
        "d int, s int, dn string, sn string",
    ).select(member_label("d", "s", "dn", "sn").alias("l"))
    assert [r.l for r in lab.collect()] == ["01-006 | AFRICA - KENYA", "02 | AMERICA", "123 | NA"]


def test_concat_propagates_null(spark):
    from panelkit.functions import modality_code

    df = spark.createDataFrame([("10", None), ("14", None), ("10", "2")], "m string, t string")
    assert [r.c for r in df.select(modality_code("m", "t").alias("c")).collect()] == [None, "14.1", "10.2"]


def test_sentence_case_and_squish(spark):
    from panelkit.functions import sentence_case, squish

    df = spark.createDataFrame([("  PATRONES   por  RANGO ",)], "s string")
    r = df.select(sentence_case(squish("s")).alias("x")).first()
    assert r.x == "Patrones por rango"


def test_null_safe_semi_join_keeps_delegation_rows(spark):
    from panelkit.operators.explore import series_slice

    panel = spark.createDataFrame(
        [("Asegurados", "Delegación", "Modalidad", "M", 2, "B", None, None, D, 5.0)],
        "series string, level string, disaggregation string, sheet_name string, clave_delegacion int, "
        "delegacion string, clave_subdelegacion int, subdelegacion string, date date, value double",
    )
    keys = spark.createDataFrame([("2_NA",)], "member_key string")
    out = series_slice(panel, "Asegurados", "Delegación", "Modalidad", "M", keys).collect()
    assert len(out) == 1 and out[0].grupo == "02 | B"
    assert F is not None


def test_squish_handles_unicode_spaces_and_accents(spark):
    from panelkit.functions import squish, strip_accents

    df = spark.createDataFrame([(" Patrones  por\t rango ", "Población ç ã")], "a string, b string")
    r = df.select(squish("a").alias("a"), strip_accents("b").alias("b")).first()
    assert r.a == "Patrones por rango" and r.b == "Poblacion c a"


def test_duplicate_dictionary_keys_are_refused(spark):
    from panelkit.operators.quality import dictionary_duplicates, require_unique_dictionary

    dic = code_dictionary(spark)
    assert dictionary_duplicates(dic).count() == 0
    require_unique_dictionary(dic)
    dup = dic.unionByName(dic.where("sheet_name_code IS NULL"))
    assert [r.sheet_name_code for r in dictionary_duplicates(dup).collect()] == [None]
    with pytest.raises(ValueError):
        require_unique_dictionary(dup)


def test_numeric_codes_print_like_integers(spark):
    from panelkit.functions import code_text, modality_code

    df = spark.createDataFrame([(10.0, 2.0, 3.0), (32.0, 1.0, None)], "m double, t double, d double")
    rows = df.select(modality_code("m", "t").alias("c"), code_text("d").alias("s")).collect()
    assert [(r.c, r.s) for r in rows] == [("10.2", "3"), ("32.1", None)]


def test_null_geography_codes_are_groups_not_rollups(spark):
    rows = [(D, 1, None, None, "10", "1", 1, "S1", 4, 10.0, 1), (D, 1, 2, 3, "10", "1", 1, "S1", 6, 20.0, 1)]
    p = build_panel(cube(spark, rows), code_dictionary(spark)).where("sheet_name = 'Modalidad 10.1'")
    got = sorted(
        ((r.level, r.clave_delegacion, r.clave_subdelegacion, r.value) for r in p.collect()),
        key=lambda t: (t[0], t[1] is None, t[1] or 0, t[2] is None, t[2] or 0),
    )
    assert got == [
        ("Delegación", 2, None, 6.0),
        ("Delegación", 99, None, 10.0),
        ("Delegación", None, None, 4.0),
        ("Subdelegación", 2, 3, 6.0),
        ("Subdelegación", 99, 99, 10.0),
        ("Subdelegación", None, None, 4.0),
    ]


def test_revision_diff_statuses_with_null_values_and_ids(spark):
    from panelkit.operators.quality import revision_diff

    schema = "book_id int, date date, clave_delegacion int, value double"
    stored = spark.createDataFrame([(None, D, 1, None), (1, D, 2, 5.0), (1, D, 3, 5.0), (1, D, 4, None)], schema)
    new = spark.createDataFrame([(1, D, 2, 9.0), (1, D, 3, 5.5), (1, D, 4, 1.0), (1, D, 5, 1.0)], schema)
    out = revision_diff(new, stored, key=["book_id", "date", "clave_delegacion"])
    got = {r.clave_delegacion: r.status for r in out.collect()}
    assert got == {1: "missing_new", 2: "changed", 4: "stored_null", 5: "missing_stored"}


def test_unparsable_dictionary_codes_are_reported_and_match_nothing(spark):
    from panelkit.sources.register import repaired_dictionary, unparsable_codes

    raw = spark.createDataFrame([("mas de 1000", "Mas de 1000"), ("10.100000000000001", "M 10.1"), (None, "Sin rango"), ("14", "M 14")], "sheet_name_code string, sheet_name string")
    assert [r.sheet_name for r in unparsable_codes(raw).collect()] == ["Mas de 1000"]
    assert {(r.sheet_name_code, r.sheet_name) for r in repaired_dictionary(raw).collect()} == {("10.1", "M 10.1"), (None, "Sin rango"), ("14", "M 14")}
