"""Analytics across month gaps, and the explorer flow."""

import datetime as dt

import pytest
from conftest import SF_SMALL
from panelkit.operators import analytics as A
from panelkit.operators import explore as X
from panelkit.operators.panel import build_panel, with_geo
from panelkit.plans import explorer as P
from panelkit.registry.common import panel_geo
from panelkit.schema import CODE_DICT, GEO_DICT
from panelkit.registry import published_books as S


def test_previous_month_is_null_across_a_gap(spark):
    rows = [(dt.date(2020, m, 1), float(v)) for m, v in [(1, 10), (2, 12), (4, 20)]] + [(dt.date(2021, 4, 1), 30.0)]
    df = spark.createDataFrame(rows, "date date, value double")
    for c in A.SERIES_KEY:
        df = df.withColumn(c, __import__("pyspark.sql.functions", fromlist=["lit"]).lit("x"))
    got = {r.date: (r.prev_month_value, r.prev_year_value) for r in A.changes(df).collect()}
    assert got[dt.date(2020, 2, 1)] == (10.0, None)
    assert got[dt.date(2020, 4, 1)] == (None, None)
    assert got[dt.date(2021, 4, 1)] == (None, 20.0)


def test_explorer_flow(spark):
    p = panel_geo(spark, SF_SMALL)
    series = P.default_choice(P.series_choices(p), "series")
    assert series == "Asegurados"
    level = P.default_choice(P.level_choices(p, series), "level")
    concept = P.default_choice(P.concept_choices(p, series, level), "disaggregation")
    sheet = P.default_choice(P.sheet_choices(p, series, level, concept), "sheet_name")
    start, end = P.slice_bounds(p, series, level, concept, sheet)
    assert start is not None and start <= end
    keys = P.member_choices(p, series, level).select("member_key")
    lines = P.prepared_data(p, series, level, concept, sheet, keys, start, end)
    total = P.prepared_data(p, series, level, concept, sheet, keys, start, end, aggregate=True)
    assert abs(sum(r.value for r in lines.collect()) - sum(r.value for r in total.collect())) < 1e-6
    wide = P.make_export(lines, "wide")
    assert wide.count() == lines.select("grupo").distinct().count()
    assert P.slice_bounds(p, series, level, concept, "no such sheet") == (None, None)


@pytest.fixture
def shared_sheet(spark):
    """A panel whose dictionary maps the codes 10 and 13 to one sheet: 3 + 5 insured in January, 4 + 7 in February."""
    cells = [(dt.date(2020, 1, 1), "10", 3), (dt.date(2020, 1, 1), "13", 5), (dt.date(2020, 2, 1), "10", 4), (dt.date(2020, 2, 1), "13", 7)]
    clean = spark.createDataFrame(
        [(d, 1, 1, 2, code, n, 1, 100.0 + n, 1, code, "S1") for d, code, n in cells],
        "date date, ta int, clave_delegacion int, clave_subdelegacion int, cve_modalidad string, asegurados long, patrones long, "
        "salario double, div_final int, mod string, size_cierre string",
    )
    dic = [(s, "Modalidad", c, "Modalidad 10", f"{s} libro") for s in ("Asegurados", "Salario") for c in ("10", "13")]
    geo = spark.createDataFrame([(1, "Uno", 2, "Dos")], GEO_DICT)
    panel = with_geo(build_panel(clean, spark.createDataFrame(dic, CODE_DICT)), geo)
    insured, wages = panel.where("series = 'Asegurados'"), panel.where("series = 'Salario'")
    assert insured.where("level = 'Subdelegación' AND clave_delegacion = 1").count() == 4  # two rows a month
    return insured, wages


def test_two_codes_of_one_sheet_are_summed(shared_sheet):
    insured, wages = shared_sheet
    sub = insured.where("level = 'Subdelegación' AND clave_delegacion = 1")
    rows = sorted((r.date.month, r.value, r.prev_month_value) for r in A.changes(sub).collect())
    assert rows == [(1, 8.0, None), (2, 11.0, 8.0)]
    one = A.summary(sub).collect()
    assert [(r.n_months, r.last_value, r.prev_value, r.mean_value) for r in one] == [(2, 11.0, 8.0, 9.5)]
    assert sorted((r.month, r.seasonal_index) for r in A.seasonal_profile(sub).collect()) == [(1, 8 / 9.5), (2, 11 / 9.5)]
    lines = sub.select(*X.SLICE_COLUMNS, X.member_label().alias("grupo"))
    wide = P.make_export(lines, "wide", series="Asegurados").collect()
    assert [(r.m_2020_01, r.m_2020_02) for r in wide] == [(8.0, 11.0)]
    sheet = S.landed_sheets(sub, S.published_sheets(sub)).collect()
    assert len(sheet) == 1 and sorted(v for v in sheet[0] if isinstance(v, float)) == [8.0, 11.0]
    # no series named: nothing is picked or summed
    with pytest.raises(Exception, match="several values"):
        X.to_wide(lines).collect()


def test_two_wages_of_one_cell_raise(shared_sheet):
    _, wages = shared_sheet
    for out in (A.changes(wages), A.anomalies(wages), A.summary(wages), S.landed_sheets(wages, S.published_sheets(wages))):
        with pytest.raises(Exception, match="several values"):
            out.collect()


def test_pair_moments_merge_and_match_numpy(spark):
    import datetime as dt

    import numpy as np

    from panelkit.operators import analytics as A

    rng = np.random.default_rng(2)
    rows = []
    for e in (1, None):
        for m in range(24):
            for s in "abcd":
                if rng.random() < 0.8:
                    value = 7.0 if s == "d" else float(rng.normal() + 1e6)
                    rows.append(("L", e, 1, "Asegurados", "Modalidad", s, dt.date(2000 + m // 12, m % 12 + 1, 1), value if rng.random() < 0.9 else None))
    rows.append((*rows[0][:-1], 5.0))  # a second code of one sheet
    df = spark.createDataFrame(rows, "level string, clave_delegacion int, clave_subdelegacion int, series string, disaggregation string, sheet_name string, date date, value double")
    thirds = [A.pair_moments(df.where(f"month(date) % 3 = {k}")) for k in range(3)]
    merged = A.pair_correlation(A.merge_pair_moments(thirds[0].unionByName(thirds[1]).unionByName(thirds[2]))).collect()
    whole = {tuple(r)[:-1]: r.correlation for r in A.pair_correlation(A.pair_moments(df)).collect()}
    cells = {}
    for *_, e, _one, _s, _d, s, day, v in [(r[0], *r[1:]) for r in rows]:
        if v is not None:
            cells.setdefault((e, s), {}).setdefault(day, []).append(v)
    assert len(whole) == len(merged) == 12
    for r in merged:
        a, b = (cells[r.clave_delegacion, s] for s in (r.sheet_name_a, r.sheet_name_b))
        days = sorted(set(a) & set(b))
        assert r.n_months == len(days)
        if "d" in (r.sheet_name_a, r.sheet_name_b):
            assert r.correlation is None and whole[tuple(r)[:-1]] is None
        else:
            want = np.corrcoef([sum(a[d]) for d in days], [sum(b[d]) for d in days])[0, 1]
            assert abs(whole[tuple(r)[:-1]] - want) < 1e-9 and abs(r.correlation - want) < 1e-3
