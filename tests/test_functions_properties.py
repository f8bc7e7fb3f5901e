"""Scalar functions against plain-Python models (hypothesis).

Each property draws a whole list of inputs and evaluates it in one Spark
job, so the test cost stays a few jobs however many examples are drawn.
"""

import datetime as dt
from collections import Counter

import regex
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from panelkit.functions import (
    excel_serial_to_date,
    member_key,
    reference_month,
    sentence_case,
    squish,
)
from panelkit.operators.explore import parse_member_keys

SETTINGS = settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))


def py_reference_month(d: dt.date) -> dt.date:
    first = d.replace(day=1)
    back = 1 if d.day >= 5 else 2
    y, m = divmod(first.year * 12 + first.month - 1 - back, 12)
    return dt.date(y, m + 1, 1)


@SETTINGS
@given(st.lists(st.dates(min_value=dt.date(1901, 1, 1), max_value=dt.date(2199, 12, 31)), min_size=1, max_size=200))
def test_reference_month_model(spark, days):
    df = spark.createDataFrame([(d,) for d in days], "d date").select("d", reference_month("d").alias("m"))
    for r in df.collect():
        assert r.m == py_reference_month(r.d)


@SETTINGS
@given(st.lists(st.integers(min_value=1, max_value=2_900_000), min_size=1, max_size=200))
def test_excel_serial_model(spark, serials):
    df = spark.createDataFrame([(str(s),) for s in serials], "s string").select("s", excel_serial_to_date("s").alias("d"))
    for r in df.collect():
        assert r.d == dt.date(1899, 12, 30) + dt.timedelta(days=int(r.s))


TEXT = st.text(alphabet=st.sampled_from(list("abcXYZ ñÁé\t\n 019.?!")), max_size=30)


def py_sentence_case(t: str) -> str:
    marked = regex.sub(r"([?!] +)", "\\1\x01", t)
    marked = regex.sub(r"(\. +)([^\p{L}]*\p{Lu})", "\\1\x01\\2", marked)
    out = []
    for part in marked.split("\x01"):
        m = regex.match(r"(?s)^([^\p{L}]*)(\p{L})(.*)$", part)
        out.append(m.group(1) + m.group(2).upper() + m.group(3).lower() if m else part.lower())
    return "".join(out)


def test_sentence_case_examples(spark):
    cases = {
        "PATRONES POR RANGO": "Patrones por rango",
        "10 modalidad": "10 Modalidad",
        "MODALIDAD 10. TRABAJADORES PERMANENTES": "Modalidad 10. Trabajadores permanentes",
        "modalidad 10. trabajadores": "Modalidad 10. trabajadores",
        "sector 10.1 total": "Sector 10.1 total",
        "¿qué? sí": "¿Qué? Sí",
    }
    df = spark.createDataFrame([(k,) for k in cases], "t string").select("t", sentence_case("t").alias("sc"))
    assert {r.t: r.sc for r in df.collect()} == cases


@SETTINGS
@given(st.lists(TEXT, min_size=1, max_size=200))
def test_squish_and_sentence_case_model(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(
        "t", squish("t").alias("sq"), sentence_case("t").alias("sc")
    )
    for r in df.collect():
        assert r.sq == " ".join(r.t.split())
        assert r.sc == py_sentence_case(r.t)


@SETTINGS
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(1, 99)), st.one_of(st.none(), st.integers(1, 99))), min_size=1, max_size=200))
def test_member_key_round_trip(spark, pairs):
    df = spark.createDataFrame(pairs, "d int, s int").select("d", "s", member_key("d", "s").alias("member_key"))
    parsed = parse_member_keys(df.select("member_key")).collect()
    got = Counter((r.clave_delegacion, r.clave_subdelegacion) for r in parsed)
    assert got == Counter(pairs)
