"""Every registered query against its DuckDB oracle (SURVEY §5 (a))."""

import pytest

import __spark_entry__ as E
from panelkit.registry.all import all_oracle, all_queries
from panelkit.registry.compare import compare, duck

from conftest import SF_ORACLE

KEYS = sorted(all_queries())  # the optional corpus operators have tests of their own
SQL = all_oracle()


@pytest.fixture(scope="module")
def con():
    return duck(SF_ORACLE)


def test_every_query_has_an_oracle():
    assert set(SQL) <= set(KEYS)
    assert sorted(set(KEYS) - set(SQL)) == []


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    assert key in E.queries() and key in E.oracle_sql()
    df = E.queries()[key](spark, SF_ORACLE)
    srows = [tuple(r) for r in df.collect()]
    cur = con.execute(SQL[key])
    drows = cur.fetchall()
    msgs = compare(df.columns, srows, [d[0] for d in cur.description], drows)
    assert not msgs, msgs


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() == 7324
    assert [(f.name, f.dataType.simpleString()) for f in df.schema.fields] == [
        ("date", "date"), ("level", "string"), ("clave_delegacion", "int"), ("clave_subdelegacion", "int"),
        ("series", "string"), ("disaggregation", "string"), ("sheet_name", "string"), ("book_name", "string"),
        ("value", "double"), ("subdelegacion", "string"), ("delegacion", "string"),
    ]
