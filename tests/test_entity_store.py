"""The entity-first copy: slices of one entity, measured at the scan, and their freshness."""

import glob

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from panelkit.operators.ids import assign_series_ids, label_ids
from panelkit.plans.monthly import replace_month, update_store
from panelkit.registry.common import panel_geo
from panelkit.schema import EXPLORER_COLUMNS, LEVEL_DELEGATION, LEVEL_SUBDELEGATION
from panelkit.session import cut_lineage, scratch_path
from panelkit.sources import entity_store as E
from panelkit.sources import store as S


@pytest.fixture(scope="module")
def panel(spark):
    p = cut_lineage(panel_geo(spark, SF_SMALL))
    return p, p.agg(F.max("date")).first()[0]


@pytest.fixture()
def store(spark, panel):
    p, last = panel
    path = scratch_path(spark, "entity-store")
    hist = p.where(F.col("date") < F.lit(last))
    S.reset_panel(assign_series_ids(hist, label_ids(hist)), path)
    return path


def rows(df):
    return sorted(tuple(map(str, r)) for r in df.select(*EXPLORER_COLUMNS).collect())


def of(df, level, d, s):
    sub = F.col("clave_subdelegacion")
    return df.where((F.col("level") == level) & (F.col("clave_delegacion") == d) & (sub.isNull() if s is None else sub == s))


def scanned(df):
    """Rows that the file scans of an executed query gave."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    out = 0
    for i in range(leaves.size()):
        plan = leaves.apply(i)
        inner = plan.executedPlan().collectLeaves() if hasattr(plan, "executedPlan") and "Adaptive" in plan.getClass().getSimpleName() else None
        for leaf in [plan] if inner is None else [inner.apply(j) for j in range(inner.size())]:
            metric = leaf.metrics().get("numOutputRows")
            out += metric.get().value() if metric.isDefined() else 0
    return out


def entities(df):
    return [tuple(r) for r in df.select("level", "clave_delegacion", "clave_subdelegacion").distinct().where("clave_delegacion IS NOT NULL").collect()]


def test_slices_equal_the_store_and_read_less(spark, panel, store):
    whole = S.read_panel(spark, store)
    years = E.refresh_entities(spark, store, row_group_bytes=16_384)
    assert len(years) == whole.select(F.year("date")).distinct().count()
    assert E.stale_years(spark, store) == [] and E.refresh_entities(spark, store) == []
    for level, d, s in sorted(entities(whole), key=str)[::9]:
        assert rows(E.entity_slice(spark, store, level, d, s)) == rows(of(whole, level, d, s))
    level, d, s = max(e for e in entities(whole) if e[0] == LEVEL_SUBDELEGATION)
    copy, direct = E.entity_slice(spark, store, level, d, s), of(whole, level, d, s).select(*EXPLORER_COLUMNS)
    few, all_rows = scanned(copy), scanned(direct)
    print(f"rows read for one entity: {few} from the copy, {all_rows} from the store")
    assert few < all_rows / 2
    plan = spark._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(copy._jdf.queryExecution(), "formatted")
    assert "Exchange" not in plan and "EqualTo(clave_subdelegacion" in plan


def test_slices_follow_updates_and_revisions(spark, panel, store):
    p, last = panel
    E.refresh_entities(spark, store)
    level, d, s = max(e for e in entities(p) if e[0] == LEVEL_DELEGATION)
    new = p.where(F.col("date") == F.lit(last))
    update_store(spark, store, new)
    assert rows(E.entity_slice(spark, store, level, d, s)) == rows(of(p, level, d, s))
    assert E.stale_years(spark, store) == [last.year]
    untouched = set(glob.glob(E.entities_path(store).removeprefix("file://") + f"/year={last.year - 1}/*.parquet"))
    assert E.refresh_entities(spark, store) == [last.year] and untouched
    assert set(glob.glob(E.entities_path(store).removeprefix("file://") + f"/year={last.year - 1}/*.parquet")) == untouched
    revised = p.where(F.col("date") == F.lit(last)).withColumn("value", F.col("value") + 1)
    replace_month(spark, store, revised)
    want = rows(of(p.where(F.col("date") < F.lit(last)).unionByName(revised), level, d, s))
    assert rows(E.entity_slice(spark, store, level, d, s)) == want
    E.refresh_entities(spark, store)
    assert E.stale_years(spark, store) == [] and rows(E.entity_slice(spark, store, level, d, s)) == want


def test_slice_without_a_copy_and_of_an_unknown_entity(spark, panel, store):
    level, d, s = max(e for e in entities(panel[0]) if e[0] == LEVEL_DELEGATION)
    assert rows(E.entity_slice(spark, store, level, d, s)) == rows(of(S.read_panel(spark, store), level, d, s))
    E.refresh_entities(spark, store)
    assert E.entity_slice(spark, store, level, 12345).isEmpty()
