"""Invariants of the panel, the update gate and the physical plans."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from panelkit.operators.continuity import continuity_report
from panelkit.operators.ids import assign_series_ids, label_ids
from panelkit.operators.quality import control_totals
from panelkit.plans.monthly import update_store
from panelkit.registry.common import clean, panel, panel_geo
from panelkit.registry.store import split_history
from panelkit.session import scratch_path
from panelkit.sources.store import read_panel, reset_panel

KEY = ["date", "level", "series", "disaggregation", "sheet_name", "clave_delegacion", "clave_subdelegacion"]


def test_panel_key_is_unique(spark):
    p = panel(spark, SF_SMALL)
    assert p.groupBy(*KEY).count().where("count > 1").count() == 0


def test_control_totals_hold(spark):
    ct = control_totals(panel(spark, SF_SMALL))
    assert ct.count() > 0
    assert ct.where(~F.col("ok")).count() == 0


def test_wage_between_group_min_and_max(spark):
    c = clean(spark, SF_SMALL).where("ta = 1 AND salario IS NOT NULL AND asegurados > 0")
    bounds = c.groupBy("date", "clave_delegacion", "clave_subdelegacion", F.col("cve_modalidad").alias("code")).agg(
        F.min("salario").alias("lo"), F.max("salario").alias("hi")
    )
    dic = {"10.1": "Salario 10.1", "10.2": "Salario 10.2", "32.1": "Salario 32"}
    w = panel(spark, SF_SMALL).where("series = 'Salario' AND level = 'Subdelegación' AND clave_delegacion <> 99")
    m = F.create_map(*[x for kv in dic.items() for x in (F.lit(kv[1]), F.lit(kv[0]))])
    j = w.withColumn("code", m[F.col("sheet_name")]).join(bounds, ["date", "clave_delegacion", "clave_subdelegacion", "code"])
    assert j.count() == w.count()
    assert j.where("value < lo - 1e-9 OR value > hi + 1e-9").count() == 0


def test_gate_accepts_next_month_and_refuses_repeat_and_gap(spark):
    hist, new, gap = split_history(spark, SF_SMALL)
    rep = continuity_report(hist, new, "next").first()
    assert rep.accepted and rep.n_new_months == 1
    assert not continuity_report(hist.unionByName(new), new).first().accepted
    assert not continuity_report(gap, new).first().accepted


def test_update_twice_is_refused(spark):
    hist, new, _ = split_history(spark, SF_SMALL)
    ids = label_ids(hist)
    path = scratch_path(spark, "test-store")
    reset_panel(assign_series_ids(hist, ids), path)
    n0 = read_panel(spark, path).count()
    after = update_store(spark, path, new).count()
    assert after == n0 + new.count()
    with pytest.raises(ValueError):
        update_store(spark, path, new)
    assert read_panel(spark, path).count() == after


def test_reset_refuses_to_read_its_own_target(spark):
    hist, _, _ = split_history(spark, SF_SMALL)
    path = scratch_path(spark, "test-store")
    reset_panel(assign_series_ids(hist, label_ids(hist)), path)
    with pytest.raises(ValueError):
        reset_panel(read_panel(spark, path), path)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_flagship_plan_has_two_shuffles_and_pushdown(spark):
    # Fact path: cube aggregation + panel aggregation, nothing else.
    assert _plan(panel(spark, SF_SMALL)).count("Exchange hashpartitioning") == 2
    p = panel_geo(spark, SF_SMALL)
    # The geography names add only the two de-duplications of the tiny
    # dictionary, which is then broadcast.
    plan = _plan(p)
    assert plan.count("Exchange hashpartitioning") == 4, plan
    assert plan.count("BroadcastHashJoin") >= 2
    assert "PushedFilters" in p._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def test_lineitem_scan_is_pruned(spark):
    p = panel(spark, SF_SMALL)
    text = p._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    line = [ln for ln in text.splitlines() if "ReadSchema: struct<l_orderkey" in ln][0]
    assert "l_tax" not in line and "l_shipdate" not in line and "l_suppkey" not in line


def test_fact_rows_shuffled_twice_at_cluster_scale(spark):
    """With no data table small enough to broadcast (the 100 TB case), the
    lineitem-sized rows are shuffled only on orderkey and partkey."""
    old_t = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    old_a = spark.conf.get("spark.sql.adaptive.enabled")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        plan = _plan(panel(spark, SF_SMALL))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old_t)
        spark.conf.set("spark.sql.adaptive.enabled", old_a)
    lines = [ln for ln in plan.splitlines() if "Exchange hashpartitioning(l_" in ln]
    assert len(lines) == 2, lines
    assert any("l_orderkey" in ln for ln in lines) and any("l_partkey" in ln for ln in lines)


def test_lagging_month_table_cannot_cause_a_double_append(spark):
    from panelkit.sources.store import months_path

    hist, new, _ = split_history(spark, SF_SMALL)
    path = scratch_path(spark, "test-store")
    reset_panel(assign_series_ids(hist, label_ids(hist)), path)
    before_months = spark.read.parquet(months_path(path)).collect()
    update_store(spark, path, new)
    # Simulate a run that died after the data append: month table rolled back.
    spark.createDataFrame(before_months, "date date").write.mode("overwrite").parquet(months_path(path))
    n = read_panel(spark, path).count()
    with pytest.raises(ValueError, match="already in the store"):
        update_store(spark, path, new)
    assert read_panel(spark, path).count() == n


def test_empty_new_month_is_refused(spark):
    hist, new, _ = split_history(spark, SF_SMALL)
    path = scratch_path(spark, "test-store")
    reset_panel(assign_series_ids(hist, label_ids(hist)), path)
    with pytest.raises(ValueError, match="no rows"):
        update_store(spark, path, new.where(F.lit(False)))
