"""Shuffle budget of the operators on top of the panel (plan regression).

Counts hash exchanges an operator adds to its input's plan; windows and the
aggregates after them share one partitioning where the keys allow it.
"""

import pytest

from conftest import SF_SMALL
from panelkit.operators import analytics as A
from panelkit.operators import quality as Q
from panelkit.registry.common import panel
from panelkit.registry.quality import OUTLIER_KEY
from panelkit.session import cut_lineage


def _exchanges(df) -> int:
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


@pytest.fixture(scope="module")
def base(spark):
    return panel(spark, SF_SMALL)


@pytest.mark.parametrize(
    "op, budget",
    [
        (A.changes, 1),
        (A.anomalies, 1),
        (A.summary, 1),
        (A.seasonal_profile, 1),
        (Q.control_totals, 1),
        (lambda p: Q.range_outliers(p, OUTLIER_KEY), 1),
    ],
)
def test_operator_shuffle_budget(base, op, budget):
    assert _exchanges(op(base)) - _exchanges(base) == budget


def test_aggregations_combine_map_side_before_the_shuffle(spark):
    """A hot cell (a third of the register in one key) costs one partial row
    per task before the exchange: both aggregation shuffles of the flagship
    sit on top of partial aggregates."""
    plan = panel(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    checked = 0
    for i, ln in enumerate(lines):
        if "Exchange hashpartitioning" in ln:
            below = " ".join(lines[i + 1 : i + 3])
            assert "partial_" in below, below
            checked += 1
    assert checked == 2


def test_correlation_reference_is_aggregated_map_side(base):
    plan = A.series_correlation(base)._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum(value" in plan and "Window" not in plan


def test_date_repair_does_not_shuffle_by_entity(spark):
    from panelkit.operators import books as B
    from panelkit.plans import history as H
    from panelkit.registry.common import panel_geo
    from panelkit.registry import published_books as S

    p = cut_lineage(panel_geo(spark, SF_SMALL))
    long = cut_lineage(B.unpivot_sheets(S.landed_sheets(p, S.published_sheets(p)), H.SHEET, drop_missing=False))
    plan = B.repair_dates(long, H.SHEET)._jdf.queryExecution().executedPlan().toString()
    exchanges = [ln for ln in plan.splitlines() if "Exchange hashpartitioning" in ln]
    assert "Window" not in plan and all("clave_" not in ln for ln in exchanges)


def test_store_slice_pushes_predicates_and_prunes_columns(spark):
    from panelkit.operators.ids import assign_series_ids, label_ids
    from panelkit.plans import explorer as ex
    from panelkit.registry.store import split_history
    from panelkit.session import scratch_path
    from panelkit.sources.store import reset_panel

    hist, _, _ = split_history(spark, SF_SMALL)
    path = scratch_path(spark, "plan-store")
    reset_panel(assign_series_ids(hist, label_ids(hist)), path)
    p = ex.open_panel(spark, path)
    keys = ex.member_choices(p, "Asegurados", "Delegación").select("member_key")
    s = ex.prepared_data(p, "Asegurados", "Delegación", "Modalidad", "Modalidad 10.1", keys, None, None)
    text = s._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    assert "EqualTo(series,Asegurados)" in text and "EqualTo(sheet_name,Modalidad 10.1)" in text
    schemas = [ln for ln in text.splitlines() if ln.strip().startswith("ReadSchema:")]
    assert schemas and all("book_name" not in ln for ln in schemas)


def test_two_level_slice_aggregates_the_panel_once(spark):
    from panelkit.registry.common import panel_geo
    from panelkit.registry.explore import slices

    one_panel = _exchanges(panel_geo(spark, SF_SMALL))
    sliced = _exchanges(slices(spark, SF_SMALL))
    # The panel's exchanges appear once, plus the small member-key distinct.
    assert sliced <= one_panel + 2, (one_panel, sliced)


def test_explorer_keys_read_the_store_only(spark):
    from panelkit.registry.explore import slices

    text = slices(spark, SF_SMALL)._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "lineitem" not in text and "prepared-store" in text
    assert "EqualTo(series,Asegurados)" in text and "PartitionFilters: [isnotnull(date" in text
    schemas = [ln for ln in text.splitlines() if ln.strip().startswith("ReadSchema:")]
    assert schemas and all("book_name" not in ln for ln in schemas)
