"""The month-addressable store: revisions, probes, digests; and the cube store."""

import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from panelkit.operators import digests as D
from panelkit.operators.cube_state import cube_state, finished_cube, merge_states
from panelkit.operators.ids import assign_series_ids, label_ids
from panelkit.operators.micro import microdata_counts
from panelkit.operators.quality import revision_diff
from panelkit.plans.monthly import replace_month, stored_revision_diff, update_store
from panelkit.registry.common import panel_geo
from panelkit.session import cut_lineage, scratch_path
from panelkit.sources import cube_store as C
from panelkit.sources import store as S
from panelkit.sources.register import micro_register

MONTHS = 36


@pytest.fixture(scope="module")
def months(spark):
    """The panel's last 37 months of one family, and the months themselves."""
    p = panel_geo(spark, SF_SMALL).where("series = 'Patrones'")
    last = [r[0] for r in p.select("date").distinct().orderBy(F.desc("date")).limit(MONTHS + 1).collect()]
    return cut_lineage(p.where(F.col("date") >= F.lit(last[-1]))), sorted(last)


def fresh(spark, df):
    path = scratch_path(spark, "month-store")
    S.reset_panel(assign_series_ids(df, label_ids(df)), path)
    return path


def local(path):
    return path.removeprefix("file://")


def files_of(path):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{local(path)}/date=*/*.parquet")}


def spoil_other_months(path, month):
    """Overwrite every file of the other months, so that reading one fails."""
    for f in glob.glob(f"{local(path)}/date=*/*.parquet"):
        if f"date={month}" not in f:
            with open(f, "r+b") as out:
                out.write(b"spoilt" * 20)


def rows(df):
    cols = sorted(c for c in df.columns if c not in ("book_id", "sheet_id"))
    return sorted((tuple(str(r[c]) for c in cols) for r in df.select(cols).collect()))


def test_update_and_replace_touch_one_month(spark, months):
    panel, dates = months
    path = fresh(spark, panel.where(F.col("date") < F.lit(dates[-1])))
    assert len(glob.glob(f"{local(path)}/date=*")) == MONTHS
    spoil_other_months(path, "none")
    before = files_of(path)
    new = panel.where(F.col("date") == F.lit(dates[-1]))
    update_store(spark, path, new)
    after = files_of(path)
    assert {f: after[f] for f in before} == before and all(f"date={dates[-1]}" in f for f in set(after) - set(before))
    replace_month(spark, path, new.withColumn("value", F.col("value") + 1))
    again = files_of(path)
    assert {f: again[f] for f in before} == before
    held = S.read_panel(spark, path).where(F.col("date") == F.lit(dates[-1]))
    assert rows(held.drop("book_id", "sheet_id")) == rows(new.withColumn("value", F.col("value") + 1))
    with pytest.raises(ValueError, match="already in the store|continuity"):
        update_store(spark, path, new)


def test_replace_numbers_new_series_and_loses_no_row(spark, months):
    """A revision with unknown labels gets ids; another month's revision leaves its rows alone."""
    panel, dates = months
    panel = panel.where(F.col("date") >= F.lit(dates[-3]))
    path = fresh(spark, panel)
    for k, month in enumerate(dates[-2:]):
        extra = panel.where(F.col("date") == F.lit(month)).limit(1).withColumn("sheet_name", F.lit(f"new {k}")).withColumn("value", F.lit(5.0 + k))
        replace_month(spark, path, panel.where(F.col("date") == F.lit(month)).unionByName(extra))
    got = S.read_panel(spark, path)
    assert sorted((r.value, r.date) for r in got.where("sheet_name like 'new%'").collect()) == [(5.0, dates[-2]), (6.0, dates[-1])]
    assert got.where("book_id is null or sheet_id is null").isEmpty() and got.count() == panel.count() + 2
    assert S.store_ids(spark, path).where("sheet_name like 'new%'").count() == 2
    assert {r[0] for r in S.store_months(spark, path).collect()} == set(dates[-3:])


def test_replace_drops_series_and_null_names_match(spark, months):
    panel, dates = months
    panel = panel.where(F.col("date") >= F.lit(dates[-2]))
    name = panel.where(F.col("date") == F.lit(dates[-1])).agg(F.min("sheet_name")).first()[0]
    panel = panel.withColumn("sheet_name", F.when(F.col("sheet_name") != name, F.col("sheet_name")))
    path = fresh(spark, panel)
    revised = panel.where((F.col("date") == F.lit(dates[-1])) & F.col("sheet_name").isNull())
    replace_month(spark, path, revised)
    held = S.read_panel(spark, path)
    assert rows(held.where(F.col("date") == F.lit(dates[-1]))) == rows(revised)
    assert held.where(F.col("date") == F.lit(dates[-2])).count() == panel.where(F.col("date") == F.lit(dates[-2])).count()


def test_replace_refuses_unknown_months_and_no_rows(spark, months):
    panel, dates = months
    path = fresh(spark, panel.where(F.col("date") < F.lit(dates[-1])))
    before = files_of(path)
    with pytest.raises(ValueError, match="lacks months"):
        replace_month(spark, path, panel.where(F.col("date") == F.lit(dates[-1])))
    with pytest.raises(ValueError, match="no rows"):
        replace_month(spark, path, panel.limit(0))
    with pytest.raises(ValueError, match="without ids"):
        S.overwrite_months(panel.withColumn("book_id", F.lit(None).cast("int")).withColumn("sheet_id", F.lit(1)), path)
    assert files_of(path) == before


def test_digests_follow_every_write(spark, months):
    panel, dates = months
    path = fresh(spark, panel.where(F.col("date") < F.lit(dates[-1])))
    new = panel.where(F.col("date") == F.lit(dates[-1]))
    update_store(spark, path, new)
    replace_month(spark, path, new.withColumn("value", F.col("value") * 2))
    kept = sorted(map(str, S.store_digests(spark, path).select(D.DIGESTS.names).collect()))
    assert kept == sorted(map(str, D.block_digests(S.read_panel(spark, path)).select(D.DIGESTS.names).collect()))
    backup = path + "_copy"
    S.backup_store(spark, path, backup)
    assert sorted(map(str, S.store_digests(spark, backup).select(D.DIGESTS.names).collect())) == kept


def test_revision_check_reads_differing_months_only(spark, months):
    panel, dates = months
    path = fresh(spark, panel)
    hit = (F.col("date") == F.lit(dates[5])) & (F.col("sheet_name") == "Un trabajador")
    new = cut_lineage(panel.withColumn("value", F.when(hit, F.col("value") + 3).otherwise(F.col("value"))))
    want = rows(revision_diff(new, panel))
    spoil_other_months(path, dates[5])
    blocks = D.differing_blocks(D.block_digests(new), S.store_digests(spark, path)).collect()
    assert blocks and {(r.date, r.sheet_name) for r in blocks} == {(dates[5], "Un trabajador")}
    assert rows(stored_revision_diff(spark, path, new)) == want and want
    assert stored_revision_diff(spark, path, panel).collect() == []


def test_blocks_of_one_side_null_values_and_zero_signs(spark):
    d = [dt.date(2000, m, 1) for m in (1, 2, 3)]
    cols = "date date, level string, series string, disaggregation string, sheet_name string, book_name string, clave_delegacion int, value double"
    def frame(data):
        return cut_lineage(spark.createDataFrame([(day, "L", "S", "D", s, None, k, v) for day, s, k, v in data], cols))
    new = frame([(d[0], "a", 1, 0.0), (d[0], "b", None, 2.0), (d[0], "c", 1, None), (d[1], "a", 1, 9.0), (d[0], "e", 1, 1.0), (d[0], "e", 2, 2.0)])
    old = frame([(d[0], "a", 1, -0.0), (d[0], "x", None, 2.0), (d[0], "c", 1, None), (d[2], "a", 1, 9.0), (d[0], "e", 2, 1.0), (d[0], "e", 1, 2.0)])
    blocks = cut_lineage(D.differing_blocks(D.block_digests(new), D.block_digests(old)))
    assert sorted(r.sheet_name for r in blocks.collect()) == ["b", "c", "e", "x"]
    for tol in (0.5, 1.0):
        assert rows(D.revision_diff_of_blocks(new, old, blocks, tol=tol)) == rows(revision_diff(new, old, tol))


def test_cube_states_merge_to_the_cube_of_all_records(spark):
    micro = cut_lineage(micro_register(spark, SF_SMALL))
    thirds = [micro.where(F.pmod(F.xxhash64("*"), F.lit(3)) == k) for k in range(3)]
    states = [cube_state(t) for t in thirds]
    merged = finished_cube(merge_states(merge_states(states[0].unionByName(states[1])).unionByName(states[2])))
    whole = finished_cube(cube_state(micro))
    assert rows(merged) == rows(whole)
    rounded = [df.withColumn("salario", F.round("salario", 6)) for df in (whole, microdata_counts(micro))]
    assert rows(rounded[0]) == rows(rounded[1])


def test_late_records_touch_their_months_only_and_repeat_safely(spark):
    micro = cut_lineage(micro_register(spark, SF_SMALL))
    days = [r[0] for r in micro.select("date").distinct().orderBy("date").limit(4).collect()]
    micro = micro.where(F.col("date").isin(days))
    late = micro.where((F.col("date") == F.lit(days[1])) & (F.col("ta") == 1))
    path = scratch_path(spark, "cube")
    C.add_records(micro.exceptAll(late), path, "extract")
    before = files_of_cube(path)
    for _ in range(2):
        C.add_records(late, path, "late")
    after = files_of_cube(path)
    assert {f: after[f] for f in before} == before and all(f"date={days[1]}/batch=late" in f for f in set(after) - set(before))
    assert rows(C.read_cube(spark, path)) == rows(finished_cube(cube_state(micro)))
    assert {r.date for r in C.read_cube(spark, path, days[:2]).select("date").distinct().collect()} == set(days[:2])
    dest = scratch_path(spark, "cube-compact")
    C.compact_cube(spark, path, dest)
    assert rows(C.read_cube(spark, dest)) == rows(C.read_cube(spark, path)) and not glob.glob(f"{local(dest)}/date=*/batch=late")
    with pytest.raises(ValueError, match="named by"):
        C.add_records(late, path, "../x")


def test_choice_lists_follow_updates_and_revisions(spark, months):
    """Lists, bounds and statistics from the label table equal those of the panel, also where a revision drops and adds series."""
    from panelkit.operators import explore as X
    from panelkit.operators import quality as Q
    from panelkit.plans.explorer import open_labels

    panel, dates = months
    panel = panel.where(F.col("date") >= F.lit(dates[-4]))
    path = fresh(spark, panel.where(F.col("date") < F.lit(dates[-1])))
    new = panel.where(F.col("date") == F.lit(dates[-1]))
    update_store(spark, path, new)
    name = new.agg(F.min("sheet_name")).first()[0]
    revised = new.withColumn("sheet_name", F.when(F.col("sheet_name") == name, F.lit("renamed")).otherwise(F.col("sheet_name")))
    replace_month(spark, path, revised.where("disaggregation <> 'Modalidad' or sheet_name = 'renamed'"))
    stored, labels = S.read_panel(spark, path), open_labels(spark, path)
    for f in (X.list_series, X.list_levels, X.list_concepts, X.list_sheets, X.date_bounds, Q.panel_coverage, Q.panel_labels):
        assert rows(f(labels)) == rows(f(stored)), f.__name__
    assert Q.panel_stats(labels, "n_rows").collect() == Q.panel_stats(stored).collect()


@pytest.mark.parametrize("key", ["list_series", "list_levels", "list_concepts", "list_sheets", "date_bounds", "panel_stats", "panel_coverage", "panel_labels"])
def test_list_keys_read_the_label_table_only(spark, key):
    from panelkit.registry.all import all_queries

    plan = all_queries()[key](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().collectLeaves()
    roots = [str(plan.apply(i).relation().location().rootPaths().apply(0)) for i in range(plan.size())]
    assert roots and all(r.endswith("_digests") for r in roots)


def files_of_cube(path):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{local(path)}/date=*/batch=*/*.parquet")}
