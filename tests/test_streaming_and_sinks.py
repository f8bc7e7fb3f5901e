"""Streaming monthly drop, sinks and file listing."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from panelkit.operators.ids import assign_series_ids, label_ids
from panelkit.plans.monthly import update_store
from panelkit.registry.common import panel_geo
from panelkit.registry.store import split_history
from panelkit.session import scratch_path
from panelkit.sources.books import list_workbooks
from panelkit.sources.register import code_dictionary, geo_dictionary, micro_register
from panelkit.sources.store import backup_store, read_panel, reset_panel
from panelkit.streaming.monthly_drop import run_monthly_drop


def test_stream_appends_once_and_refuses_a_repeated_drop(spark):
    hist, new, _ = split_history(spark, SF_SMALL)
    store = scratch_path(spark, "stream-store")
    reset_panel(assign_series_ids(hist, label_ids(hist)), store)
    last = new.agg(F.max("date")).first()[0]
    drop = scratch_path(spark, "drop")
    month = micro_register(spark, SF_SMALL).where(F.col("date") == F.lit(last))
    month.write.mode("append").parquet(drop)
    dic, geo = code_dictionary(spark), geo_dictionary(spark, SF_SMALL)
    run_monthly_drop(spark, drop, store, dic, geo)
    n = read_panel(spark, store).count()
    assert n == hist.count() + new.count()
    month.write.mode("append").parquet(drop)
    with pytest.raises(Exception):
        run_monthly_drop(spark, drop, store, dic, geo)
    assert read_panel(spark, store).count() == n


def test_replayed_epoch_is_skipped(spark):
    import datetime as dt

    from panelkit.streaming.monthly_drop import _mark, _marked_months

    ck = scratch_path(spark, "epochs")
    assert _marked_months(spark, ck, "applied", 3) == set()
    _mark(spark, ck, "applied", 3, dt.date(2001, 7, 1))
    assert _marked_months(spark, ck, "applied", 3) == {dt.date(2001, 7, 1)} and _marked_months(spark, ck, "applied", 4) == set()


def test_stream_applies_a_two_month_backlog_in_order(spark):
    p = panel_geo(spark, SF_SMALL)
    months = [r[0] for r in p.select("date").distinct().orderBy(F.desc("date")).limit(2).collect()]
    older = p.where(F.col("date") < F.lit(months[1]))
    store = scratch_path(spark, "backlog-store")
    reset_panel(assign_series_ids(older, label_ids(older)), store)
    drop = scratch_path(spark, "drop")
    micro_register(spark, SF_SMALL).where(F.col("date") >= F.lit(months[1])).write.parquet(drop)
    run_monthly_drop(spark, drop, store, code_dictionary(spark), geo_dictionary(spark, SF_SMALL))
    assert read_panel(spark, store).count() == p.count()


def test_backup_copies_the_store(spark):
    hist, _, _ = split_history(spark, SF_SMALL)
    store = scratch_path(spark, "store")
    reset_panel(assign_series_ids(hist, label_ids(hist)), store)
    dest = scratch_path(spark, "backup")
    backup_store(spark, store, dest)
    assert read_panel(spark, dest).count() == read_panel(spark, store).count()


def test_list_workbooks(spark, tmp_path):
    for rel in ["DELEGACIONES/PATRONES/a.xlsx", "SUBDELEGACIONES/SALARIO/b.xlsx", "notes.txt"]:
        p = tmp_path / rel
        os.makedirs(p.parent, exist_ok=True)
        p.write_bytes(b"x")
    paths = sorted(r.path.rsplit("/", 1)[-1] for r in list_workbooks(spark, str(tmp_path)).collect())
    assert paths == ["a.xlsx", "b.xlsx"]


def test_month_partitioned_register_prunes_to_one_month(spark):
    from panelkit.operators.micro import microdata_counts
    from panelkit.sources.register import read_register, write_register

    micro = micro_register(spark, SF_SMALL)
    root = scratch_path(spark, "register")
    write_register(micro, root)
    last = micro.agg(F.max("date")).first()[0]
    one = read_register(spark, root, last)
    text = microdata_counts(one)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in text and "PushedFilters" in text
    assert one.select("date").distinct().count() == 1
    assert microdata_counts(one).count() == microdata_counts(micro.where(F.col("date") == F.lit(last))).count()


def test_monthly_cycle_from_partitioned_register(spark):
    from panelkit.plans.monthly import run_month
    from panelkit.sources.register import read_register, write_register

    hist, new, _ = split_history(spark, SF_SMALL)
    store = scratch_path(spark, "cycle-store")
    reset_panel(assign_series_ids(hist, label_ids(hist)), store)
    root = scratch_path(spark, "register")
    write_register(micro_register(spark, SF_SMALL), root)
    last = new.agg(F.max("date")).first()[0]
    out = run_month(spark, read_register(spark, root, last), code_dictionary(spark), geo_dictionary(spark, SF_SMALL), store, last)
    assert out.count() == hist.count() + new.count()
    got = out.where(F.col("date") == F.lit(last)).groupBy("level").agg(F.sum("value").alias("s")).collect()
    want = new.groupBy("level").agg(F.sum("value").alias("s")).collect()
    assert sorted((r.level, round(r.s, 6)) for r in got) == sorted((r.level, round(r.s, 6)) for r in want)


def test_dictionary_files_round_trip(spark):
    from panelkit.sources.register import read_code_dictionary, read_geo_dictionary

    dic = code_dictionary(spark)
    p = scratch_path(spark, "dict")
    artefact = dic.withColumn(
        "sheet_name_code",
        F.when(F.col("sheet_name_code") == "10.1", F.lit("10.100000000000001")).otherwise(F.col("sheet_name_code")),
    )
    artefact.write.option("header", True).csv(p)
    back = read_code_dictionary(spark, p)
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, dic.collect()), key=str)

    geo = geo_dictionary(spark, SF_SMALL)
    g = scratch_path(spark, "geo")
    geo.toDF("Clave", "Delegación", "Clave sub", "Subdelegación").write.option("header", True).csv(g)
    gback = read_geo_dictionary(spark, g)
    assert sorted(map(tuple, gback.collect()), key=str) == sorted(map(tuple, geo.collect()), key=str)


def test_updated_panel_and_display_helpers(spark):
    from panelkit.plans.monthly import updated_panel
    from panelkit.sources.store import display_order, preview, write_table

    hist, new, _ = split_history(spark, SF_SMALL)
    stored = assign_series_ids(hist, label_ids(hist))
    up = updated_panel(stored, new)
    assert up.count() == hist.count() + new.count()
    assert up.where(F.col("book_id").isNull()).count() == 0
    with pytest.raises(ValueError):
        updated_panel(up, new)
    first = display_order(up).first()
    assert (first.book_id, first.sheet_id) == (1, 1)
    assert preview(up).count() == 10
    p = scratch_path(spark, "cube")
    write_table(up.select("date", "value"), p)
    assert spark.read.parquet(p).count() == up.count()


def test_latest_snapshot_from_a_folder(spark, tmp_path):
    from panelkit.operators.snapshot import latest_snapshot, list_snapshots

    for name in ["pafinalmes202501.sas7bdat", "pafinalmes202502.sas7bdat", "pafinalmes202503ant.sas7bdat", "other.txt"]:
        (tmp_path / name).write_bytes(b"x")
    got = [(r.full_periodo, r.periodo) for r in latest_snapshot(list_snapshots(spark, str(tmp_path))).collect()]
    assert got == [("pafinalmes202502.sas7bdat", "pafinalmes202502")]


def _stores(spark):
    hist, new, _ = split_history(spark, SF_SMALL)
    store = scratch_path(spark, "test-store")
    reset_panel(assign_series_ids(hist, label_ids(hist)), store)
    return store, hist, new


def _rows(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


def test_update_without_an_id_table_keeps_all_ids(spark):
    from panelkit.sources import store as S

    store, _, new = _stores(spark)
    known = _rows(S.store_ids(spark, store))
    p = spark._jvm.org.apache.hadoop.fs.Path(S.ids_path(store))
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    update_store(spark, store, new)
    assert S.path_exists(spark, S.ids_path(store)) and set(known) <= set(_rows(S.store_ids(spark, store)))
    assert read_panel(spark, store).where("book_id IS NULL OR sheet_id IS NULL").isEmpty()


def test_only_a_missing_path_counts_as_absent(spark):
    from panelkit.sources import store as S

    store, _, _ = _stores(spark)
    p = spark._jvm.org.apache.hadoop.fs.Path(S.ids_path(store) + "/part-broken.parquet")
    out = p.getFileSystem(spark._jsc.hadoopConfiguration()).create(p)
    out.write(bytearray(b"not parquet"))
    out.close()
    with pytest.raises(Exception, match="(?i)parquet|footer|malformed"):
        S.store_ids(spark, store).collect()


def test_ids_are_stable_when_labels_are_added(spark):
    from panelkit.operators.ids import extend_ids

    schema = "level string, book_name string, sheet_name string"
    old = label_ids(spark.createDataFrame([("L", "B1", "S1"), ("L", "B2", "S2"), (None, "B2", None)], schema))
    more = spark.createDataFrame([("L", "A0", "S0"), ("L", "B1", "S1"), ("L", "B1", "S0"), ("L", None, "S9")], schema)
    ids = {(r.level, r.book_name, r.sheet_name): (r.book_id, r.sheet_id) for r in extend_ids(old, more).collect()}
    before = {(r.level, r.book_name, r.sheet_name): (r.book_id, r.sheet_id) for r in old.collect()}
    assert all(ids[k] == v for k, v in before.items()) and len(ids) == 6
    assert ids[("L", "B1", "S0")][0] == ids[("L", "B1", "S1")][0]
    assert sorted(s for _, s in ids.values()) == [1, 2, 3, 4, 5, 6]


def test_restore_from_a_backup_next_to_the_store(spark):
    store, hist, new = _stores(spark)
    before = _rows(read_panel(spark, store))
    backup_store(spark, store, store + "_backup")
    update_store(spark, store, new)
    reset_panel(read_panel(spark, store + "_backup"), store)
    assert _rows(read_panel(spark, store)) == before


@pytest.mark.parametrize("step", ["append_ids", "append_panel", "append_months", "_mark"])
def test_stream_completes_a_month_after_a_crash(spark, monkeypatch, step):
    from panelkit.plans import monthly as M
    from panelkit.sources.register import code_dictionary, geo_dictionary, micro_register
    from panelkit.sources.store import store_ids, store_months
    from panelkit.streaming import monthly_drop as D

    store, hist, new = _stores(spark)
    expected = _rows(hist.unionByName(new).drop("book_id", "sheet_id"))
    drop, checkpoint = scratch_path(spark, "register-drop"), scratch_path(spark, "stream-checkpoint")
    last = new.agg(F.max("date")).first()[0]
    micro_register(spark, SF_SMALL).where(F.col("date") == F.lit(last)).write.parquet(drop)
    module = D if step == "_mark" else M
    real = getattr(module, step)

    def crash(*a):
        if step != "_mark" or a[2] == "applied":
            if step != "_mark":
                real(*a)  # the step is done, the run dies right after it
            raise RuntimeError("lost driver")
        real(*a)

    monkeypatch.setattr(module, step, crash)
    with pytest.raises(Exception, match="lost driver"):
        D.run_monthly_drop(spark, drop, store, code_dictionary(spark), geo_dictionary(spark, SF_SMALL), checkpoint)
    monkeypatch.setattr(module, step, real)
    D.run_monthly_drop(spark, drop, store, code_dictionary(spark), geo_dictionary(spark, SF_SMALL), checkpoint)
    got = read_panel(spark, store)
    assert _rows(got.drop("book_id", "sheet_id")) == expected
    assert [r[0] for r in store_months(spark, store).where(F.col("date") == F.lit(last)).collect()] == [last]
    assert got.select("book_id", "sheet_id").distinct().count() == store_ids(spark, store).select("book_id", "sheet_id").distinct().count()


def test_months_of_other_dates_are_not_relabelled(spark):
    from panelkit.operators.micro import clean_counts, microdata_counts
    from panelkit.sources.register import micro_register

    cube = microdata_counts(micro_register(spark, SF_SMALL))
    month = cube.agg(F.max("date")).first()[0]
    only = clean_counts(cube, month)
    assert only.agg(F.sum("asegurados")).first()[0] == cube.where(F.col("date") == F.lit(month)).agg(F.sum("asegurados")).first()[0]
