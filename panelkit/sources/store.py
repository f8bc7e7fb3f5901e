"""The panel store: Parquet with one folder a month, ordered by series inside.

The month is the partition column (``date=2001-07-01``), so an update writes,
a revision replaces and the double-append probe reads one folder, whatever
the history holds.  Inside a month, files are dealt by book and sorted by
(book_id, sheet_id, codes), so that row-group statistics find a series.
A full reset overwrites statically and refuses to read its own target.

Next to the store sit three small tables: its id dimension (``<store>_ids``,
one row per series label with its (book_id, sheet_id)), its month list
(``<store>_months``) and a digest of every series and month
(``<store>_digests``, see ``operators/digests.py``).  Updates, the continuity
gate, name-based slices and revision checks read those instead of scanning the
history.  A side table that was never written is rebuilt from the store; only
a missing path counts as "never written", every other error is raised.
``compact_store`` rewrites the files of several updates of one month.

A month is replaced by one dynamic partition overwrite: the new files are
complete before the old folder goes.  A reader that lists the folder in the
moment of the swap may miss the month; one that has listed it already fails on
the missing files and can run again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.operators.digests import DIGESTS, block_digests
from panelkit.schema import PANEL, PANEL_COLUMNS
from panelkit.session import cut_lineage

PARTITION_COLUMN = "date"
ID_TABLE_COLUMNS = ["book_id", "sheet_id", "book_name", "sheet_name", "level", "series", "disaggregation"]
SORT_COLUMNS = ["book_id", "sheet_id", "clave_delegacion", "clave_subdelegacion"]


def read_panel(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Scan with the declared schema; a projection prunes columns at the scan."""
    df = spark.read.schema(PANEL).parquet(path)
    return df.select(*columns) if columns else df


def ids_path(path: str) -> str:
    return path.rstrip("/") + "_ids"


def _ids_of(df: DataFrame) -> DataFrame:
    return df.select(*ID_TABLE_COLUMNS).distinct()


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists in its file system (any other failure raises)."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def store_ids(spark: SparkSession, path: str) -> DataFrame:
    """The store's id dimension, from the store itself if it was never written."""
    schema = PANEL.__class__([PANEL[c] for c in ID_TABLE_COLUMNS])
    if path_exists(spark, ids_path(path)):
        return spark.read.schema(schema).parquet(ids_path(path))
    return _ids_of(read_panel(spark, path))


def months_path(path: str) -> str:
    return path.rstrip("/") + "_months"


def store_months(spark: SparkSession, path: str) -> DataFrame:
    """Stored months, from the store's date column if the list was never written."""
    if path_exists(spark, months_path(path)):
        return spark.read.schema(PANEL.__class__([PANEL["date"]])).parquet(months_path(path)).distinct()
    return read_panel(spark, path, ["date"]).distinct()


def append_months(df: DataFrame, path: str) -> None:
    """Add the months of ``df`` that the list lacks; write the whole list where there is none."""
    spark = df.sparkSession
    new = df.select("date").distinct()
    if path_exists(spark, months_path(path)):
        new.join(store_months(spark, path), "date", "left_anti").write.mode("append").parquet(months_path(path))
    else:
        cut_lineage(store_months(spark, path).union(new).distinct()).write.parquet(months_path(path))


def append_ids(spark: SparkSession, ids: DataFrame, path: str) -> None:
    """Add the rows of ``ids`` that the id table lacks; write the whole table where there is none.

    An id table without a row, or a row without ids, is refused: later
    updates would lose the ids of known series.
    """
    new, old = ids.select(*ID_TABLE_COLUMNS).distinct(), store_ids(spark, path)
    cond = None
    for c in ID_TABLE_COLUMNS:
        e = new[c].eqNullSafe(old[c])
        cond = e if cond is None else cond & e
    added = cut_lineage(new.join(old, cond, "left_anti"))
    if not added.where(F.col("book_id").isNull() | F.col("sheet_id").isNull()).isEmpty():
        raise ValueError("a series without ids cannot enter the id table")
    if path_exists(spark, ids_path(path)):
        added.write.mode("append").parquet(ids_path(path))
        return
    whole = cut_lineage(old.union(added))
    if whole.isEmpty():
        raise ValueError("an empty id table is refused")
    whole.write.parquet(ids_path(path))


def digests_path(path: str) -> str:
    return path.rstrip("/") + "_digests"


def store_digests(spark: SparkSession, path: str) -> DataFrame:
    """The digest of every stored series and month, from the store itself if the table was never written."""
    if path_exists(spark, digests_path(path)):
        return spark.read.schema(DIGESTS).parquet(digests_path(path))
    return block_digests(read_panel(spark, path))


def _write_digests(df: DataFrame, path: str) -> None:
    """Put the digests of the months of ``df`` in place of what the table holds for them."""
    block_digests(df).repartition(PARTITION_COLUMN).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PARTITION_COLUMN).parquet(digests_path(path))


def _layout(df: DataFrame) -> DataFrame:
    return df.select(*PANEL_COLUMNS).repartition(PARTITION_COLUMN, "book_id").sortWithinPartitions(PARTITION_COLUMN, *SORT_COLUMNS)


def append_panel(df: DataFrame, path: str) -> None:
    """Append whole months (used behind the continuity gate), then their digests."""
    _layout(df).write.mode("append").partitionBy(PARTITION_COLUMN).parquet(path)
    if path_exists(df.sparkSession, digests_path(path)):
        _write_digests(df, path)


def overwrite_months(df: DataFrame, path: str) -> None:
    """Replace the months present in ``df`` (a checkpointed frame) as a whole.

    Rows without ids or month are refused: they would start a folder that no
    later update replaces.  The digests are written first; if a run dies in
    between, running it again gives the same store.
    """
    if not df.where(F.col("book_id").isNull() | F.col("sheet_id").isNull() | F.col("date").isNull()).isEmpty():
        raise ValueError("rows without ids or month cannot replace a month")
    if path_exists(df.sparkSession, digests_path(path)):
        _write_digests(df, path)
    _layout(df).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PARTITION_COLUMN).parquet(path)


def compact_store(spark: SparkSession, path: str) -> None:
    """Rewrite every month's files as few ordered ones; the rows stay the same."""
    _layout(cut_lineage(read_panel(spark, path))).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PARTITION_COLUMN).parquet(path)


def _input_roots(df: DataFrame) -> list[str]:
    """Root folders of the file scans under ``df`` (one per scan, never the files)."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    roots = []
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        if leaf.getClass().getSimpleName() == "LogicalRelation" and hasattr(leaf.relation(), "location"):
            paths = leaf.relation().location().rootPaths()
            roots += [paths.apply(j).toUri().getPath() for j in range(paths.size())]
    return roots


def _reads_from(df: DataFrame, path: str) -> bool:
    target = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path).toUri().getPath().rstrip("/")
    return any(f == target or f.startswith(target + "/") or target.startswith(f + "/") for f in map(lambda r: r.rstrip("/"), _input_roots(df)))


def reset_panel(df: DataFrame, path: str) -> None:
    """Full rebuild: the store becomes exactly ``df`` (static overwrite).

    A static overwrite of a path that the input is still reading deletes the
    data before it is read, so that case is refused.
    """
    if _reads_from(df, path):
        raise ValueError("reset input reads its own target; write elsewhere first")
    (
        _layout(df)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy(PARTITION_COLUMN)
        .parquet(path)
    )
    stored = read_panel(df.sparkSession, path)
    _ids_of(stored).write.mode("overwrite").parquet(ids_path(path))
    block_digests(stored).repartition(PARTITION_COLUMN).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(PARTITION_COLUMN).parquet(digests_path(path))
    stored.select("date").distinct().write.mode("overwrite").parquet(months_path(path))


def backup_store(spark: SparkSession, path: str, dest: str) -> None:
    """Copy the store to a dated backup folder (read → write, same layout)."""
    _layout(read_panel(spark, path)).write.mode("errorifexists").partitionBy(PARTITION_COLUMN).parquet(dest)
    store_ids(spark, path).write.mode("errorifexists").parquet(ids_path(dest))
    store_months(spark, path).write.mode("errorifexists").parquet(months_path(dest))
    store_digests(spark, path).repartition(PARTITION_COLUMN).write.mode("errorifexists").partitionBy(PARTITION_COLUMN).parquet(digests_path(dest))


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Persist a small derived table (count cube, catalogue) as Parquet or CSV."""
    w = df.write.mode("overwrite")
    if fmt == "csv":
        w.option("header", True).option("nullValue", "").csv(path)
    else:
        w.parquet(path)


def display_order(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Presentation order of the reference: ids, date, codes; NULL last."""
    cols = columns or ["book_id", "sheet_id", "date", "clave_delegacion", "clave_subdelegacion"]
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in cols if c in df.columns])


def preview(df: DataFrame, n: int = 10) -> DataFrame:
    """First rows for a quick look (a limit is the feature here)."""
    return df.limit(n)
