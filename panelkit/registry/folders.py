"""Registered listings of folders: files are laid into the shared folder, then found by the listers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.operators.books import classify_catalogue
from panelkit.operators.snapshot import latest_snapshot, list_snapshots
from panelkit.registry import books, core
from panelkit.registry import published_books as S
from panelkit.registry.common import stored_panel
from panelkit.session import scratch_path
from panelkit.sources.books import list_workbooks

# Fixed value: a file of the drop folder that is no snapshot.
OTHER_FILE = "/data/catalogo.sas7bdat"


def lay_files(spark: SparkSession, paths: list[str], name: str) -> str:
    """A new folder of the shared folder with a one-byte file at each of ``paths`` (a folder's worth)."""
    root = scratch_path(spark, name)
    hadoop = spark._jvm.org.apache.hadoop.fs
    for p in paths:
        path = hadoop.Path(root + p)
        out = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path)
        out.write(0)
        out.close()
    return root


def _below(found: DataFrame, root: str) -> DataFrame:
    """The paths without the folder they were laid into."""
    tail = "/" + root.rsplit("/", 1)[-1] + "/"
    return found.select(F.concat(F.lit("/"), F.substring_index("path", tail, -1)).alias("path"))


def q_workbook_listing(spark: SparkSession, sf: str) -> DataFrame:
    """The published workbooks, listed from their folders and classified."""
    catalogue = S.book_catalogue(spark, S.published_sheets(stored_panel(spark, sf)))
    root = lay_files(spark, [r.path for r in catalogue.collect()] + ["/raw/notas.txt"], "workbooks")
    return classify_catalogue(_below(list_workbooks(spark, root), root))


def q_snapshot_listing(spark: SparkSession, sf: str) -> DataFrame:
    """The newest snapshot of a drop folder that also holds a superseded one and another file."""
    root = lay_files(spark, [r.path for r in core.snapshot_listing(spark, sf).collect()] + [OTHER_FILE], "register-drop")
    return latest_snapshot(_below(list_snapshots(spark, root + "/data"), root))


QUERIES = {"workbook_listing": q_workbook_listing, "snapshot_listing": q_snapshot_listing}
ORACLE = {"workbook_listing": books.ORACLE["catalogue_classify"], "snapshot_listing": core.ORACLE["latest_period_snapshot"]}
