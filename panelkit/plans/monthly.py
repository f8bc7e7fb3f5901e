"""Monthly cycle: register → cube → panel → ids → continuity gate → append.

One lazy DAG up to the new month's panel; the panel is checkpointed into
the shared folder so the gate and the write do not recompute the register
aggregation and survive the loss of executors.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.operators.continuity import require_continuity
from panelkit.operators.digests import block_digests, differing_blocks, revision_diff_of_blocks
from panelkit.operators.ids import ID_COLUMNS, assign_series_ids, extend_ids, stored_ids
from panelkit.operators.micro import clean_counts, microdata_counts
from panelkit.operators.panel import build_panel, with_geo
from panelkit.operators.quality import REVISION_TOLERANCE, require_unique_dictionary
from panelkit.operators.snapshot import require_non_empty
from panelkit.session import cut_lineage
from panelkit.sources.store import append_ids, append_months, append_panel, overwrite_months, read_panel, store_digests, store_ids, store_months


def new_month_panel(micro: DataFrame, dic: DataFrame, geo: DataFrame, month: dt.date | str | None = None) -> DataFrame:
    """Panel of the register's month(s), with geography names.  The code
    dictionary must have unique keys (duplicates would multiply rows)."""
    require_unique_dictionary(dic)
    return with_geo(build_panel(clean_counts(microdata_counts(micro), month), dic), geo)


def updated_panel(stored: DataFrame, new: DataFrame) -> DataFrame:
    """New month (with stored ids) ∪ history, after the continuity gate."""
    new_ids = assign_series_ids(new, stored_ids(stored))
    require_continuity(stored.select("date"), new_ids.select("date"))
    return new_ids.unionByName(stored, allowMissingColumns=True)


def update_store(spark: SparkSession, store_path: str, new: DataFrame, resume: bool = False) -> DataFrame:
    """Append the new month to the store behind the gate; return the store.

    The ids of new series are numbered and written before the data, and the
    old ids are read before anything is written, so a run that dies at any
    step loses no id.  ``resume`` completes such a run: whatever it left of
    the month is replaced, and the side tables are brought up to date.
    """
    old_ids = cut_lineage(store_ids(spark, store_path))
    # Checkpoint first: the gate (which also refuses an empty month) and the
    # write then read the materialised month instead of recomputing the
    # register aggregate.
    new_ids = cut_lineage(assign_series_ids(new, extend_ids(old_ids.select(*ID_COLUMNS), new)))
    stored = store_months(spark, store_path)
    if resume:
        stored = stored.join(new_ids.select("date").distinct(), "date", "left_anti")
    month = require_continuity(stored, new_ids.select("date"))
    # The month list is written after the data; if a run died in between,
    # the list lags.  A probe of the month's own folder makes a second append
    # of the month impossible.
    held = not read_panel(spark, store_path, ["date"]).where(F.col("date") == F.lit(month)).isEmpty()
    if held and not resume:
        raise ValueError(f"month {month} is already in the store")
    append_ids(spark, new_ids, store_path)
    if held:
        overwrite_months(new_ids, store_path)
    else:
        append_panel(new_ids, store_path)
    append_months(new_ids, store_path)
    return read_panel(spark, store_path)


def replace_month(spark: SparkSession, store_path: str, new: DataFrame) -> None:
    """Publish ``new`` in place of what the store holds for its months.

    Every month must be stored already.  Labels get their stored ids, new
    ones the next free numbers, written before the data; then each month's
    folder is replaced as a whole, so a series that ``new`` lacks leaves the
    month.  No other month is read or written, and running it again gives the
    same store.
    """
    old_ids = cut_lineage(store_ids(spark, store_path))
    new_ids = cut_lineage(assign_series_ids(new, extend_ids(old_ids.select(*ID_COLUMNS), new)))
    months = cut_lineage(new_ids.select("date").distinct())
    if months.isEmpty():
        raise ValueError("the revision holds no rows")
    unknown = months.join(store_months(spark, store_path), "date", "left_anti")
    if not unknown.isEmpty():
        raise ValueError(f"the store lacks months of the revision: {unknown.limit(20).collect()}")
    append_ids(spark, new_ids, store_path)
    overwrite_months(new_ids, store_path)


def stored_revision_diff(spark: SparkSession, store_path: str, new: DataFrame, tol: float = REVISION_TOLERANCE) -> DataFrame:
    """``revision_diff`` of a recomputation (a checkpointed frame) against the store.

    The digests of both sides tell which series and months differ; only their
    rows are joined, and only their months' folders are read.
    """
    blocks = cut_lineage(differing_blocks(block_digests(new), store_digests(spark, store_path)))
    return revision_diff_of_blocks(new, read_panel(spark, store_path), blocks, tol=tol)


def run_month(
    spark: SparkSession, micro: DataFrame, dic: DataFrame, geo: DataFrame, store_path: str, month: dt.date | str
) -> DataFrame:
    return update_store(spark, store_path, new_month_panel(require_non_empty(micro, "register"), dic, geo, month))
