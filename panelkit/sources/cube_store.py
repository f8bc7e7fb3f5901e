"""The persisted count cube: states of record batches, one folder per month and batch.

A batch of records (the month's extract, a file of late records, a correction)
is aggregated once and its state written to ``date=…/batch=…``.  Reading merges
the batches of a month, so late records cost their own size, never a
re-aggregation of the register.  Adding a batch again under its name replaces
what it wrote before, so a run that died can be repeated without counting
anything twice.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from panelkit.operators.cube_state import CUBE_STATE, cube_state, finished_cube, merge_states
from panelkit.session import cut_lineage

_STORED = StructType([*CUBE_STATE.fields, StructField("batch", StringType())])
_NAME = re.compile(r"[A-Za-z][A-Za-z0-9_-]*")


def _write(states: DataFrame, path: str, batch: str, mode: str) -> None:
    if not _NAME.fullmatch(batch):
        raise ValueError(f"a batch is named by letters, digits, - and _: {batch!r}")
    laid = states.withColumn("batch", F.lit(batch)).repartition("date", "mod", "cve_del_final").sortWithinPartitions("date", "cve_del_final", "cve_subdel_final")
    laid.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("date", "batch").parquet(path)


def add_records(micro: DataFrame, path: str, batch: str) -> None:
    """Aggregate a batch of register records and store its state under ``batch``.

    A batch is the same records each time it is added; it may span months.
    """
    _write(cube_state(micro), path, batch, "overwrite")


def read_states(spark: SparkSession, path: str, months: list | None = None) -> DataFrame:
    """The stored states; ``months`` (dates) prunes to their folders."""
    states = spark.read.schema(_STORED).parquet(path)
    return states if months is None else states.where(F.col("date").isin(list(months)))


def read_cube(spark: SparkSession, path: str, months: list | None = None) -> DataFrame:
    """The finished cube of all batches: one shuffle of states, none of records."""
    return finished_cube(merge_states(read_states(spark, path, months)))


def compact_cube(spark: SparkSession, path: str, dest: str, batch: str = "base") -> None:
    """Write the merged state of every month as one batch into the new folder ``dest``; ``path`` stays as it is."""
    _write(cut_lineage(merge_states(read_states(spark, path))), dest, batch, "errorifexists")
