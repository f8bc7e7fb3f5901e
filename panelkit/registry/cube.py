"""Registered queries of the persisted cube."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.operators.micro import clean_counts, microdata_counts
from panelkit.operators.panel import build_panel
from panelkit.registry import core
from panelkit.registry import oracle_base as O
from panelkit.schema import CUBE_KEYS
from panelkit.session import scratch_path
from panelkit.sources.cube_store import add_records, compact_cube, read_cube
from panelkit.sources.register import code_dictionary, micro_register

# Every seventh worker's records come late, some of them in a second file; records without worker come on time.
LATE_EVERY, SECOND_FILE = 7, 14


def late_cube(spark: SparkSession, sf: str) -> str:
    """A stored cube whose records came in three batches, one of them twice; its compacted copy is what is returned."""
    micro = micro_register(spark, sf)
    worker = F.coalesce("nss", F.lit(1))
    path = scratch_path(spark, "cube")
    add_records(micro.where(worker % LATE_EVERY != 0), path, "extract")
    late = micro.where(worker % LATE_EVERY == 0)
    add_records(late.where(worker % SECOND_FILE != 0), path, "late-1")
    for _ in range(2):
        add_records(late.where(worker % SECOND_FILE == 0), path, "late-2")
    return path


def q_cube_merge_late(spark: SparkSession, sf: str) -> DataFrame:
    return read_cube(spark, late_cube(spark, sf))


def q_panel_from_merged_cube(spark: SparkSession, sf: str) -> DataFrame:
    """The whole panel from a compacted cube: wage means are never averaged."""
    dest = scratch_path(spark, "cube-compacted")
    compact_cube(spark, late_cube(spark, sf), dest)
    return build_panel(clean_counts(read_cube(spark, dest)), code_dictionary(spark))


def q_cube_ordered(spark: SparkSession, sf: str) -> DataFrame:
    """The cube in key order (NULL first), with each row's place within its month."""
    from pyspark.sql import Window

    ordered = microdata_counts(micro_register(spark, sf), sort=True)
    place = F.row_number().over(Window.partitionBy("date").orderBy(*[F.col(k).asc_nulls_first() for k in CUBE_KEYS[1:]]))
    return ordered.withColumn("place", place.cast("long"))


QUERIES = {"cube_merge_late": q_cube_merge_late, "panel_from_merged_cube": q_panel_from_merged_cube, "cube_ordered": q_cube_ordered}

_KEYS = ", ".join(CUBE_KEYS)
_ORDER = ", ".join(f"{k} NULLS FIRST" for k in CUBE_KEYS[1:])
ORACLE = {
    "cube_merge_late": core.ORACLE["microdata_counts"],
    "panel_from_merged_cube": f"{O.PANEL_BASE} SELECT * FROM panel_full",
    "cube_ordered": f"""{O.BASE} SELECT {_KEYS}, asegurados, salario, patrones,
        row_number() OVER (PARTITION BY date ORDER BY {_ORDER}) AS place FROM cube""",
}
