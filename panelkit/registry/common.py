"""Shared builders for registered queries (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.operators.ids import assign_series_ids, label_ids
from panelkit.operators.micro import clean_counts, microdata_counts
from panelkit.operators.panel import FAMILIES, LEVELS, build_panel, with_geo
from panelkit.plans.explorer import open_labels
from panelkit.session import cut_lineage, shared_dir
from panelkit.sources.register import code_dictionary, geo_dictionary, micro_register
from panelkit.sources.store import months_path, path_exists, read_panel, reset_panel


def rv(c: Column | str) -> Column:
    """Rounding of statistics (ratios, deviations, correlations) in query wrappers only.

    Panel values and cube means are exact and compared as they are.  A
    statistic of doubles depends on the order of its rows and may land on a
    decimal tie; a tiny offset before rounding to 4 places makes both engines
    agree.  Engine operators return the unrounded double.
    """
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c + F.lit(0.0000037), 4) + F.lit(0.0)


def cube(spark: SparkSession, sf: str) -> DataFrame:
    return microdata_counts(micro_register(spark, sf))


def clean(spark: SparkSession, sf: str) -> DataFrame:
    return clean_counts(cube(spark, sf))


def panel(
    spark: SparkSession, sf: str, levels: tuple[str, ...] = LEVELS, families: tuple[str, ...] = FAMILIES
) -> DataFrame:
    return build_panel(clean(spark, sf), code_dictionary(spark), levels, families)


def panel_geo(spark: SparkSession, sf: str) -> DataFrame:
    return with_geo(panel(spark, sf), geo_dictionary(spark, sf))


def prepared_store(spark: SparkSession, sf: str) -> str:
    """Path of a store that holds the whole panel, written once per Spark application and input folder.

    A reset writes the month list last, so a store without one is built again.
    """
    name = hashlib.md5(sf.rstrip("/").encode()).hexdigest()[:12]
    path = f"{shared_dir(spark)}/prepared-store-{spark.sparkContext.applicationId}-{name}"
    if not path_exists(spark, months_path(path)):
        p = cut_lineage(panel_geo(spark, sf))
        reset_panel(assign_series_ids(p, label_ids(p)), path)
    return path


def stored_panel(spark: SparkSession, sf: str) -> DataFrame:
    """The stored panel's label, geography, date and value columns; Catalyst prunes what a query leaves out."""
    return read_panel(spark, prepared_store(spark, sf)).drop("book_id", "sheet_id")


def stored_labels(spark: SparkSession, sf: str) -> DataFrame:
    """The prepared store's table of labels, months and row counts."""
    return open_labels(spark, prepared_store(spark, sf))

