"""An entity-first copy of the panel store, for slices of one entity over all series and months.

The store itself has one folder a month, sorted by series: one entity's rows
lie in every row group.  The copy (``<store>_entities``) has one folder a
year; inside, files are clustered by a range of (delegation, subdelegation,
series, month) and sorted by it, so an entity's rows of a year lie in one or a
few neighbouring row groups, and a Bloom filter on the subdelegation code
speaks for those whose range spans it.  The range goes on behind the entity, so one
entity with a third of the rows is spread over several files.

The copy is derived data.  Next to it lies the sum of the digests of the months
that each year was copied from.  ``refresh_entities`` rewrites the years whose
sum differs from the store's, each as a whole; ``entity_slice`` reads such years
from the store, so a slice is right whether or not the copy has been refreshed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegerType, LongType, StructField, StructType

from panelkit.schema import EXPLORER_COLUMNS, PANEL
from panelkit.session import cut_lineage
from panelkit.sources.store import path_exists, read_panel, store_digests

YEAR = "year"
CLUSTER = ["clave_delegacion", "clave_subdelegacion", "book_id", "sheet_id", "disaggregation", "date"]
ROW_GROUP_BYTES = 32 << 20
YEAR_LIMIT = 1000  # plan literals: a calendar's years
_SUMS = StructType([StructField(YEAR, IntegerType()), StructField("n_rows", LongType()), StructField("digest", DecimalType(38, 0))])
_COPY = PANEL.__class__([*PANEL.fields, StructField(YEAR, IntegerType())])


def entities_path(path: str) -> str:
    return path.rstrip("/") + "_entities"


def _sums_path(path: str) -> str:
    return entities_path(path) + "_sums"


def year_sums(digests: DataFrame) -> DataFrame:
    """Rows and summed digests per year; the month weighs in, so rows that move between months show."""
    part = F.col("digest") + F.xxhash64("date", "n_rows").cast("decimal(20,0)")
    return digests.groupBy(F.year("date").alias(YEAR)).agg(F.sum("n_rows").alias("n_rows"), F.sum(part).cast("decimal(38,0)").alias("digest"))


def stale_years(spark: SparkSession, path: str) -> list[int | None]:
    """The years, at most a calendar's, whose copy is missing or not that of the store (None: rows without a month)."""
    held = year_sums(store_digests(spark, path))
    if path_exists(spark, _sums_path(path)):
        copied = spark.read.schema(_SUMS).parquet(_sums_path(path))
        sides = held.select(F.lit(1).alias("side"), *_SUMS.names).unionByName(copied.select(F.lit(-1).alias("side"), *_SUMS.names))
        held = sides.groupBy(YEAR).agg(F.sum(F.col("side") * F.col("n_rows")).alias("rows"), F.sum(F.col("side") * F.col("digest")).alias("rest"), F.count("side").alias("sides"))
        held = held.where("rows <> 0 OR rest <> 0 OR sides < 2")
    years = [r[0] for r in held.select(YEAR).limit(YEAR_LIMIT + 1).collect()]
    if len(years) > YEAR_LIMIT:
        raise ValueError(f"the store holds over {YEAR_LIMIT} years")
    return years


def _of_years(years: list[int | None]) -> Column:
    """A predicate on the month that prunes the store to the folders of these years."""
    cond = F.col("date").isNull() if None in years else F.lit(False)
    for y in sorted(y for y in years if y is not None):
        cond = cond | F.col("date").between(F.make_date(F.lit(y), F.lit(1), F.lit(1)), F.make_date(F.lit(y), F.lit(12), F.lit(31)))
    return cond


def refresh_entities(spark: SparkSession, path: str, row_group_bytes: int = ROW_GROUP_BYTES) -> list[int | None]:
    """Copy the stale years anew, only those, and return them.

    A year's sums are taken before its rows are read and written after them:
    a run that dies, or a store that changes meanwhile, leaves the year stale.
    """
    years = stale_years(spark, path)
    if not years:
        return years
    sums = cut_lineage(year_sums(store_digests(spark, path)))
    year = F.year("date").alias(YEAR)
    rows = read_panel(spark, path).where(_of_years(years)).select("*", year).repartitionByRange(YEAR, *CLUSTER).sortWithinPartitions(YEAR, *CLUSTER)
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("parquet.block.size", row_group_bytes)
        .option("parquet.bloom.filter.enabled#clave_subdelegacion", "true")
        .partitionBy(YEAR)
        .parquet(entities_path(path))
    )
    sums.write.mode("overwrite").parquet(_sums_path(path))
    return years


def entity_slice(spark: SparkSession, path: str, level: str, delegation: int, subdelegation: int | None = None) -> DataFrame:
    """All series and months of one entity, in the explorer's columns.

    The codes reach the scan of the copy as literals.  Years that the copy
    lacks or holds in an older state come from the store's own folders.
    """
    sub = F.col("clave_subdelegacion")
    wanted = (F.col("clave_delegacion") == delegation) & (sub.isNull() if subdelegation is None else sub == subdelegation) & (F.col("level") == level)
    stale = stale_years(spark, path)
    parts = []
    if path_exists(spark, entities_path(path)):
        fresh = ~F.col(YEAR).isin([y for y in stale if y is not None]) & F.col(YEAR).isNotNull() | (F.col(YEAR).isNull() & F.lit(None not in stale))
        parts.append(spark.read.schema(_COPY).parquet(entities_path(path)).where(fresh & wanted).select(*EXPLORER_COLUMNS))
    if stale or not parts:
        parts.append(read_panel(spark, path).where(_of_years(stale) & wanted).select(*EXPLORER_COLUMNS))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
