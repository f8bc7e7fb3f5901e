"""Order-independent digests of panel blocks, and revision checks that join differing blocks only.

A block is one series in one month.  Its digest is the number of its rows and
the sum of their 64-bit hashes, so digests of parts add up and the order of
rows does not matter.  Equal digests on both sides mean equal rows, up to a
64-bit hash; only blocks that differ, and those stored with NULL values, which
are reported whatever the other side holds, are compared row by row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, LongType, StringType, StructField, StructType

from panelkit.operators.quality import REVISION_KEY, REVISION_TOLERANCE, revision_diff

#: Ids are left out of the hash: a recomputation has none until it is published.
ROW_KEY = [k for k in REVISION_KEY if k not in ("book_id", "sheet_id")]
BLOCK = ["date", "level", "series", "disaggregation", "sheet_name", "book_name"]
DIGESTS = StructType([StructField("date", DateType())] + [StructField(c, StringType()) for c in BLOCK[1:]] + [StructField("n_rows", LongType()), StructField("n_null", LongType()), StructField("digest", DecimalType(38, 0))])
MONTH_LIMIT = 1200


def block_digests(panel: DataFrame, block: list[str] | None = None, key: list[str] | None = None) -> DataFrame:
    """Rows and summed hashes per block; one map-side aggregate and a shuffle of blocks.

    A value hashes as its double plus zero, so -0.0 and 0.0 are the same.
    """
    block = block or BLOCK
    key = key or [k for k in ROW_KEY if k in panel.columns]
    row = F.xxhash64(*key, F.col("value") + F.lit(0.0), F.col("value").isNull(), *[F.col(k).isNull() for k in key])
    return panel.groupBy(*block).agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("value").isNull()).alias("n_null"), F.sum(row.cast("decimal(20,0)")).cast("decimal(38,0)").alias("digest"))


def _same(columns: list[str], left: str, right: str) -> Column:
    cond = F.lit(True)
    for c in columns:
        cond = cond & F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
    return cond


def differing_blocks(new: DataFrame, stored: DataFrame, block: list[str] | None = None) -> DataFrame:
    """The blocks of the common months whose digests differ, that one side lacks, or that are stored with NULL values.

    Both inputs are digests; one grouped pass over their union compares them.
    """
    block = block or BLOCK
    sides = [F.col(c).alias(c) for c in block] + ["n_rows", "n_null", "digest"]
    both = new.select(F.lit(True).alias("is_new"), *sides).unionByName(stored.select(F.lit(False).alias("is_new"), *sides))
    months = both.groupBy("date").agg(F.count_distinct("is_new").alias("sides")).where("sides = 2").select("date")
    sign = F.when(F.col("is_new"), 1).otherwise(-1)
    compared = both.groupBy(*block).agg(F.sum(sign * F.col("n_rows")).alias("rows"), F.sum(sign * F.col("digest")).alias("rest"), F.count_distinct("is_new").alias("sides"), F.sum(F.when(~F.col("is_new"), F.col("n_null"))).alias("nulls"))
    return compared.where((F.col("rows") != 0) | (F.col("rest") != 0) | (F.col("sides") < 2) | (F.col("nulls") > 0)).join(months, "date", "left_semi").select(*block)


def revision_diff_of_blocks(new: DataFrame, stored: DataFrame, blocks: DataFrame, block: list[str] | None = None, tol: float = REVISION_TOLERANCE, key: list[str] | None = None) -> DataFrame:
    """``revision_diff`` over the rows of ``blocks`` (checkpointed) only.

    The months of the blocks, a calendar's worth at most, become a plain
    predicate, so a store partitioned by month opens no other folder; over
    MONTH_LIMIT months the join alone decides.
    """
    block = block or BLOCK
    months = [r[0] for r in blocks.select("date").distinct().limit(MONTH_LIMIT + 1).collect()]

    def within(side: DataFrame) -> DataFrame:
        if len(months) <= MONTH_LIMIT:
            side = side.where(F.col("date").isin([m for m in months if m]) | (F.col("date").isNull() if None in months else F.lit(False)))
        return side.alias("s").join(blocks.alias("b"), _same(block, "s", "b"), "left_semi")

    return revision_diff(within(new), within(stored), tol, key, common_months=False)
