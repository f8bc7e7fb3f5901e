"""Sharding by proportional stratified interleaving.

Rows of each source are shuffled by a seeded hash and ranked; the row of rank
r among n has the fractional rank (r - 1/2) / n.  Sorting all rows by it
interleaves the sources in proportion, and equal cuts of that order give
shards that each match the mixture and differ by one row at most.

Ranks come without any group in one task: a source is dealt into buckets by
the leading digits of the hash (as many as its size asks for), rows are
numbered inside their bucket and the counts of the lower buckets are added.
The same is done for the global order, by leading digits of the fractional
rank.

A null source is a source of its own; null text has zero bytes and a null
doc_id is hashed as empty text.  The hash takes the id, size and checksum, so
one id with many texts fills no bucket; rows equal in all three share one.
Repeated rows each get a place.  Groups of
equal texts are not held together: one may be larger than a shard.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelkit.llm.common import narrow
from panelkit.session import cut_lineage

ROW_BYTES = 16
BUCKET_ROWS = 4_096


def interleaved_shards(docs: DataFrame, shards: int = 40, seed: int = 9, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """doc_id, source, size, text_crc32, source_rank, source_rows, position, shard, slot: one row per row of ``docs``."""
    rows = narrow(docs, id_col, text_col, source_col).toDF("doc_id", "text", "source")
    rows = rows.select(
        "doc_id",
        "source",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
    )
    # Id, size and checksum, so that the different texts of one id are dealt apart.
    drawn = F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "size", "text_crc32")
    rows = rows.withColumn("draw", F.md5(drawn.cast("binary")))
    sources = narrow(docs, source_col).toDF("source").groupBy("source").agg(F.count("*").alias("source_rows"))
    sources = cut_lineage(sources)
    total = sources.agg(F.sum("source_rows")).first()[0] or 0
    cells = max(1, -(-total // bucket_rows))

    # Rank inside each source: hash buckets, numbered rows, counts below.
    sized = rows.withColumnRenamed("source", "s").join(sources, F.col("s").eqNullSafe(F.col("source"))).drop("s")
    share = F.conv(F.substring("draw", 1, 12), 16, 10).cast("double") / F.lit(float(1 << 48))
    dealt = sized.withColumn("bucket", F.floor(share * F.ceil(F.col("source_rows") / F.lit(bucket_rows))))
    dealt = cut_lineage(dealt)
    inside = Window.partitionBy("source", "bucket").orderBy("draw", "doc_id", "size", "text_crc32")
    filled = dealt.groupBy("source", "bucket").agg(F.count("*").alias("filled"))
    below = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    lower = filled.select(F.col("source").alias("s"), F.col("bucket").alias("b"), F.coalesce(F.sum("filled").over(below), F.lit(0)).alias("lower"))
    ranked = (
        dealt.withColumn("n", F.row_number().over(inside))
        .join(lower, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b")))
        .withColumn("source_rank", (F.col("lower") + F.col("n")).cast("long"))
        .select("doc_id", "source", "size", "text_crc32", "draw", "source_rank", "source_rows")
    )
    odd = F.col("source_rank") * 2 - 1
    ranked = ranked.withColumn("cell", F.expr(f"((source_rank * 2 - 1) * {cells}L) div (2 * source_rows)")).withColumn("place", odd / (F.col("source_rows") * 2))
    ranked = cut_lineage(ranked)

    # The same for the global order: cells of equal fractional rank.
    order = Window.partitionBy("cell").orderBy("place", "draw", "source", "doc_id", "size", "text_crc32")
    before = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    first = ranked.groupBy("cell").agg(F.count("*").alias("filled")).select("cell", F.coalesce(F.sum("filled").over(before), F.lit(0)).alias("first"))
    placed = ranked.withColumn("n", F.row_number().over(order)).join(first, "cell").withColumn("position", (F.col("first") + F.col("n") - 1).cast("long"))
    shard = F.expr(f"(position * {shards}L) div {max(1, total)}L")
    start = F.expr(f"(shard * {total}L + {shards - 1}L) div {shards}L")
    return placed.withColumn("shard", shard.cast("int")).withColumn("slot", (F.col("position") - start).cast("long")).select(
        "doc_id", "source", "size", "text_crc32", "source_rank", "source_rows", "position", "shard", "slot"
    )
