"""Exact duplicates by counting quotient filters and byte verification.

Every partition packs the 64-bit fingerprints of its texts into a counting
quotient filter: a fingerprint's high bits name a block, the rest is kept as
a sorted remainder with a count.  Filters of one block merge losslessly by
adding the counts of equal remainders.  Fingerprints whose merged count is
above one route their documents to byte verification, which groups whole
texts; all other documents are known to be alone and their texts never move.

Routing uses a bitmap of bounded size over the high bits of the repeated
fingerprints; a bit shared by chance only sends one more document to
verification.

Null text counts as empty.  Of equal texts the largest doc_id stays (nulls
last); of rows that tie on it, exactly one.  Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import bitmap_filter, narrow, ship_package
from panelkit.session import cut_lineage

BLOCK_FINGERPRINTS = 1 << 14


class CountingQuotientFilter:
    """The fingerprints of one block: sorted remainders with counts."""

    def __init__(self, remainders: np.ndarray, counts: np.ndarray):
        self.remainders, self.counts = remainders, counts

    @classmethod
    def of(cls, remainders: np.ndarray) -> CountingQuotientFilter:
        return cls(*np.unique(remainders, return_counts=True))

    @classmethod
    def merge(cls, filters: list[CountingQuotientFilter]) -> CountingQuotientFilter:
        """Sorted runs become one; counts of equal remainders add up."""
        remainders = np.concatenate([f.remainders for f in filters])
        counts = np.concatenate([f.counts for f in filters])
        order = np.argsort(remainders, kind="stable")  # runs are sorted: a merge
        remainders, counts = remainders[order], counts[order]
        first = np.flatnonzero(np.r_[True, remainders[1:] != remainders[:-1]]) if len(remainders) else np.zeros(0, int)
        return cls(remainders[first], np.add.reduceat(counts, first) if len(first) else counts)

    def pack(self) -> tuple[bytes, bytes]:
        return self.remainders.astype("<u8").tobytes(), self.counts.astype("<u8").tobytes()

    @classmethod
    def unpack(cls, remainders: bytes, counts: bytes) -> CountingQuotientFilter:
        return cls(np.frombuffer(remainders, "<u8"), np.frombuffer(counts, "<u8"))


def _split(fps: np.ndarray, block_bits: int) -> tuple[np.ndarray, np.ndarray]:
    rest = np.uint64(64 - block_bits)
    return (fps >> rest if block_bits else np.zeros_like(fps)), fps & np.uint64((1 << (64 - block_bits)) - 1)


def repeated_fingerprints(fps: DataFrame, block_bits: int) -> DataFrame:
    """(fp, n) of every fingerprint in column ``fp`` whose merged count n is above one."""

    def build(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b.column(0).to_numpy(zero_copy_only=False).astype(np.int64) for b in batches]
        if not parts:
            return
        blocks, remainders = _split(np.sort(np.concatenate(parts).view(np.uint64)), block_bits)
        starts = np.flatnonzero(np.r_[True, blocks[1:] != blocks[:-1]]) if len(blocks) else np.zeros(0, int)
        for k in range(0, len(starts), 4096):
            chunk = starts[k : k + 4096]
            ends = np.append(starts[k + 1 : k + 4097], len(blocks))[: len(chunk)]
            packed = [CountingQuotientFilter.of(remainders[a:b]).pack() for a, b in zip(chunk, ends, strict=True)]
            yield pa.RecordBatch.from_pydict(
                {"block": pa.array(blocks[chunk].astype(np.int64)), "remainders": pa.array([p[0] for p in packed], pa.binary()), "counts": pa.array([p[1] for p in packed], pa.binary())}
            )

    def merge(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        merged = CountingQuotientFilter.merge([CountingQuotientFilter.unpack(r, c) for r, c in zip(group["remainders"], group["counts"], strict=True)])
        more = merged.counts > 1
        fp = merged.remainders[more] | np.uint64(int(key[0]) << (64 - block_bits) & (1 << 64) - 1 if block_bits else 0)
        return pd.DataFrame({"fp": fp.view(np.int64), "n": merged.counts[more].astype(np.int64)})

    filters = fps.select("fp").mapInArrow(build, "block long, remainders binary, counts binary")
    return filters.groupBy("block").applyInPandas(merge, "fp long, n long")


def _routing(texts: DataFrame):
    """``texts`` has ``fp``. Counts, filters and merges; returns the routing expression and the checkpointed repeats."""
    rows = texts.count()
    block_bits = max(0, (rows // BLOCK_FINGERPRINTS).bit_length())
    repeated = cut_lineage(repeated_fingerprints(texts, block_bits))
    return bitmap_filter(repeated, repeated.count())


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    texts = narrow(docs, id_col, text_col).toDF("doc_id", "text").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    texts = texts.withColumn("fp", F.xxhash64("text"))
    routed = _routing(texts)
    verified = texts.where(routed("fp")).groupBy("fp", "text").agg(F.count("*").alias("group_size"), F.max("doc_id").alias("keep_id"))
    classes = verified.where("group_size > 1").select("fp", F.sha2("text", 256).alias("text_sha256"), "group_size", "keep_id")
    copies = texts.select("doc_id", "fp", F.sha2("text", 256).alias("text_sha256")).groupBy("doc_id", "fp", "text_sha256").agg(F.count("*").alias("copies"))
    joined = copies.join(cut_lineage(classes), ["fp", "text_sha256"], "left")
    return joined.select(
        "doc_id",
        F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy"),
        "text_sha256",
    ).select("doc_id", "keep_id", "group_size", (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"), "text_sha256")


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that stay: one per distinct text.

    Documents that are alone pass straight through; only the routed ones are
    shuffled, and grouping their texts keeps the whole row of the largest id.
    """
    ship_package(docs.sparkSession)
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(whole.alias("row"), F.xxhash64(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))).alias("fp"))
    routed = _routing(rows)
    alone = rows.where(~routed("fp")).select("row.*")
    text, doc_id = F.coalesce(F.col("row")[text_col], F.lit("")), F.col("row")[id_col]
    others = [F.col("row")[c].alias(f"c{i}") for i, c in enumerate(docs.columns) if c != text_col]
    kept = (
        rows.where(routed("fp"))
        .select("fp", text.alias("t"), doc_id.alias("id"), F.struct(F.col("row")[text_col].isNull().alias("absent"), *others).alias("rest"))
        .groupBy("fp", "t")
        .agg(F.max_by("rest", F.struct(F.col("id").isNotNull(), "id")).alias("rest"))
    )
    back = [F.when(~F.col("rest.absent"), F.col("t")).alias(c) if c == text_col else F.col(f"rest.c{i}").alias(c) for i, c in enumerate(docs.columns)]
    return alone.union(kept.select(*back))
