"""SimHash near-duplicates by covering locality-sensitive hashing.

Fingerprints: A-Z in lower case, words between ASCII white space, shingles of
``words`` words with repeats (a shorter text is one shingle, a text without
words has fingerprint zero).  A bit is set if it is set in over half of the
shingles' XXH64 values (UTF-8, seed 42).

Links: for radius r every bit position gets a random non-zero vector of r + 1
bits; table v (any non-zero vector of r + 1 bits) keeps the positions whose
vector has an odd product with v.  Any r positions leave some v with an even
product on all of them, so every pair within the radius agrees in at least one
of the 2**(r+1) - 1 tables: nothing is lost.  Only distinct fingerprints are
hashed.  A bucket of more than ``bucket_rows`` of them is dealt out over a grid
of chunk pairs, so a task holds two chunks at most and every pair of the
bucket still meets once.  Inside, pairs are compared in blocks and only a
spanning star per class leaves, never the pairs.

Null text counts as empty.  A null doc_id takes part, but never names a
component: a component without any other id has a null component_id (when
near copies are dropped, one of its rows stays).
Repeated rows each give a row.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import bitmap_filter, connected_components, find, row_slices, ship_package, union_all, worker_state
from panelkit.session import cut_lineage

SEED = 42
BUCKET_ROWS = 4096
COMPARE_ROWS = 1024


def fingerprint(text: str | None, words: int = 3) -> int:
    """The 64-bit SimHash of one whole text."""
    tokens = (text or "").encode("utf-8", "replace").lower().split()
    if not tokens:
        return 0
    width = min(words, len(tokens))
    joined = b" ".join(tokens)
    starts = np.cumsum([0, *[len(t) + 1 for t in tokens]])
    ends = (starts[1:] - 1)[width - 1 :].tolist()
    ones, total = np.zeros(64, np.int64), len(ends)
    starts = starts.tolist()
    for at in range(0, total, 1 << 14):
        hashes = np.array([xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts[at : at + (1 << 14)], ends[at : at + (1 << 14)])], dtype="<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def text_hash(text_col: str = "text") -> Column:
    return F.xxhash64(F.coalesce(F.col(f"`{text_col}`"), F.lit("")))


def fingerprints(docs: DataFrame, words: int = 3, id_col: str = "doc_id", text_col: str = "text", hashed: bool = False) -> DataFrame:
    """doc_id and fp (signed 64-bit) for every row; with ``hashed`` also text_hash, which tells texts of one id apart."""
    extra = [text_hash(text_col).alias("text_hash")] if hashed else []
    kept = ", text_hash long" if hashed else ""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_state()
        for batch in batches:
            for part in row_slices(batch, 1):
                fps = np.array([fingerprint(t, words) for t in part.column(1).to_pylist()], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(fps), *part.columns[2:]], ["doc_id", "fp", *part.schema.names[2:]])

    ship_package(docs.sparkSession)
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"), *extra)
    return rows.mapInArrow(run, f"doc_id long, fp long{kept}")


def covering_masks(radius: int, bits: int = 64, seed: int = 5) -> list[int]:
    """2**(radius+1) - 1 masks such that any ``radius`` positions lie outside one of them."""
    vectors = np.random.default_rng(seed).integers(1, 1 << (radius + 1), bits)
    return [sum(1 << i for i, m in enumerate(vectors) if (int(m) & v).bit_count() & 1) for v in range(1, 1 << (radius + 1))]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _bucket_edges(radius: int):
    """Within each bucket (a list of distinct fingerprints) join those within the radius; emit (fp, root)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a: list[int] = []
            b: list[int] = []
            lists = batch.column(0)
            flat, offsets = lists.values.to_numpy(), lists.offsets.to_numpy()
            for lo, hi in zip(offsets[:-1], offsets[1:], strict=True):
                fps = flat[lo:hi].view(np.uint64)
                if len(fps) == 2:
                    if np.bitwise_count(fps[0] ^ fps[1]) <= radius:
                        a.append(int(flat[lo]))
                        b.append(int(flat[lo + 1]))
                    continue
                parent: dict[int, int] = {}
                for at in range(0, len(fps), COMPARE_ROWS):
                    i, j = np.nonzero(np.bitwise_count(fps[at : at + COMPARE_ROWS, None] ^ fps[None, at:]) <= radius)
                    later = j > i
                    union_all(parent, (i[later] + at).tolist(), (j[later] + at).tolist())
                nodes = [n for n in parent if find(parent, n) != n]
                a += flat[lo:hi][nodes].tolist()
                b += flat[lo:hi][[parent[n] for n in nodes]].tolist()
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return run


def linking_edges(fps: DataFrame, radius: int = 3, bucket_rows: int = BUCKET_ROWS, seed: int = 5) -> DataFrame:
    """Edges (a, b) between the distinct values of ``fp`` that connect exactly what lies within ``radius`` bits."""
    masks = F.array(*[F.lit(_signed(m)).cast("long") for m in covering_masks(radius, seed=seed)])
    dealt = fps.select("fp", F.posexplode(masks).alias("mask", "bits")).select("fp", "mask", F.expr("fp & bits").alias("key"))
    large = cut_lineage(dealt.groupBy("mask", "key").agg(F.count("*").alias("n")).where(f"n > {bucket_rows}"))
    if large.isEmpty():
        dealt = dealt.select("fp", "mask", "key", F.lit(0).alias("row"), F.lit(0).alias("col"))
    else:
        chunks = F.coalesce(F.ceil(F.col("n") / bucket_rows), F.lit(1)).cast("int")
        side = F.pmod(F.xxhash64("fp", F.lit("chunk")), F.col("chunks")).cast("int")
        sized = dealt.join(large, ["mask", "key"], "left").withColumn("chunks", chunks).withColumn("side", side)
        sized = sized.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        dealt = sized.select("fp", "mask", "key", F.least("side", "other").alias("row"), F.greatest("side", "other").alias("col"))
    lists = dealt.groupBy("mask", "key", "row", "col").agg(F.collect_list("fp").alias("fps")).where("size(fps) > 1").select("fps")
    return lists.mapInArrow(_bucket_edges(radius), "a long, b long")


def near_duplicates(docs: DataFrame, words: int = 3, radius: int = 3, id_col: str = "doc_id", text_col: str = "text", bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """doc_id, fp, component_id (the smallest doc_id reachable by links of at most ``radius`` bits) for every row."""
    return _with_least(fingerprints(docs, words, id_col, text_col), F.col("doc_id"), radius, bucket_rows)


def _with_least(fps: DataFrame, value: Column, radius: int, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``fps`` and component_id, the least ``value`` of the row's component."""
    rows = cut_lineage(fps)
    classes = cut_lineage(rows.groupBy("fp").agg(F.min(value).alias("least")))
    joined = cut_lineage(connected_components(linking_edges(classes, radius, bucket_rows)))
    linked = joined.join(classes, F.col("node") == F.col("fp")).select("fp", "component", "least")
    smallest = linked.groupBy("component").agg(F.min("least").alias("component_id"))
    names = cut_lineage(linked.join(smallest, "component").select(F.col("fp").alias("linked_fp"), "component_id"))
    alone = classes.join(names, F.col("fp") == F.col("linked_fp"), "left_anti").select(F.col("fp").alias("linked_fp"), F.col("least").alias("component_id"))
    return rows.join(alone.union(names), F.col("fp") == F.col("linked_fp")).select(*rows.columns, "component_id")


def drop_near_duplicates(docs: DataFrame, words: int = 3, radius: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that hold the one kept (doc_id, text) of their component.

    That is the smallest doc_id, of several texts under it the one with the
    least hash; in a component without an id the hash alone decides, and of
    equal texts there one row stays.  So a doc_id with two texts loses only
    the text that is a near copy.  Repeated rows of one doc_id and text all
    stay or all go.  A bounded bitmap of the dropped rows lets most rows pass
    without a shuffle of their texts.
    """
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    found = _with_least(fingerprints(docs, words, id_col, text_col, hashed=True), order, radius)
    goes = ~F.col("doc_id").eqNullSafe(F.col("component_id.doc_id")) | (F.col("text_hash") != F.col("component_id.text_hash"))
    dropped = cut_lineage(found.where(goes).select(F.col("doc_id").alias("dropped_doc_id"), F.col("text_hash").alias("dropped_hash")).distinct())
    doc_id = F.col(f"`{id_col}`").cast("long")
    listed = bitmap_filter(dropped.select(F.xxhash64("dropped_doc_id", "dropped_hash").alias("fp")), dropped.count())
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), doc_id.alias("doc_id"), text_hash(text_col).alias("text_hash"))
    whole = whole.withColumn("fp", F.xxhash64("doc_id", "text_hash"))
    same = F.col("doc_id").eqNullSafe(F.col("dropped_doc_id")) & (F.col("text_hash") == F.col("dropped_hash"))
    suspects = whole.where(listed("fp") & F.col("doc_id").isNotNull()).join(dropped, same, "left_anti")
    # Rows without an id: of equal texts among them one stays, so they move whole.
    nameless = whole.where("doc_id IS NULL").join(dropped, same, "left_anti").dropDuplicates(["text_hash"])
    passed = whole.where(~listed("fp") & F.col("doc_id").isNotNull())
    return passed.select("row.*").union(suspects.select("row.*")).union(nameless.select("row.*"))
