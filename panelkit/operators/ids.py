"""Series identifiers: (book_id, sheet_id) per (level, book_name, sheet_name).

Ids are numbered once and kept: a known label keeps its stored ids, a new one
gets the next free numbers, so partitions never move.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelkit.session import cut_lineage

ID_COLUMNS = ["book_id", "sheet_id", "book_name", "sheet_name", "level"]
LABEL = ["level", "book_name", "sheet_name"]
BOOK = ["level", "book_name"]


def ordered_numbers(df: DataFrame, columns: list[str], name: str, start: int = 0) -> DataFrame:
    """``df``'s distinct ``columns`` with their 1-based place in sorted order, plus ``start``.

    Range partitions are numbered side by side and shifted by the row counts
    of the partitions before them, so no task holds the whole dimension.
    """
    ranged = cut_lineage(df.select(*columns).distinct().repartitionByRange(*columns)).withColumn("_part", F.spark_partition_id())
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    shift = ranged.groupBy("_part").agg(F.count("*").alias("_rows")).select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_shift"))
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(*columns))
    numbered = ranged.withColumn("_place", inside).join(shift, "_part")
    return numbered.select(*columns, (F.col("_shift") + F.col("_place") + start).cast("int").alias(name))


def _same(left: DataFrame, right: DataFrame, columns: list[str]):
    cond = None
    for c in columns:
        e = left[c].eqNullSafe(right[c])
        cond = e if cond is None else cond & e
    return cond


def label_ids(panel: DataFrame, sheet_start: int = 0, book_start: int = 0) -> DataFrame:
    """Dense ids over the distinct labels: book by (level, book_name),
    sheet by (level, book_name, sheet_name)."""
    sheets = ordered_numbers(panel, LABEL, "sheet_id", sheet_start)
    books = ordered_numbers(panel, BOOK, "book_id", book_start)
    joined = sheets.join(books, _same(sheets, books, BOOK))
    return joined.select(books["book_id"], sheets["sheet_id"], sheets["book_name"], sheets["sheet_name"], sheets["level"])


def extend_ids(old: DataFrame, panel: DataFrame) -> DataFrame:
    """``old`` ids and, after their largest numbers, ids of the labels of ``panel`` that ``old`` lacks."""
    old = old.select(*ID_COLUMNS).where(F.col("book_id").isNotNull() & F.col("sheet_id").isNotNull()).distinct()
    labels = panel.select(*LABEL).distinct()
    fresh = cut_lineage(labels.join(old, _same(labels, old, LABEL), "left_anti"))
    if fresh.isEmpty():
        return old
    top = old.agg(F.max("book_id"), F.max("sheet_id")).first()
    books = old.select(*BOOK, "book_id").distinct()
    unknown = fresh.select(*BOOK).distinct().alias("f")
    unknown = unknown.join(books, _same(unknown, books, BOOK), "left_anti")
    every_book = books.unionByName(ordered_numbers(unknown, BOOK, "book_id", top[0] or 0))
    sheets = ordered_numbers(fresh, LABEL, "sheet_id", top[1] or 0)
    joined = sheets.join(every_book, _same(sheets, every_book, BOOK))
    added = joined.select(every_book["book_id"], sheets["sheet_id"], sheets["book_name"], sheets["sheet_name"], sheets["level"])
    return old.unionByName(added)


def stored_ids(store: DataFrame) -> DataFrame:
    """Distinct id rows of a stored panel (partial aggregation, tiny output)."""
    return store.select(*ID_COLUMNS).distinct()


def assign_series_ids(new: DataFrame, ids: DataFrame) -> DataFrame:
    """Left join ids on (sheet_name, book_name, level), NULL matching NULL.

    Series that ``ids`` lacks keep NULL ids; ``extend_ids`` numbers them.
    """
    i = ids.select(
        "book_id",
        "sheet_id",
        F.col("book_name").alias("i_book"),
        F.col("sheet_name").alias("i_sheet"),
        F.col("level").alias("i_level"),
    )
    cond = (
        F.col("sheet_name").eqNullSafe(F.col("i_sheet"))
        & F.col("book_name").eqNullSafe(F.col("i_book"))
        & F.col("level").eqNullSafe(F.col("i_level"))
    )
    base = new.drop("book_id", "sheet_id")
    return base.join(i, cond, "left").drop("i_book", "i_sheet", "i_level")
