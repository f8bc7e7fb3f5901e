"""Monthly register drops as a Structured Streaming source.

Each month a new register extract lands as Parquet in a drop folder.  The
stream picks up every file not processed yet (``availableNow`` processes the
backlog and stops, which suits a monthly schedule) and hands each
micro-batch to the same gated update as the batch pipeline.

A batch may hold several months (a backlog); they are applied in calendar
order, each behind the continuity gate.

Exactly-once: the stream's checkpoint sits in the shared folder.  Before a
month is touched, an (epoch, month) intent is written next to that
checkpoint, and a marker after its last step.  A batch replayed after a
failure skips months with a marker and completes months with an intent only:
whatever the dead run left of the month is replaced, and the id and month
tables are brought up to date.  A month dropped again in a *new* batch is
refused by the gate.  Files must land complete (written elsewhere and
renamed), one drop per month.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType, StructField, StructType

from panelkit.plans.monthly import new_month_panel, update_store
from panelkit.schema import MICRO
from panelkit.session import scratch_path
from panelkit.sources.store import path_exists

EPOCHS = StructType([StructField("epoch_id", LongType()), StructField("date", DateType())])


def _marks_path(checkpoint: str, kind: str) -> str:
    # Epoch ids are only meaningful for one stream checkpoint.
    return f"{checkpoint.rstrip('/')}_{kind}_epochs"


def _marked_months(spark: SparkSession, checkpoint: str, kind: str, epoch_id: int) -> set:
    path = _marks_path(checkpoint, kind)
    if not path_exists(spark, path):
        return set()
    return {r[0] for r in spark.read.schema(EPOCHS).parquet(path).where(F.col("epoch_id") == epoch_id).select("date").collect()}


def _mark(spark: SparkSession, checkpoint: str, kind: str, epoch_id: int, month) -> None:
    row = spark.range(1).select(F.lit(epoch_id).cast("long").alias("epoch_id"), F.lit(month).cast("date").alias("date"))
    row.write.mode("append").parquet(_marks_path(checkpoint, kind))


def start_monthly_drop(
    spark: SparkSession,
    drop_dir: str,
    store_path: str,
    dic: DataFrame,
    geo: DataFrame,
    checkpoint: str | None = None,
):
    """Start the drop-folder stream; returns the StreamingQuery.

    Production runs pass a fixed ``checkpoint`` in the shared folder; without
    one a fresh folder is taken (every run then re-reads the whole drop).
    """
    checkpoint = checkpoint or scratch_path(spark, "monthly-drop-checkpoint")
    micro = spark.readStream.schema(MICRO).parquet(drop_dir)

    def apply_batch(batch: DataFrame, epoch_id: int) -> None:
        # A backlog may bring several months in one batch: apply them in
        # calendar order, each behind the gate.  The month list of a batch is
        # a handful of dates (a plan parameter), not data.
        months = [r[0] for r in batch.select("date").distinct().orderBy("date").collect()]
        done = _marked_months(spark, checkpoint, "applied", epoch_id) if months else set()
        begun = _marked_months(spark, checkpoint, "begun", epoch_id) if months else set()
        for month in months:
            if month in done:
                continue
            if month not in begun:
                _mark(spark, checkpoint, "begun", epoch_id, month)
            panel = new_month_panel(batch.where(F.col("date") == F.lit(month)), dic, geo)
            update_store(spark, store_path, panel, resume=month in begun)
            _mark(spark, checkpoint, "applied", epoch_id, month)

    return (
        micro.writeStream.foreachBatch(apply_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def run_monthly_drop(
    spark: SparkSession, drop_dir: str, store_path: str, dic: DataFrame, geo: DataFrame, checkpoint: str | None = None
) -> None:
    q = start_monthly_drop(spark, drop_dir, store_path, dic, geo, checkpoint)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
