"""Session construction and small cluster-safety helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def get_session(master: str | None = None, app: str = "panelkit", shuffle_partitions: int | None = None) -> SparkSession:
    """Build (or reuse) a session with AQE, skew handling and UTC time.

    On a cluster (no ``master`` given) the shuffle width and the checkpoint
    folder come from the submitter's configuration; AQE coalesces the
    cluster's shuffle partitions at run time.  Only local runs (tests, the
    bench) pin the shuffle width to the local core count.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    if shuffle_partitions is None and master and master.startswith("local"):
        shuffle_partitions = int(os.environ.get("BENCH_CPUS", "8"))
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = (
        builder.config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Skip per-call Python call-site capture (driver-side plan build cost).
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared folder named by ``spark.checkpoint.dir``.

    The setting is read from the session.  Only a local-mode session (tests,
    the bench) without the setting gets a private folder under the system
    temp directory; a cluster session without it is an error, because a
    machine-local folder is invisible to the other executors.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        master = spark.sparkContext.master
        if not master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        conf_dir = tempfile.mkdtemp(prefix="panelkit-ckpt-")
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(conf_dir)
    return conf_dir.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused sub-folder of the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared folder (survives executor loss)."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def literal_table(spark: SparkSession, rows: list[tuple], schema: StructType) -> DataFrame:
    """A small fixed table as an inline ``VALUES`` relation.

    Unlike ``createDataFrame`` (a Python-side RDD with unknown size) this is
    a local relation with exact size statistics, from which Spark decides
    between a broadcast and a shuffle join
    (``autoBroadcastJoinThreshold``); the engine places no hint.
    """
    names = [f.name for f in schema.fields]
    args: dict[str, object] = {}
    tuples = []
    for i, row in enumerate(rows):
        marks = []
        for j, v in enumerate(row):
            args[f"p{i}_{j}"] = v
            marks.append(f":p{i}_{j}")
        tuples.append("(" + ", ".join(marks) + ")")
    sql = f"SELECT * FROM VALUES {', '.join(tuples)} AS t({', '.join(names)})"
    df = spark.sql(sql, args=args).select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
    return df
