"""Session settings, shared scratch space and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Text rows are wide: Arrow batches are bounded by bytes as well as by rows.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "64MB",
    "spark.sql.parquet.compression.codec": "zstd",
}


def build_session(app_name: str = "corpusloom", master: str | None = None, **extra: str) -> SparkSession:
    """Create (or reuse) a session with the recommended settings; ``extra`` keys use ``_`` for ``.``."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in RECOMMENDED.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("_", "."), value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a ``local`` master may fall back to a temporary folder: there driver and executors are one process.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    root = tempfile.mkdtemp(prefix="corpusloom-")
    spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared root."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"


# Inputs of more splits than this are never redistributed: moving them would cost more than idle cores do.
_FEW_SPLITS = 16


def spread(scan: DataFrame, *keys: str) -> DataFrame:
    """Distribute a small scan over all cores before expensive per-row work.

    A file of a single row group is one task however many cores there are. Scans of many splits, and scans that
    already have a split per core, are returned unchanged. Pass a plain scan: its plan is inspected.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    splits = scan.rdd.getNumPartitions()
    return scan.repartition(cores, *keys) if splits < min(cores, _FEW_SPLITS) else scan


def cut_lineage(df: DataFrame) -> DataFrame:
    """Store ``df`` as a table below the shared root and read it back.

    Loops then neither replay their history nor lose data with an executor, and unlike a checkpoint of rows the table is
    compressed, column-pruned and of known size to the optimizer.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "step")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
