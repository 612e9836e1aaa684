"""Spark session helpers.

Cluster jobs get their session from the platform; ``local_session`` is for
tests and the bench.  The checkpoint directory is read from the session and
set only in local mode; a cluster session without one is an error.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "tillcast") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, naming a scratch one only if unset."""
    current = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if current:
        spark.sparkContext.setCheckpointDir(current)
        return current
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir is not set: name a folder that driver and executors share")
    path = tempfile.mkdtemp(prefix="tillcast-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def stage(df, how: str = "parquet"):
    """Cut lineage by writing ``df`` into the shared ``spark.checkpoint.dir``.

    ``parquet`` (default): a Parquet table in that folder, read back — every
    later branch gets vectorised, column-pruned, filter-pushed scans (the
    hash partitioning is not carried over).  ``checkpoint``: a reliable RDD
    checkpoint, which keeps the output partitioning but stores whole rows.
    Both survive executor loss, unlike a local checkpoint.
    """
    from pyspark import StorageLevel
    base = ensure_checkpoint_dir(df.sparkSession)
    if how == "parquet":
        import uuid
        path = f"{base.rstrip('/')}/stage-{uuid.uuid4().hex}"
        df.write.parquet(path)
        return df.sparkSession.read.parquet(path)
    # persist first: a reliable checkpoint otherwise computes the plan twice
    # (once for the eager count, once for the write job)
    cached = df.persist(StorageLevel.MEMORY_AND_DISK)
    out = cached.checkpoint(eager=True)
    cached.unpersist()
    return out
