"""Session construction and the shared folder used for checkpoints and written tables.

On a cluster the shared folder comes from ``spark.checkpoint.dir`` (set by the
cluster); only when it is unset (unit tests, a laptop) do we pick our own.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "screenlake") -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or os.environ.get("SCREENLAKE_MASTER") or f"local[{cpus}]"
    parts = shuffle_partitions or int(os.environ.get("SCREENLAKE_SHUFFLE_PARTITIONS", cpus))
    spark = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("SCREENLAKE_DRIVER_MEMORY", "16g"))
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Checkpoint folder named by the cluster; a private one only in local mode without any."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="screenlake-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused path under the shared folder for a written table."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/screenlake-tables/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into the shared folder (survives executor loss)."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def stored(df: DataFrame, name: str = "stored") -> DataFrame:
    """``df`` computed once, into a Parquet table of the shared folder; readers take only the columns they use."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
