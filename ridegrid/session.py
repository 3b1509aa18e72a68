"""Session and scratch-space helpers.

Everything that needs a durable intermediate (lineage cut, round-trip
scratch tables) goes under the cluster's shared ``spark.checkpoint.dir``.
Only when that setting is absent (local tests) do we pick our own folder.
"""
from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "ridegrid") -> SparkSession:
    """Session with the settings the library is tuned for (local runs, tests)."""
    spark = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of the cluster; set a local one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
    elif sc.master.startswith("local"):  # no setting: local runs and tests only
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="ridegrid-ckpt-"))
    else:
        # A driver-local folder is invisible to executors on a cluster.
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on HDFS or an "
                           "object store) for intermediate tables")
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the checkpoint root for a written table."""
    return f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def reliable_checkpoint(df: DataFrame, name: str = "lineage-cut") -> DataFrame:
    """Materialize ``df`` as a Parquet table in the shared checkpoint folder and read it back.

    Cuts the lineage (a lost executor re-reads the table instead of recomputing
    the plan) with ONE job; ``DataFrame.checkpoint(eager=True)`` runs a count job
    and then a second job that re-runs the final stage (from its shuffle files)
    to write the checkpoint.  Meant for small intermediate frames (bounds,
    hourly counts, histograms).
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
