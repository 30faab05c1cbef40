"""Session helpers for tests, the benchmark and local runs."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

from dealspark.sources.scratch import shared_root


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "dealspark") -> SparkSession:
    """A local session with the settings the library assumes: UTC session
    time zone, AQE with partition coalescing and skew-join splitting."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("DEALSPARK_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, folder: str | None = None) -> str:
    """Use ``folder``, else the cluster's ``spark.checkpoint.dir``; where both
    are missing, a local session gets a temporary folder and a cluster session
    an error (``sources.scratch.shared_root``)."""
    root = folder or shared_root(spark)
    spark.sparkContext.setCheckpointDir(root)
    return root
