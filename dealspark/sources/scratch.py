"""Intermediate tables: written once, read by every branch that needs them.

They lie under the cluster's shared ``spark.checkpoint.dir``. Reading them back
cuts lineage, so a lost executor recomputes its own step only, and a plan that
uses a table in several branches holds one narrow scan per branch instead of
the whole derivation. ``release`` deletes what a session has written, once the
results that read it are consumed.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_made: dict[str, list[str]] = {}


def shared_root(spark: SparkSession) -> str:
    """The folder that the driver and all executors share.

    ``spark.checkpoint.dir`` where it is set, else the folder given to
    ``SparkContext.setCheckpointDir``. Without either, a local session gets a
    temporary folder; a cluster session gets an error, as a folder of the
    driver's own machine is not seen by its executors.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if not context.getCheckpointDir():
        master = context.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="dealspark-scratch-"))
    return context.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path for an intermediate table."""
    path = f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"
    _made.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to an intermediate table and read it back."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def mark(spark: SparkSession) -> int:
    """How many intermediate paths this session has made so far, for ``release``."""
    return len(_made.get(spark.sparkContext.applicationId, []))


def release(spark: SparkSession, since: int = 0, until: int | None = None) -> int:
    """Delete the intermediate tables made after ``mark`` returned ``since`` and
    before it returned ``until``. Frames that read them must be consumed
    before. Returns the number of deleted paths."""
    paths = _made.get(spark.sparkContext.applicationId, [])
    gone = paths[since:until]
    for p in gone:
        delete(spark, p)
    del paths[since:until]
    return len(gone)


def delete(spark: SparkSession, path: str) -> bool:
    """Delete a path on whatever file system it lies."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)
