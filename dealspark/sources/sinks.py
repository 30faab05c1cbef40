"""SNK-1..4: writers. Each write is one job; the next layer reads the files
back, which also cuts the lineage between layers."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dealspark.sources.scratch import delete

#: Names inside a published table's folder; Spark's readers pass over names with an underscore.
POINTER, VERSIONS = "_current", "_versions"


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] | None = None,
                  mode: str = "overwrite") -> None:
    """SNK-1/2: overwrite a Parquet table, optionally partitioned by columns."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """SNK-3: CSV export with a header (one file per partition)."""
    df.write.mode(mode).option("header", True).csv(path)


def save_bucketed(df: DataFrame, table: str, path: str, bucket_by: str, buckets: int,
                  mode: str = "overwrite") -> None:
    """Write a catalog table bucketed and sorted by ``bucket_by`` at ``path``.

    Later aggregations and joins on that key read the buckets as ready-made
    hash partitions, so they need no shuffle; two tables with the same bucket
    count join bucket by bucket. Needs a catalog (a Hive metastore or the
    session's in-memory catalog in tests).
    """
    (df.write.mode(mode).option("path", path).bucketBy(buckets, bucket_by)
     .sortBy(bucket_by).saveAsTable(table))


def publish(df: DataFrame, path: str, partition_by: Sequence[str] | None = None, keep: int = 1) -> str:
    """SNK-1/2, safe against failure: write a new version beside the old one,
    then switch the pointer to it in one rename.

    A write that breaks leaves the pointer, and so every reader, at the old
    version; its files are left over under ``_versions`` and go with the next
    publication. ``keep`` older versions stay, for readers that are still at
    work. One writer per table at a time. Returns the new version's path.
    """
    spark = df.sparkSession
    version = uuid.uuid4().hex
    write_parquet(df, f"{path}/{VERSIONS}/{version}", partition_by, "errorifexists")
    old = _pointed(spark, path)
    _point(spark, path, [version, *old][:keep + 1])
    for name in _folders(spark, f"{path}/{VERSIONS}"):
        if name not in [version, *old][:keep + 1]:
            delete(spark, f"{path}/{VERSIONS}/{name}")
    return f"{path}/{VERSIONS}/{version}"


def published_path(spark: SparkSession, path: str) -> str:
    """The folder of a table's current version: where its pointer leads, or ``path`` itself if it has none."""
    versions = _pointed(spark, path)
    return f"{path}/{VERSIONS}/{versions[0]}" if versions else path


def _fs(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def _folders(spark: SparkSession, path: str) -> list[str]:
    at, fs = _fs(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []


def _pointed(spark: SparkSession, path: str) -> list[str]:
    """The versions a pointer names, newest first."""
    at, fs = _fs(spark, f"{path}/{POINTER}")
    if not fs.exists(at):
        return []
    stream = fs.open(at)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").split()
    finally:
        stream.close()


def _point(spark: SparkSession, path: str, versions: list[str]) -> None:
    """Write the pointer beside its place and rename it over the old one."""
    jvm = spark._jvm
    new, fs = _fs(spark, f"{path}/_next-{uuid.uuid4().hex}")
    stream = fs.create(new, False)
    stream.write(bytearray(" ".join(versions).encode()))
    stream.close()
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(new.toUri(), spark._jsc.hadoopConfiguration()) \
        if new.toUri().getScheme() else jvm.org.apache.hadoop.fs.FileContext.getFileContext(spark._jsc.hadoopConfiguration())
    over = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    over[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    files.rename(new, jvm.org.apache.hadoop.fs.Path(f"{path}/{POINTER}"), over)


def write_split(df: DataFrame, valid: Column, path: str) -> tuple[DataFrame, DataFrame]:
    """DQ-2: write the rows that pass ``valid`` and the others (NULL: others)
    apart, from one scan; returns (valid, quarantined) as read back."""
    parted = df.withColumn("__valid", F.coalesce(valid, F.lit(False)))
    parted.write.mode("errorifexists").partitionBy("__valid").parquet(path)
    back = df.sparkSession.read.schema(parted.schema).parquet(path)
    return back.where("__valid").drop("__valid"), back.where("not __valid").drop("__valid")
