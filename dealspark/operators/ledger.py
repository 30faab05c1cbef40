"""DQ-5: an append-only ledger of runs, and the growth between two of them.

A run is one row per table (run_id, attempt, run_at, tables, table_name,
row_count), where ``tables`` says how many rows belong to it. A run counts only
if all of them are there, so what a broken write left behind is passed over,
and of several complete attempts of one run the first one recorded stays.
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dealspark.operators.quality import volume_growth

SCHEMA = "run_id string, attempt string, run_at timestamp_ntz, recorded_at timestamp_ntz, tables int, table_name string, row_count long"


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(path)


def record_run(counts: DataFrame, path: str, run_id: str, run_at: _dt.datetime) -> bool:
    """Append the run ``run_id`` with ``counts`` (table_name, row_count: one row
    per table). A run that is already complete is left as it is (False)."""
    spark = counts.sparkSession
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    exists = at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)
    if exists and not complete_runs(read_ledger(spark, path)).where(F.col("run_id") == run_id).isEmpty():
        return False
    size = F.count(F.lit(1)).over(Window.partitionBy(F.lit(0)))  # one row per table
    counts.select(
        F.lit(run_id).alias("run_id"), F.lit(uuid.uuid4().hex).alias("attempt"), F.lit(run_at).cast("timestamp_ntz").alias("run_at"),
        F.current_timestamp().cast("timestamp_ntz").alias("recorded_at"), size.cast("int").alias("tables"),
        "table_name", F.col("row_count").cast("long")).write.mode("append").parquet(path)
    return True


def complete_runs(ledger: DataFrame) -> DataFrame:
    """(run_id, run_at, attempt) of each run whose rows are all there; the first complete attempt."""
    attempts = ledger.groupBy("run_id", "attempt", "run_at", "tables").agg(
        F.min("recorded_at").alias("recorded_at"), F.count_distinct("table_name").alias("found")).where("found = tables")
    return attempts.groupBy("run_id").agg(F.min(F.struct("recorded_at", "attempt", "run_at")).alias("a")).select(
        "run_id", "a.run_at", "a.attempt")


def growth_between_runs(ledger: DataFrame) -> DataFrame:
    """Row-count change per table from the last complete run but one to the last
    (by run_at, then run_id), with both run ids; no rows with fewer than two runs."""
    last = complete_runs(ledger).orderBy(F.col("run_at").desc(), F.col("run_id").desc()).limit(2).agg(
        F.sort_array(F.collect_list(F.struct("run_at", "run_id", "attempt")), asc=False)).first()[0]  # two runs at most
    current, previous = [*[(r["run_id"], r["attempt"]) for r in last], (None, None), (None, None)][:2]

    def rows(run: tuple[str | None, str | None]) -> DataFrame:
        of_run = (F.col("run_id") == F.lit(run[0])) & (F.col("attempt") == F.lit(run[1]))
        return ledger.where(of_run & F.lit(previous[0] is not None)).dropDuplicates(["table_name"])

    grown = volume_growth(rows(previous), rows(current))
    return grown.select(F.lit(previous[0]).cast("string").alias("previous_run"), F.lit(current[0]).cast("string").alias("current_run"),
                        *grown.columns)
