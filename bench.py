"""Benchmark: headline queries and the layered pipeline on the benchmark tables.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Prints one JSON line: {"metric", "value", "unit", "queries", "sf", ...}.
Each query runs to completion through the ``noop`` sink (the full plan
executes, nothing is collected). One untimed warm-up pass of the flagship
query on the same data first, so JVM start-up and JIT compilation are not
charged to whichever query happens to run first.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import re
import shutil
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from dealspark.plans import layered  # noqa: E402
from dealspark.plans.registry import BENCH_NOTEBOOK, REGISTRY  # noqa: E402
from dealspark.session import local_session  # noqa: E402
from dealspark.sources import driver_tables as dt_  # noqa: E402
from dealspark.sources.layers import Layout  # noqa: E402
from dealspark.sources.sinks import write_csv  # noqa: E402

HEADLINE = [
    "customer_features", "interaction_metrics", "deal_metrics", "sales_summary",
    "channel_performance", "top_customers", "leads_clean", "eda_customer_features",
    "value_distribution", "descriptive_stats", "clean_layer_metrics", "channel_response_time",
    "train_test_split", "analysis_report", "ml_labels", "column_stats",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def spread(spark, sf_dir: str, files: int) -> str:
    """A copy of the benchmark tables in several files each (untimed): the
    originals are single row groups, which one task would read."""
    out = tempfile.mkdtemp(prefix="dealspark-bench-in-")
    for t in ("customer", "orders", "events", "part", "nation", "region"):
        spark.read.parquet(f"{sf_dir}/{t}.parquet").repartition(files if t not in ("nation", "region") else 1).write.parquet(
            f"{out}/{t}.parquet")
    return out


def timed(fn) -> float:
    t0 = time.perf_counter()
    fn()
    return round(time.perf_counter() - t0, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, shuffle_partitions=int(cpus) * 2, app="dealspark-bench")
    sf_dir = spread(spark, sf_dir, int(cpus) * 2)
    run(REGISTRY["customer_features"](spark, sf_dir))  # untimed warm-up

    times = {name: timed(lambda n=name: run(REGISTRY[n](spark, sf_dir))) for name in HEADLINE}

    # Layered run: raw CSV files → clean Parquet → curated Parquet.
    work = tempfile.mkdtemp(prefix="dealspark-bench-")
    layout = Layout(work)
    for e in layered.ENTITIES:
        write_csv(dt_.RAW[e](spark, sf_dir), layout.bronze(e))
    times["raw_to_clean_run"] = timed(lambda: layered.bronze_to_silver(spark, layout))
    times["clean_to_curated_run"] = timed(
        lambda: layered.silver_to_gold(spark, layout, dt_.AS_OF, BENCH_NOTEBOOK))
    shutil.rmtree(work, ignore_errors=True)

    sf = re.search(r"sf([0-9.]+)", os.environ.get("BENCH_SF_DIR", "sf0.1"))
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf.group(1)) if sf else os.environ["BENCH_SF_DIR"],
        "cpus": int(cpus),
        "spark": spark.version,
        "date": dt.date.today().isoformat(),
    }))


if __name__ == "__main__":
    main()
