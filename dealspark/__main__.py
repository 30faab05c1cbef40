"""Command line for the layered run: ``python -m dealspark <step> --root ...``.

Steps: ``raw-to-clean``, ``clean-to-curated``, ``analysis``, ``train``.
Under ``spark-submit`` the session comes from the cluster configuration.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys

from pyspark.sql import SparkSession

from dealspark.plans import layered
from dealspark.plans.profiles import PROFILES
from dealspark.sources.layers import Layout
from dealspark.schemas import features_schema
from dealspark.sources.readers import read_parquet, read_typed_csv


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="dealspark", description=__doc__)
    sub = p.add_subparsers(dest="step", required=True)
    for name in ("raw-to-clean", "clean-to-curated", "analysis", "train"):
        s = sub.add_parser(name)
        s.add_argument("--root", required=True, help="layer root: {root}/{bronze,silver,gold}/...")
    sub.choices["raw-to-clean"].add_argument("--buckets", type=int, default=None)
    cc = sub.choices["clean-to-curated"]
    cc.add_argument("--as-of", required=True, type=dt.date.fromisoformat)
    cc.add_argument("--profile", default="notebook", choices=sorted(PROFILES))
    cc.add_argument("--revenue-unit", type=float, default=None)
    cc.add_argument("--bucketed", action="store_true")
    sub.choices["analysis"].add_argument("--out", required=True)
    tr = sub.choices["train"]
    tr.add_argument("--model-output", required=True)
    tr.add_argument("--features-csv", default=None,
                    help="typed features CSV with a header; default: {root}/gold/customer_features")
    tr.add_argument("--prefer", default="gbt", choices=("gbt", "rf"))
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    args = _parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"dealspark-{args.step}").getOrCreate()
    layout = Layout(args.root)
    if args.step == "raw-to-clean":
        out = layered.bronze_to_silver(spark, layout, buckets=args.buckets)
    elif args.step == "clean-to-curated":
        profile = PROFILES[args.profile]
        if args.revenue_unit:
            profile = profile.with_(revenue_unit=args.revenue_unit)
        out = layered.silver_to_gold(spark, layout, args.as_of, profile, bucketed=args.bucketed)
    elif args.step == "analysis":
        out = layered.analysis(spark, layout, args.out)
    else:
        if args.features_csv:
            header = spark.read.option("header", True).csv(args.features_csv).columns
            feats = read_typed_csv(spark, args.features_csv, features_schema(header))
        else:
            feats = read_parquet(spark, layout.gold("customer_features"))
        best, metrics = layered.train_lead_model(spark, feats, args.model_output, prefer=args.prefer)
        out = {"model": best, "path": args.model_output,
               "metrics": [r.asDict() for r in metrics.collect()]}
    print(json.dumps(out, default=str))
    return out


if __name__ == "__main__":
    main(sys.argv[1:])
