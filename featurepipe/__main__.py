"""Command line: ``python -m featurepipe build --raw DIR --out DIR`` and
``python -m featurepipe train --processed DIR --out DIR``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="featurepipe")
    sub = ap.add_subparsers(dest="cmd", required=True)
    b = sub.add_parser("build", help="bronze -> silver -> hooks -> gates -> gold, with profiles")
    b.add_argument("--raw", required=True)
    b.add_argument("--out", required=True)
    b.add_argument("--format", default="csv", choices=["csv", "parquet"])
    b.add_argument("--approx-profile", action="store_true")
    t = sub.add_parser("train", help="candidates, 5-fold CV, best model, predictions, report")
    t.add_argument("--processed", required=True)
    t.add_argument("--out", required=True)
    t.add_argument("--format", default="csv", choices=["csv", "parquet"])
    t.add_argument("--quick", action="store_true", help="small candidate sizes")
    args = ap.parse_args(argv)
    spark = SparkSession.builder.appName("featurepipe").getOrCreate()
    if args.cmd == "build":
        from featurepipe.plans.build import run_build
        run_build(spark, args.raw, args.out, fmt=args.format, approx_profile=args.approx_profile)
    else:
        from featurepipe.operators.model import ModelSettings
        from featurepipe.plans.train import run_train
        run_train(spark, args.processed, args.out, settings=ModelSettings.quick() if args.quick else ModelSettings(),
                  fmt=args.format)


if __name__ == "__main__":
    main()
