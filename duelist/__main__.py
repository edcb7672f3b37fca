"""Command line of the two jobs, for spark-submit: ``python -m duelist train|ab ...``."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import DataFrame, SparkSession

from duelist.operators import profile
from duelist.operators.models import EXPERIMENT
from duelist.plans.ab_test import ab_job
from duelist.plans.training import train_job
from duelist.sources.session import object_store_conf, session
from duelist.sources.tables import TRANSACTION_SCHEMA, read_csv, read_parquet


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="duelist", description="Train classifiers and A/B-test them")
    jobs = parser.add_subparsers(dest="job", required=True)
    common = argparse.ArgumentParser(add_help=False)
    common.add_argument("--input", required=True, help="table: parquet, or a path that ends in .csv")
    common.add_argument("--schema", help="columns and types as DDL, or 'transactions'; saves the pass that finds the types of a CSV")
    common.add_argument("--root", required=True, help="shared folder of the run tables")
    common.add_argument("--key", required=True, help="unique row key")
    common.add_argument("--label", default="tx_fraud")
    common.add_argument("--time", default="tx_timestamp")
    common.add_argument("--exclude", nargs="*", default=[], help="columns that are no features")
    common.add_argument("--weights", nargs=2, type=float, help="train and test weights; first and holdout weights")
    common.add_argument("--fractions", action="store_true", help="weights are fractions of the whole table")
    common.add_argument("--auc-bins", type=int, help="score steps of an approximate AUC (default: exact)")
    common.add_argument("--experiment-name", default=EXPERIMENT)
    common.add_argument("--s3-endpoint-url", help="credentials come from the cluster's own configuration")
    train = jobs.add_parser("train", parents=[common])
    train.add_argument("--output", help="model path (default: under --root)")
    train.add_argument("--model-type", default="rf", choices=["rf", "lr"])
    train.add_argument("--tune", help='values to try as JSON, e.g. {"maxDepth": [3, 5, 8]}; by successive halving')
    train.add_argument("--on-null", default="error", choices=["error", "skip", "impute"])
    train.add_argument("--auto-register", action="store_true")
    train.add_argument("--run-name")
    ab = jobs.add_parser("ab", parents=[common])
    ab.add_argument("--traffic-split", type=float, default=0.5)
    ab.add_argument("--test-name", default="ab_test")
    ab.add_argument("--auto-promote", action="store_true")
    return parser.parse_args(argv)


def load(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    schema = TRANSACTION_SCHEMA if schema == "transactions" else schema
    return (read_csv if path.rstrip("/").endswith(".csv") else read_parquet)(spark, path, schema)


def main(argv: list[str] | None = None) -> dict:
    """Runs a job, prints its result as JSON and returns it; errors are raised."""
    args = arguments(argv)
    spark = session(args.job, object_store_conf(args.s3_endpoint_url) if args.s3_endpoint_url else None)
    rows = load(spark, args.input, args.schema)
    shared = {
        "key": args.key, "label": args.label, "time": args.time, "exclude": tuple(args.exclude),
        "weights": args.weights, "experiment": args.experiment_name,
        "normalise": not args.fractions, "bins": args.auc_bins,
    }
    profile.preview(rows, args.key).show(truncate=False)
    if args.job == "train":
        run = train_job(
            spark, rows, args.root, model_type=args.model_type, on_null=args.on_null, run_name=args.run_name,
            tune=json.loads(args.tune) if args.tune else None, input_path=args.input, output_path=args.output, auto_register=args.auto_register,
            stage=args.input.rstrip("/").endswith(".csv"), **shared,
        )
        result = {"run_id": run.run_id, "run_name": run.run_name, "version": run.version, "dropped": run.dropped, **run.metrics}
    else:
        run = ab_job(
            spark, rows, args.root, traffic_split=args.traffic_split, test_name=args.test_name,
            auto_promote=args.auto_promote, **shared,
        )
        result = {"run_id": run.run_id, "status": run.status, "reason": run.reason}
        if run.report is not None:
            result |= {c: run.report[c] for c in ("winner", "should_promote", "promotion_status", "improvement_message")}
    run.profile.show(len(rows.columns), truncate=False)
    print(json.dumps(result))
    return result


if __name__ == "__main__":
    main()
