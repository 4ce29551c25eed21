"""Thin ``spark-submit`` main over the job functions.

    spark-submit -m linclass.plans.cli logistic -f data.csv -t Creditability -c Purpose -r 0.05 -d out/
    spark-submit linclass/plans/cli.py enet -f data.csv -t Target -r 0.01 -l 0.8 -d out/

The master, memory and the shared ``spark.checkpoint.dir`` come from ``spark-submit``.
Prints the run record as one JSON line.
"""

from __future__ import annotations

import argparse
import json
import sys


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="linclass")
    p.add_argument("job", choices=["logistic", "enet", "svm", "ridge"])
    # The option letters and long names are the interface that users type.
    p.add_argument("-d", "--dir_path", help="output folder for the model and the report tables")
    p.add_argument("-f", "--input_file", required=True, help="file or folder (any Hadoop file system path)")
    p.add_argument("-s", "--separator", default=",")
    p.add_argument("-t", "--target_name", default=None, help="default: Target (Creditability for ridge)")
    p.add_argument("-c", "--cols_to_remove", nargs="*", default=[])
    p.add_argument("-p", "--penalty", default=None, choices=["l1", "l2", "none"], help="logistic, svm (default l2)")
    p.add_argument("-r", "--penalty_param", type=float, default=0.01, help="lambda")
    p.add_argument("-l", "--lasso_param", type=float, default=None, help="enet: L1 share (default 0.8)")
    p.add_argument("--mode", default=None, choices=["converged", "sgd"], help="logistic, svm (default converged)")
    p.add_argument("--iterations", type=int, default=None)
    p.add_argument("--key", default=None, help="column hashed for the split (default: a random number a row)")
    p.add_argument("--split", default="hash", choices=["hash", "random"])
    p.add_argument("--permissive", action="store_true", help="set bad rows aside instead of failing")
    p.add_argument("--profile", default=None, help="ridge: column profiled by class")
    return p


# options that only some jobs have; elsewhere they are refused
ONLY = {"penalty": ("logistic", "svm"), "mode": ("logistic", "svm"), "lasso_param": ("enet",), "profile": ("ridge",)}


def options(argv: list[str] | None = None) -> argparse.Namespace:
    p = parser()
    args = p.parse_args(argv)
    for name, jobs in ONLY.items():
        if getattr(args, name) is not None and args.job not in jobs:
            p.error(f"--{name} is not an option of the {args.job} job")
    if args.iterations is not None and args.iterations < 1:
        p.error("--iterations must be positive")
    return args


def run(spark, args: argparse.Namespace):
    from linclass.plans import jobs

    kw = dict(excluded=args.cols_to_remove, sep=args.separator, reg=args.penalty_param, out_dir=args.dir_path, key=args.key, split=args.split, strict=not args.permissive)
    if args.iterations is not None:
        kw["iterations"] = args.iterations
    if args.job == "ridge":
        return jobs.ridge_job(spark, args.input_file, response=args.target_name or "Creditability", profile_column=args.profile, **kw)
    kw["target"] = args.target_name or "Target"
    if args.job == "enet":
        return jobs.enet_job(spark, args.input_file, mix=0.8 if args.lasso_param is None else args.lasso_param, **kw)
    job = jobs.logistic_job if args.job == "logistic" else jobs.svm_job
    return job(spark, args.input_file, penalty=args.penalty or "l2", mode=args.mode or "converged", **kw)


def main(argv: list[str] | None = None) -> int:
    args = options(argv)
    from pyspark.sql import SparkSession

    spark = SparkSession.builder.appName(f"linclass-{args.job}").getOrCreate()
    res = run(spark, args)
    print(json.dumps(res.run.first().asDict(), default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
