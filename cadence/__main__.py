"""Run the whole job: ``python -m cadence --data DIR --out DIR [--config FILE]``.

Builds the feature mart and labels, fits the model grid, calibrates, scores
every customer, computes the signal table and the walk-forward validation,
and writes all tables and models under ``--out`` (a shared folder on a
cluster). ``--config`` is a JSON file on the driver with mappings, windows,
folds and parameters (see :mod:`cadence.plans.settings`). Uses the active Spark
session when there is one.
"""

from __future__ import annotations

import argparse
import json
from dataclasses import replace
from pathlib import Path

from pyspark.sql import SparkSession

from cadence.plans.pipeline import ModelRun, RunConfig, save_run
from cadence.plans.settings import run_config
from cadence.session import ensure_checkpoint_dir


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    ap = argparse.ArgumentParser(prog="cadence")
    ap.add_argument("--data", required=True, help="folder with customer/orders/... parquet tables")
    ap.add_argument("--out", required=True, help="output folder for result tables and models")
    ap.add_argument("--config", default=None, help="JSON file with mappings, windows, folds and parameters")
    ap.add_argument("--select-on", default=None, choices=["val", "test"])
    ap.add_argument("--shuffle-partitions", type=int, default=None,
                    help="override spark.sql.shuffle.partitions (default: the session's)")
    return ap.parse_args(argv)


def configuration(args: argparse.Namespace) -> RunConfig:
    cfg = run_config(Path(args.config).read_text()) if args.config else RunConfig()
    return replace(cfg, select_on=args.select_on) if args.select_on else cfg


def main(argv: list[str] | None = None) -> None:
    args = arguments(argv)
    cfg = configuration(args)
    spark = (SparkSession.builder.appName("cadence")
             .config("spark.ui.enabled", "false")
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.sql.adaptive.skewJoin.enabled", "true")
             .getOrCreate())
    if args.shuffle_partitions:
        spark.conf.set("spark.sql.shuffle.partitions", str(args.shuffle_partitions))
    ensure_checkpoint_dir(spark)
    print(json.dumps(save_run(ModelRun(spark, args.data, cfg), args.out), indent=1))


if __name__ == "__main__":
    main()
