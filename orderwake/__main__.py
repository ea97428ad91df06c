"""Command line: python -m orderwake <clean folder> <target folder> [options]."""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import SparkSession

from .plans import pipeline
from .sources import Workspace


def main() -> None:
    parser = argparse.ArgumentParser(prog="orderwake", description="Build masters, metrics, targets and reports.")
    parser.add_argument("source", help="folder of clean tables")
    parser.add_argument("target", help="folder for stage tables and reports")
    parser.add_argument("--supporting", help="folder of supporting tables, if separate")
    parser.add_argument("--format", default="csv", help="format of the clean tables (default csv)")
    parser.add_argument(
        "--reference-date",
        type=dt.date.fromisoformat,
        default=dt.date.today(),
        help="day that aging counts to (default today)",
    )
    parser.add_argument("--discovery", action="store_true", help="also write the data discovery reports")
    parser.add_argument("--models", action="store_true", help="also train models and write forecasts")
    parser.add_argument("--exclude-leaky", action="store_true", help="train without the features that define the label")
    parser.add_argument("--resume", action="store_true", help="keep stages that an earlier run has finished from the same files")
    options = parser.parse_args()

    spark = SparkSession.builder.appName("orderwake").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    stages = pipeline.run(
        spark, options.source, options.target, options.reference_date, options.supporting, options.format, resume=options.resume
    )
    for name, rows in stages.rows.items():
        print(f"{name}: {rows:,} rows -> {stages.path(name)}")
    tables = {name: stages.load(name) for name in stages.rows}
    if options.discovery:
        pipeline.run_discovery(tables, options.target, options.reference_date)
    if options.models:
        pipeline.run_modelling(tables, Workspace(spark, "models"), options.target, options.exclude_leaky)


if __name__ == "__main__":
    main()
