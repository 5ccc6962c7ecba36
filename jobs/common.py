"""What the jobs share: configuration, sessions of the command line, logs."""

from __future__ import annotations

import argparse
import json
import logging
from collections.abc import Callable, Sequence
from pathlib import Path

from pyspark.sql import SparkSession

log = logging.getLogger("jobs")


def read_config(spark: SparkSession, path: str | None, default: str) -> dict:
    """The settings of a JSON file, by Spark, so that it can be remote; those it lacks are of the job's own file beside it."""
    settings = json.loads(Path(__file__).with_name(default).read_text())
    if path:
        given = json.loads(spark.read.text(path, wholetext=True).first()[0])
        if unknown := given.keys() - settings.keys():
            raise ValueError(f"unknown settings: {', '.join(sorted(unknown))}")
        settings |= given
    return settings


def command_line(description: str, paths: Sequence[str], work: Callable[[SparkSession, argparse.Namespace], None], argv: Sequence[str] | None = None) -> None:
    """Parse --<path> for each of paths and --config, start a session, do the work and stop the session."""
    parser = argparse.ArgumentParser(description=description)
    for name in paths:
        parser.add_argument(f"--{name}", required=True, help="a path that Spark can read or write")
    parser.add_argument("--config", help="a JSON file of settings")
    args = parser.parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")
    spark = SparkSession.builder.appName(description).config("spark.sql.session.timeZone", "UTC").getOrCreate()
    try:
        work(spark, args)
    finally:
        spark.stop()
