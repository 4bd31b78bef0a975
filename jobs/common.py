"""What the jobs share: options from a small JSON file, the command line, the session of the command line."""

from __future__ import annotations

import argparse
import json
import logging
from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession


def options(spark: SparkSession, path: str | None, defaults: dict[str, Any]) -> dict[str, Any]:
    """The defaults with what a JSON file says, read by Spark as its path may be remote; ValueError for an unknown name."""
    if not path:
        return dict(defaults)
    found = json.loads(spark.read.text(path, wholetext=True).first()[0])
    if unknown := sorted(set(found) - set(defaults)):
        raise ValueError(f"{path} has unknown options {unknown}; known: {sorted(defaults)}")
    return defaults | found


def command(name: str, about: str, run: Callable[..., DataFrame], argv: list[str] | None = None) -> None:
    """Runs a job from the command line, with a session of its own."""
    parser = argparse.ArgumentParser(prog=name, description=about)
    parser.add_argument("--tables", required=True, help="folder that holds the tables")
    parser.add_argument("--out", required=True, help="folder of the output")
    parser.add_argument("--config", help="JSON file with options")
    given = parser.parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")
    logging.getLogger("py4j").setLevel(logging.WARNING)
    spark = SparkSession.builder.appName(name).getOrCreate()
    try:
        run(spark, given.tables, given.out, given.config)
    finally:
        spark.stop()
