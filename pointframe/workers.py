"""Let Python workers find this package wherever the driver was started."""

from __future__ import annotations

import functools
import os
from collections.abc import Callable

from pyspark.sql import SparkSession

_ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def importable(spark: SparkSession) -> None:
    """Put the package's parent folder on the workers' path. A cluster that installs the package needs none of it."""
    env = spark.sparkContext.environment
    have = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if _ROOT not in have:
        env["PYTHONPATH"] = os.pathsep.join([_ROOT, *have])


def with_workers(query: Callable) -> Callable:
    """A query or stage, its session as first argument, that sees to ``importable`` first."""

    @functools.wraps(query)
    def run(spark: SparkSession, *args):
        importable(spark)
        return query(spark, *args)

    return run
