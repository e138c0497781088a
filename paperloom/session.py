"""Session factory: UTC, adaptive execution, and a shuffle width that follows the cores at hand."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import SparkSession


def session(cores: int | str = "*", shuffle: int | None = None, **conf: str) -> SparkSession:
    """A local session for tests and benches; on a cluster use the one that spark-submit makes."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("paperloom")
    settings = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.shuffle.partitions": str(shuffle or 8),
        "spark.driver.memory": "8g",
        **conf,
    }
    return builder.config(map=settings).getOrCreate()


def find_package(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver did, whatever their working folder.

    Where executors have no such folder, submit the package with ``--py-files``.
    """
    root = str(Path(__file__).resolve().parent.parent)
    known = [p for p in spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in known:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *known])
