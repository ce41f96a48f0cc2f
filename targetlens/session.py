"""A local session for tests and measurements; on a cluster the caller brings its own."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import SparkSession


def local_session(cores: str | int | None = None) -> SparkSession:
    """Spark on this machine with as many shuffle partitions as cores."""
    cores = cores or os.environ.get("BENCH_CPUS", "8")
    # Python workers find the package wherever the session is started.
    root = str(Path(__file__).resolve().parent.parent)
    paths = os.environ.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        os.environ["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("targetlens")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    return spark
