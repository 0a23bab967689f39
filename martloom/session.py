"""Session for tests and benchmarks. Library code takes whatever session it is given."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("martloom")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if folder := os.environ.get("MARTLOOM_SCRATCH"):  # else the session's own setting
        builder = builder.config("spark.checkpoint.dir", folder)
    return builder.getOrCreate()
