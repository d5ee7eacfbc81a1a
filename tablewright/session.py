"""Session settings this package is written for."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

#: Settings that hold on a laptop and on a cluster alike.
COMMON_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Valid and rejected rows are written side by side, without sorting them apart.
    "spark.sql.maxConcurrentOutputFileWriters": "4",
    # Do not inspect the Python stack on every column operation.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.ui.enabled": "false",
}


def local_session(cpus: int | str | None = None, app_name: str = "tablewright") -> SparkSession:
    """A local session for tests and the benchmark.

    On a cluster the session comes from ``spark-submit``; nothing in the
    package depends on this function.
    """
    cpus = cpus or os.environ.get("BENCH_CPUS") or os.cpu_count() or 1
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEMORY", "8g"))
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in COMMON_SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
