"""The Spark session of tests and benchmarks."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def new_session(cpus: str = "8", **conf: str) -> SparkSession:
    scratch = tempfile.mkdtemp(prefix="snapsync-session-")
    builder = (
        # As on a cluster, a task that fails is run again.
        SparkSession.builder.master(f"local[{cpus},3]")
        .appName("snapsync")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.scheduler.mode", "FAIR")
        .config("spark.checkpoint.dir", f"{scratch}/shared")
        .config("spark.sql.warehouse.dir", f"{scratch}/warehouse")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("OFF")
    return spark
