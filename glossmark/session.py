"""Session defaults shared by tests, the bench and ad-hoc use."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(cpus: int | None = None, app: str = "glossmark", **conf: str) -> SparkSession:
    """A local session with UTC time, adaptive execution and few shuffle partitions."""
    n = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    builder = (
        SparkSession.builder.master(f"local[{n}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(n))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
