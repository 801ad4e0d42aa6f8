"""Session settings for tests and the benchmark. A cluster brings its own session."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(app: str = "docloom", cpus: str | int = "*", shuffle_partitions: int = 8) -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", os.environ.get("DOCLOOM_DRIVER_MEMORY", "12g"))
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
