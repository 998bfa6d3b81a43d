"""Session settings for local use; on a cluster the session comes configured."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(cores: str | None = None, shuffle: str | None = None) -> SparkSession:
    cores = cores or os.environ.get("BENCH_CPUS", "8")
    return (
        SparkSession.builder.master(f"local[{cores}]").appName("siltwork")
        .config("spark.sql.shuffle.partitions", shuffle or cores).config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
