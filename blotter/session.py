"""Spark sessions for tests, benchmarks and local use."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cores: str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session on this machine. On a cluster, use the session the cluster provides."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("blotter")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
