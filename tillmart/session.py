"""Spark session for jobs of our own, the bench and the tests."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def build_session(name: str = "tillmart", master: str | None = None) -> SparkSession:
    """Settings that a cluster has not made itself; anything set by spark-submit is kept."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = (
            builder.master(master)
            .config("spark.driver.memory", os.environ.get("TILLMART_DRIVER_MEMORY", "8g"))
            .config("spark.sql.shuffle.partitions", "8")
            .config("spark.ui.enabled", "false")
            .config("spark.ui.showConsoleProgress", "false")
        )
    return (
        builder.config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .getOrCreate()
    )
