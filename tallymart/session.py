"""A Spark session for local runs; on a cluster the submitted settings are used instead."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", name: str = "tallymart") -> SparkSession:
    partitions = str(os.cpu_count() if cores == "*" else cores)
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
