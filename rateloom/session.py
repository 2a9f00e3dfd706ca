"""Session builder with the settings every operator assumes."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """A session for local work; on a cluster the submitted configuration wins over DEFAULTS."""
    builder = SparkSession.builder.appName("rateloom")
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULTS)
    settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions or os.cpu_count() or 8)
    settings |= {k.replace("__", "."): v for k, v in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def table(spark: SparkSession, directory: str, name: str):
    """One parquet table (a file or a directory of files) of a data directory."""
    return spark.read.parquet(f"{directory}/{name}.parquet")
