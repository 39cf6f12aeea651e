"""Session defaults for the pipeline. Nothing in the library depends on them for right results."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app: str = "shopstrata", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution, UTC and ANSI mode; ``conf`` keys use __ for dots.

    The number of shuffle partitions is left to adaptive execution: it starts high (set
    ``spark__sql__shuffle__partitions`` to 2-3x the cores of the cluster) and merges small ones.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
