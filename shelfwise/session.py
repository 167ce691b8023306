"""Session settings.

On a cluster the deployment sets the master, memory and parallelism; only the
settings that the plans rely on are fixed here.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

RELIED_ON = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def get_session(app_name: str = "shelfwise", **settings: str) -> SparkSession:
    """A session for a cluster; ``settings`` are passed on as they are.

    ANSI mode is left at Spark's default (on): the steps are null-safe without
    turning it off.
    """
    builder = SparkSession.builder.appName(app_name)
    for name, value in {**RELIED_ON, **settings}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def local_session(cores: int | str = "*", app_name: str = "shelfwise", **settings: str) -> SparkSession:
    """A one-machine session for tests and timings."""
    threads = 8 if cores == "*" else int(cores)
    local = {
        "spark.master": f"local[{cores}]",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
        "spark.sql.shuffle.partitions": str(threads),
    }
    return get_session(app_name, **{**local, **settings})
