"""Session builder with the settings the engine is tested under."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def build_session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution, UTC and Arrow transfer.

    ``master`` is left to spark-submit when it is None.  Partition counts are
    left to Spark and to the cluster's own settings unless given in ``conf``.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.showConsoleProgress": "false",
    } | {k.replace("__", "."): v for k, v in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def local_session(cpus: int | None = None, memory: str = "8g") -> SparkSession:
    """A local session for tests and the bench."""
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    return build_session(
        "tidemark-local",
        f"local[{cpus}]",
        **{
            "spark.driver.memory": memory,
            "spark.sql.shuffle.partitions": str(cpus),
            "spark.ui.enabled": "false",
        },
    )
