"""Session factory and the few session-level helpers that every part of the library shares."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def workers_find_package(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it, if that path exists there as well. Where it
    doesn't, install the package or ship it with ``--py-files``."""
    root, env = os.path.dirname(os.path.dirname(os.path.abspath(__file__))), spark.sparkContext.environment
    have = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in have:
        env["PYTHONPATH"] = os.pathsep.join([root, *have])


def build_session(app: str = "traceloom", master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """A session with UTC time, AQE and Arrow. A cluster's own settings win where ``master`` is None."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = builder.master(master).config("spark.driver.memory", "8g")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
