"""Session factory: UTC, adaptive execution, ANSI on, sized shuffle partitions."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def get_spark(app: str = "terrane", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings every plan here assumes; conf overrides them."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": os.environ.get("TERRANE_DRIVER_MEMORY", "8g"),
    } | {k.replace("__", "."): v for k, v in conf.items()}
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in settings.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()
