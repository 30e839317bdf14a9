"""Session settings that the operators rely on."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def session(cores: int | str = "*", name: str = "stationflow", **conf: str) -> SparkSession:
    """A local session; on a cluster, set the same options at submit. UTC keeps naive stamps naive, and adaptive plans split skewed joins."""
    options = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.shuffle.partitions": str(2 * (os.cpu_count() or 4)) if cores == "*" else str(2 * int(cores)),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "5g",
    } | conf
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name)
    for key, value in options.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
