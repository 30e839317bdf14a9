"""Where lineage is cut: the folder that all executors share."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame


def cut(df: DataFrame) -> DataFrame:
    """The rows read back from a checkpoint in the folder of spark.checkpoint.dir; where that is unset, one of its own in local mode and an error on a cluster."""
    spark = df.sparkSession
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        known = spark.conf.get("spark.checkpoint.dir", None)
        if not known and not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(known or tempfile.mkdtemp(prefix="spark-checkpoint-"))
    return df.checkpoint(eager=True)
