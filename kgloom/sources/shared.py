"""Cutting lineage through the shared checkpoint folder that the cluster names."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame


def cut(df: DataFrame) -> DataFrame:
    """df checkpointed under spark.checkpoint.dir; a temporary folder stands in only where that is unset in local mode, as in tests."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        if not spark.conf.get("spark.checkpoint.dir", None) and not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="kgloom-"))
    return df.checkpoint()
