"""Cutting lineage between stages whose plans would otherwise hold their inputs several times over."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame


def cut(df: DataFrame) -> DataFrame:
    """The rows from a reliable checkpoint in the shared folder that spark.checkpoint.dir names."""
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base and not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        context.setCheckpointDir(base or tempfile.mkdtemp(prefix="plexframe-"))
    return df.checkpoint()
