"""Cutting lineage in the folder that all executors share."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared(spark: SparkSession) -> None:
    """Uses the folder the cluster names in spark.checkpoint.dir; one of this machine's only where master is local."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not context.isLocal:
            raise ValueError("spark.checkpoint.dir is not set")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="checkpoint-"))


def kept(df: DataFrame) -> DataFrame:
    """df, computed and written to the shared folder, without its lineage."""
    shared(df.sparkSession)
    return df.checkpoint()
