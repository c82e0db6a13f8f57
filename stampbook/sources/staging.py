"""Writing a costly intermediate result once, in the folder all executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

SHARED_FOLDER = "spark.checkpoint.dir"


@cache
def _own_folder() -> str:
    folder = tempfile.mkdtemp(prefix="shared-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    A folder of this machine alone is used only where driver and executors are one process
    (master ``local``); on a cluster without the setting this raises.
    """
    folder = spark.conf.get(SHARED_FOLDER, None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.isLocal:
        raise ValueError(f"{SHARED_FOLDER} is not set")
    return _own_folder()


@contextmanager
def staged(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """``df`` written as a Parquet table in the shared folder and read back, for as long as the block lasts.

    Use it for a frame that several reports read. It runs a job, cuts the
    lineage and survives the loss of executors; the table goes when the block ends.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid4().hex}"
    df.write.parquet(path)
    try:
        yield spark.read.parquet(path)
    finally:
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
