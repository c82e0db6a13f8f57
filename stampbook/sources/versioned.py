"""A Parquet table kept as numbered versions, so that a read path is never overwritten."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


class VersionedTable:
    """``root/v=<n>`` folders on any Hadoop file system; the newest finished one is current.

    A version counts as finished once its ``_SUCCESS`` marker exists, which Spark
    writes on commit, so a job that dies half way leaves the old version current.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        """Finished versions in ascending order."""
        if not self._fs.exists(self._path(self.root)):
            return []
        found = []
        for status in self._fs.listStatus(self._path(self.root)):
            name = status.getPath().getName()
            if name.startswith("v=") and self._fs.exists(self._path(f"{self.root}/{name}/_SUCCESS")):
                found.append(int(name[2:]))
        return sorted(found)

    def exists(self) -> bool:
        return bool(self.versions())

    def read(self, version: int | None = None) -> DataFrame:
        chosen = version if version is not None else self.versions()[-1]
        return self.spark.read.parquet(f"{self.root}/v={chosen}")

    def write(self, df: DataFrame, partition_by: tuple[str, ...] = ()) -> int:
        """Write ``df`` (which may read the current version) as the next version."""
        finished = self.versions()
        number = finished[-1] + 1 if finished else 1
        # static: replaces what an unfinished write left, and marks the commit for partitioned tables too
        writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(f"{self.root}/v={number}")
        return number
