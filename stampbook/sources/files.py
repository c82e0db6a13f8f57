"""Reading tables and dropped files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Parquet table ``<folder>/<name>.parquet``."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def catalog_tables(spark: SparkSession, database: str, pattern: str | None = None) -> dict[str, Callable[[], DataFrame]]:
    """Loader per table and view of a database, for the row-count monitor; ``pattern`` limits their names (``a*|b*``)."""
    tables = spark.catalog.listTables(database, pattern) if pattern else spark.catalog.listTables(database)
    paths = {t.name: f"`{t.name}`" if t.isTemporary else f"`{database}`.`{t.name}`" for t in tables}
    return {name: (lambda path=path: spark.table(path)) for name, path in paths.items()}


def newest_file(spark: SparkSession, folder: str) -> str:
    """Path of the most recently modified file in ``folder`` (contents are not read)."""
    listing = spark.read.format("binaryFile").load(folder).select("path", "modificationTime")
    newest = listing.agg(F.max_by("path", F.struct("modificationTime", "path")).alias("path")).first()
    if newest is None or newest["path"] is None:
        raise FileNotFoundError(f"no file in {folder}")
    return newest["path"]


def read_newest(spark: SparkSession, folder: str) -> DataFrame:
    """Newest CSV (with header) or Parquet file in ``folder``; the name tells the format."""
    path = newest_file(spark, folder)
    for fmt in ("csv", "parquet"):
        if f".{fmt}" in path:
            return spark.read.format(fmt).option("header", True).load(path)
    raise ValueError(f"file format unknown: {path}")
