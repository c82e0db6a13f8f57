"""Plain Parquet tables in period folders, of which a change rewrites only those that it touches."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stampbook.sources.maintenance import upsert
from stampbook.sources.staging import staged

FOLDER = "in_period"
COLUMNS = "_columns.json"
# fixed values: the date pattern of each grain
PATTERNS = {"day": "yyyy-MM-dd", "month": "yyyy-MM", "year": "yyyy"}


@dataclass(frozen=True)
class PeriodTable:
    """A Parquet table with a folder for each period (day, month or year) of the column ``day``, or each ``value`` of it.

    Any reader of partitioned Parquet can read it. Changes are worked out first and staged in the cluster's shared
    folder; then the folders they touch are replaced by Spark's dynamic partition overwrite, and folders that
    lose all rows are deleted. All others keep their files, and are not even read where the keys of a change contain
    ``day``. A change that is run again after a loss gives the same table. One writer at a time.
    """

    spark: SparkSession
    path: str
    day: str
    grain: str = "day"

    def _period(self) -> Column:
        text = F.col(self.day).cast("string") if self.grain == "value" else F.date_format(self.day, PATTERNS[self.grain])
        return F.concat(F.lit("p"), F.coalesce(text, F.lit("none")))  # not mistaken for a number or a date when read

    def _folder(self, period: str = ""):
        jvm = self.spark.sparkContext._jvm
        folder = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{FOLDER}={period}" if period else self.path)
        return folder, folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def exists(self) -> bool:
        """Whether the table has rows."""
        folder, files = self._folder()
        return bool(files.exists(folder) and any(s.getPath().getName().startswith(f"{FOLDER}=") for s in files.listStatus(folder)))

    def _stored(self) -> DataFrame:
        return self.spark.read.parquet(self.path)

    def read(self) -> DataFrame:
        """All rows; a table that lost all of them still has its columns."""
        if self.exists():
            return self._stored().drop(FOLDER)
        folder, files = self._folder()
        stream = files.open(folder.suffix(f"/{COLUMNS}"))
        try:
            text = bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()
        return self.spark.createDataFrame([], StructType.fromJson(json.loads(text)))

    def write(self, rows: DataFrame) -> None:
        """The table's whole content, replaced."""
        self._put(rows, "static")
        folder, files = self._folder()
        stream = files.create(folder.suffix(f"/{COLUMNS}"), True)
        try:
            stream.write(rows.schema.json().encode())
        finally:
            stream.close()

    def _put(self, rows: DataFrame, mode: str) -> None:
        # one file for each period and task; large periods are split by Spark's own advice on partition sizes
        dealt = rows.withColumn(FOLDER, self._period()).hint("rebalance", F.col(FOLDER))
        dealt.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy(FOLDER).parquet(self.path)

    def periods(self, rows: DataFrame) -> list[str]:
        """The periods of the rows: at most one value for each folder of the table."""
        return sorted(r[0] for r in rows.select(self._period().alias("p")).distinct().collect())

    def merge(self, changes: DataFrame, keys: Sequence[str]) -> list[str]:
        """Upserts ``changes`` by ``keys`` and returns the periods that were rewritten.

        A row whose key moves to another period leaves its old one. Without a table the changes become it.
        """
        if not self.exists():
            with staged(changes, "changes") as rows:
                touched = self.periods(rows)
                self.write(rows)
            return touched
        with staged(changes.select(*self.read().columns), "changes") as rows:
            touched = set(self.periods(rows))
            if self.day not in keys:
                touched |= set(self.periods(self.read().join(rows.select(*keys).distinct(), list(keys), "left_semi")))
            self._replace(sorted(touched), lambda current: upsert(current, rows, keys))
        return sorted(touched)

    def delete(self, doomed: DataFrame | Column) -> list[str]:
        """Deletes the rows that meet a condition, or that agree with a row of a frame in all its columns."""
        if not self.exists():
            return []
        if isinstance(doomed, DataFrame):
            with staged(doomed.distinct(), "doomed") as rows:
                on = rows.columns
                touched = self.periods(self.read().join(rows, on, "left_semi"))
                self._replace(touched, lambda current: current.join(rows, on, "left_anti"))
            return touched
        touched = self.periods(self.read().filter(doomed))
        self._replace(touched, lambda current: current.filter(~F.coalesce(doomed, F.lit(False))))
        return touched

    def replace(self, periods: Sequence[str], rows: DataFrame) -> None:
        """The given periods hold ``rows`` (of no other period) from now on."""
        if self.exists():
            self._replace(list(periods), lambda _: rows)
        else:
            with staged(rows, "first") as first:
                self.write(first)

    def of(self, periods: Sequence[str]) -> DataFrame:
        """The rows of some periods; only their folders are listed in the plan."""
        return self._stored().filter(F.col(FOLDER).isin(list(periods))).drop(FOLDER)

    def _replace(self, periods: list[str], change: Callable[[DataFrame], DataFrame]) -> None:
        if not periods:
            return
        columns = self.read().columns
        with staged(change(self.of(periods)).select(*columns), "rewritten") as rows:
            left = set(self.periods(rows))
            if left - set(periods):
                raise ValueError(f"rows outside the periods that are rewritten: {sorted(left - set(periods))[:5]}")
            if left:
                self._put(rows, "dynamic")
        for period in periods:
            if period not in left:
                folder, files = self._folder(period)
                files.delete(folder, True)
