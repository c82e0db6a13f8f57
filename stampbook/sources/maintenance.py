"""Table maintenance as DataFrame algebra: the result is written to a fresh version."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows replace target rows with equal keys; the others are kept.

    Keys match by plain equality, so a row with a NULL key is always inserted.
    The source is read twice, once for its keys; write a costly source to a
    staging table first.
    """
    return target.join(source.select(*keys).distinct(), list(keys), "left_anti").select(*target.columns).unionByName(
        source.select(*target.columns)
    )


def sync_replace(target: DataFrame, source: DataFrame) -> DataFrame:
    """Full sync: the target becomes the source, in the target's column order."""
    return source.select(*target.columns)


def delete_where(target: DataFrame, condition: Column) -> DataFrame:
    """Rows for which the condition is not true (NULL does not delete)."""
    return target.filter(~F.coalesce(condition, F.lit(False)))


def append_rows(target: DataFrame, rows: DataFrame) -> DataFrame:
    return target.unionByName(rows, allowMissingColumns=True)


def add_columns(table: DataFrame, defaults: Mapping[str, Column]) -> DataFrame:
    """Additive schema change: columns the table lacks are appended with their default."""
    missing = {name: value for name, value in defaults.items() if name not in table.columns}
    return table.withColumns(missing) if missing else table


def incremental_start(
    target: DataFrame, calendar_days: DataFrame, as_of: date, full_start: date, trailing_days: int = 31
) -> DataFrame:
    """Lower load bound as a one-row frame.

    The whole history when the target is empty or lacks a calendar day before
    the trailing window, otherwise the first day of that window.
    """
    cutoff = as_of - timedelta(days=trailing_days)
    due = calendar_days.filter(F.col("day_date").between(F.lit(full_start), F.lit(cutoff)))
    missing = due.join(target.select(F.col("full_date").alias("day_date")).distinct(), "day_date", "left_anti")
    gaps = missing.agg(F.count(F.lit(1)).alias("gaps")).scalar()
    full = (F.col("n") == 0) | (gaps > 0)
    return target.agg(F.count(F.lit(1)).alias("n")).select(
        F.when(full, F.lit(full_start)).otherwise(F.lit(cutoff + timedelta(days=1))).alias("load_from"),
        F.when(full, "full").otherwise("incremental").alias("mode"),
    )
