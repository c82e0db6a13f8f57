"""Date predicates that stay pushable, and the retail calendar."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def on_days(ts: str | Column, start: date | None, end: date | None) -> Column:
    """``ts`` falls in ``[start, end)``, written on the raw column so that it reaches the scan.

    The bounds are date literals: Spark folds them to the column's own type, so
    the filter is pushed down for dates and for both timestamp types.
    """
    column = F.col(ts) if isinstance(ts, str) else ts
    test = None
    if start is not None:
        test = column >= F.lit(start)
    if end is not None:
        below = column < F.lit(end)
        test = below if test is None else test & below
    if test is None:
        return column.isNotNull()
    return test


def day_window(day: str | Column, as_of: date, first: int, last: int) -> Column:
    """``day`` lies in ``[as_of - first, as_of - last]``, both ends included."""
    column = F.col(day) if isinstance(day, str) else day
    return column.between(F.lit(as_of - timedelta(days=first)), F.lit(as_of - timedelta(days=last)))


def month_key(day: str | Column) -> Column:
    return F.date_format(F.col(day) if isinstance(day, str) else day, "yyyy-MM")


def retail_calendar(spark: SparkSession, start: date, end: date) -> DataFrame:
    """One row per day in ``[start, end]`` with its Saturday-to-Friday retail week.

    A week belongs to the calendar year of its closing Friday and is numbered
    by that Friday's position in the year, giving ``retail_week`` as yyyyww.
    """
    days = spark.range(0, (end - start).days + 1).select(
        F.date_add(F.lit(start), F.col("id").cast("int")).alias("day_date")
    )
    friday = F.date_add("day_date", F.pmod(F.lit(6) - F.dayofweek("day_date"), F.lit(7)))
    return (
        days.withColumn("_friday", friday)
        .withColumn("retail_year", F.year("_friday"))
        .withColumn(
            "retail_week",
            (F.col("retail_year") * 100 + F.ceil(F.dayofyear("_friday") / F.lit(7))).cast("int"),
        )
        .select("day_date", "retail_week", "retail_year")
    )
