"""Per-key questions about day windows, answered without pairing rows.

Each operator first reduces its inputs to one row per (key, day), so a key that
holds a large share of all events still contributes at most one row per day to
its window, and then reads the answer off one ordered pass per key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BEFORE_ALL_DAYS = date(1000, 1, 1)


def window_sums(
    points: DataFrame,
    events: DataFrame,
    key: str,
    day: str,
    frames: Mapping[str, tuple[int, int]],
    measures: Sequence[str],
) -> DataFrame:
    """Sum each measure of ``events`` over ``[day + low, day + high]`` around each point.

    ``points`` and ``events`` both carry ``key`` and ``day``. Returns one row per
    distinct point with columns ``<frame>_<measure>``; NULL when the window is empty.
    """
    marks = points.select(key, day, F.lit(1).alias("_point"))
    merged = (
        events.select(key, day, *measures)
        .unionByName(marks, allowMissingColumns=True)
        .groupBy(key, day)
        .agg(*[F.sum(m).alias(m) for m in measures], F.max("_point").alias("_point"))
        .withColumn("_n", F.unix_date(day))
    )
    window = Window.partitionBy(key).orderBy("_n")
    answers = [
        F.sum(m).over(window.rangeBetween(low, high)).alias(f"{name}_{m}")
        for name, (low, high) in frames.items()
        for m in measures
    ]
    return merged.select(key, day, "_point", *answers).filter("_point = 1").drop("_point")


def next_event_day(points: DataFrame, events: DataFrame, key: str, day: str, alias: str = "next_day") -> DataFrame:
    """For each distinct point, the first event day on or after it (NULL if none)."""
    marks = points.select(key, day, F.lit(None).cast("date").alias("_event"))
    hits = events.select(key, day, F.col(day).alias("_event"))
    merged = hits.unionByName(marks).groupBy(key, day).agg(
        F.max("_event").alias("_event"), F.bool_or(F.col("_event").isNull()).alias("_point")
    )
    # descending order keeps this a growing frame, computed in one pass
    window = (
        Window.partitionBy(key)
        .orderBy(F.col(day).desc())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return merged.withColumn(alias, F.min("_event").over(window)).filter("_point").drop("_event", "_point")


def reach_in_windows(
    events: DataFrame,
    key: str,
    day: str,
    windows: DataFrame,
    window_key: str,
    start: str,
    end: str,
    alias: str = "reach",
    before: date | None = None,
) -> DataFrame:
    """Distinct keys with at least one event in each window ``[start, end]`` (one window per ``window_key``).

    Windows that go beyond the last event day end there: with ``before``, on the day before it.

    A key is counted for a window on its first event day inside it, that is on
    the event whose previous event lies before ``start``. Events therefore
    collapse to a count per (day, previous day), which is bounded by the
    calendar. From there on, one ordered pass per day answers "how many of this
    day's keys were last seen before s" for every start day s in use, and one
    ordered pass per start day adds the days up; windows only look their
    (start, end) pair up. No step depends on the number of events or windows.
    """
    days = events.select(key, day).distinct()
    previous = F.lag(day).over(Window.partitionBy(key).orderBy(day))
    gaps = (
        days.withColumn("_previous", F.coalesce(previous, F.lit(BEFORE_ALL_DAYS)))
        .groupBy(F.col(day).alias("_day"), F.col("_previous").alias("_seen"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_asks", F.lit(0))
    )
    last = F.col(end) if before is None else F.least(F.col(end), F.lit(before - timedelta(days=1)))
    spans = windows.select(window_key, F.col(start).alias("_start"), last.alias("_end")).filter("_start <= _end")
    asked = (
        spans.groupBy("_start")
        .agg(F.max("_end").alias("_last"))
        .select(
            F.explode(F.sequence("_start", "_last")).alias("_day"),
            F.col("_start").alias("_seen"),
            F.lit(0).cast("long").alias("_n"),
            F.lit(1).alias("_asks"),
        )
    )
    # at equal dates the question comes first: seen on the start day is not before it
    strictly_before = (
        Window.partitionBy("_day")
        .orderBy("_seen", F.col("_asks").desc())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    so_far = Window.partitionBy("_start").orderBy("_day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    reached = (
        gaps.unionByName(asked)
        .withColumn("_n", F.sum("_n").over(strictly_before))
        .filter("_asks = 1")
        .select(F.col("_seen").alias("_start"), F.col("_day").alias("_end"), F.col("_n"), "_day")
        .withColumn(alias, F.sum("_n").over(so_far))
        .select("_start", "_end", alias)
    )
    return spans.join(reached, ["_start", "_end"]).filter(F.col(alias) > 0).select(window_key, alias)
