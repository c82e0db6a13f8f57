"""Distinct keys with an event in intervals of time, exact to the timestamp.

Events first reduce to one row per key and day, with the first and last time of that day. Whole days are
answered by ``reach_in_windows``; only the two days on which an interval begins and ends are looked at in time.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stampbook.operators.windows import reach_in_windows


def merged_intervals(intervals: DataFrame, key: str, start: str, end: str) -> DataFrame:
    """key, start, end, intervals: the union of each key's intervals as disjoint ones, and how many it has."""
    ordered = Window.partitionBy(key).orderBy(start, end)
    before = F.max(end).over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    valid = intervals.select(key, start, end).distinct().filter(F.col(start) <= F.col(end))
    fresh = valid.withColumn("_fresh", F.coalesce((F.col(start) > before).cast("int"), F.lit(1)))
    run = fresh.withColumn("_run", F.sum("_fresh").over(ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    disjoint = run.groupBy(key, "_run").agg(F.min(start).alias(start), F.max(end).alias(end))
    return disjoint.withColumn("intervals", F.count(F.lit(1)).over(Window.partitionBy(key))).drop("_run")


def key_days(events: DataFrame, key: str, ts: str) -> DataFrame:
    """key, day, first and last time of the key's events on it."""
    return events.groupBy(key, F.to_date(ts).alias("day")).agg(F.min(ts).alias("first"), F.max(ts).alias("last"))


def _spans(intervals: DataFrame, start: str, end: str, before: date | None) -> DataFrame:
    """The intervals with their first and last day; those that go beyond the last event day end there."""
    last = F.to_date(end) if before is None else F.least(F.to_date(end), F.lit(before - timedelta(days=1)))
    return intervals.withColumns({"_from": F.to_date(start), "_to": last}).filter("_from <= _to")


def _paired(spans: DataFrame, days: DataFrame, events: DataFrame, window: str, key: str, ts: str, start: str, end: str) -> DataFrame:
    """Distinct (window, key) of events in the spans, pairing the days of both."""
    each = spans.filter("_from < _to").withColumn("day", F.explode(F.sequence("_from", "_to")))
    after = (F.col("day") > F.col("_from")) | (F.col("last") >= F.col(start))
    until = (F.col("day") < F.col("_to")) | (F.col("first") <= F.col(end))
    long = each.join(days, "day").filter(after & until).select(window, key)
    same = spans.filter("_from = _to").withColumnRenamed("_from", "day")
    times = events.select(key, ts, F.to_date(ts).alias("day"))
    short = same.join(times, "day").filter(F.col(ts).between(F.col(start), F.col(end))).select(window, key)
    return long.unionByName(short).distinct()


def reach_in_intervals(
    events: DataFrame,
    key: str,
    ts: str,
    intervals: DataFrame,
    window: str,
    start: str,
    end: str,
    alias: str = "reach",
    before: date | None = None,
) -> DataFrame:
    """Distinct keys with at least one event in the union of each ``window``'s intervals, both ends included.

    For a window of one interval that spans days, the keys of its whole days are counted without pairing events with
    windows. From them go the keys without an event inside: those whose last event on the first day comes before the
    start, and whose next one after the end; and those whose first event on the last day comes after the end, and
    whose previous one before the first day. Only key-days on a window's first or last day meet it.
    Intervals within one day, and windows of several disjoint intervals (tied versions that differ), are paired with
    the key-days of their days. ``before`` is the first day without events.
    """
    days = key_days(events, key, ts)
    spans = _spans(merged_intervals(intervals, window, start, end), start, end, before)
    lone = (F.col("intervals") == 1) & (F.col("_from") < F.col("_to"))
    plain = spans.filter(lone)
    whole = reach_in_windows(days, key, "day", plain, window, "_from", "_to", alias="_whole", before=before)

    by_day = Window.partitionBy(key).orderBy("day")
    around = days.withColumns(
        {"_previous": F.lag("day").over(by_day), "_next": F.lead("day").over(by_day), "_next_first": F.lead("first").over(by_day)}
    )
    beyond = F.col("_next").isNull() | (F.col("_next") > F.col("_to")) | ((F.col("_next") == F.col("_to")) & (F.col("_next_first") > F.col(end)))
    begun = plain.withColumnRenamed("_from", "day").filter(F.col(start) > F.col("day")).join(around, "day")
    early = begun.filter((F.col("last") < F.col(start)) & beyond).select(window)
    ended = plain.withColumnRenamed("_to", "day").join(around, "day")
    late = ended.filter((F.col("first") > F.col(end)) & (F.col("_previous").isNull() | (F.col("_previous") < F.col("_from")))).select(window)
    outside = early.unionByName(late).groupBy(window).agg(F.count(F.lit(1)).alias("_outside"))
    exact = whole.join(outside, window, "left").select(window, (F.col("_whole") - F.coalesce("_outside", F.lit(0))).alias(alias))

    paired = _paired(spans.filter(~lone), days, events, window, key, ts, start, end)
    counted = paired.groupBy(window).agg(F.count(F.lit(1)).alias(alias))
    return exact.filter(F.col(alias) > 0).unionByName(counted)


def met_in_intervals(targets: DataFrame, events: DataFrame, key: str, ts: str, start: str, end: str, before: date | None = None) -> DataFrame:
    """The rows of ``targets`` (key, an interval, any others) whose key has an event in the interval, both ends included.

    Events meet targets as one row per key and day in one ordered pass per key; intervals within a day join the
    events of the key and day.
    """
    spans = _spans(targets, start, end, before)
    days = key_days(events, key, ts).select(key, "day", F.struct("day", "first", "last").alias("_event"))
    longer = spans.filter("_from < _to")
    points = longer.select(key, F.col("_from").alias("day")).distinct().withColumn("_point", F.lit(True))
    merged = days.unionByName(points, allowMissingColumns=True).groupBy(key, "day").agg(F.max("_event").alias("_event"), F.max("_point").alias("_point"))
    # descending order keeps both frames growing
    later = Window.partitionBy(key).orderBy(F.col("day").desc())
    following = F.min("_event").over(later.rowsBetween(Window.unboundedPreceding, -1))
    answers = merged.withColumn("_following", following).filter("_point").select(key, F.col("day").alias("_from"), "_event", "_following")
    inside: Column = F.coalesce(F.col("_event.last") >= F.col(start), F.lit(False))
    then = (F.col("_following.day") < F.col("_to")) | ((F.col("_following.day") == F.col("_to")) & (F.col("_following.first") <= F.col(end)))
    long = longer.join(answers, [key, "_from"]).filter(inside | F.coalesce(then, F.lit(False)))
    times = events.select(key, F.to_date(ts).alias("_from"), F.col(ts).alias("_at")).distinct()
    short = spans.filter("_from = _to").join(times, [key, "_from"]).filter(F.col("_at").between(F.col(start), F.col(end)))
    return long.select(*targets.columns).unionByName(short.select(*targets.columns).distinct())
