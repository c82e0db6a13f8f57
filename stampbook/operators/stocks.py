"""Per-day stocks: rolling distinct counts and running totals.

The common shape is: reduce events to (key, day), turn each key's history into
+1 / -1 steps, add the steps up per day (with map-side combine) and run one
ordered sum over the days. The ordered sum has one row per calendar day, so its
single task is bounded by the calendar, never by the events.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def first_days(events: DataFrame, key: str, ts: str, alias: str = "first_day") -> DataFrame:
    """First event day per key (partial aggregation before the shuffle)."""
    return events.groupBy(key).agg(F.to_date(F.min(ts)).alias(alias))


def running_totals(
    steps: DataFrame,
    day: str,
    measures: Sequence[str],
    spine: DataFrame | None = None,
    spine_day: str | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """Cumulative sum of ``measures`` per day, read off on the days of ``spine``.

    Steps dated before the first spine day still count. Without a spine the
    result has one row per day that occurs in ``steps``.
    """
    sums = [F.sum(m).alias(m) for m in measures]
    if spine is not None:
        marks = spine.select(F.col(spine_day or day).alias(day)).distinct().withColumn("_on_spine", F.lit(1))
        steps = steps.select(day, *measures).unionByName(marks, allowMissingColumns=True)
        daily = steps.groupBy(day).agg(*sums, F.max("_on_spine").alias("_on_spine"))
    else:
        daily = steps.groupBy(day, *by).agg(*sums)
    order = Window.partitionBy(*by) if by else Window
    window = order.orderBy(day).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    result = daily
    for m in measures:
        result = result.withColumn(m, F.coalesce(F.sum(m).over(window), F.lit(0)).cast("long"))
    if spine is not None:
        result = result.filter("_on_spine = 1").drop("_on_spine")
    return result


def rolling_distinct(
    events: DataFrame,
    key: str,
    day: str,
    windows: Mapping[str, tuple[int, int]],
    spine: DataFrame,
    spine_day: str,
) -> DataFrame:
    """Distinct keys seen in ``[D - first, D - last]`` for every spine day ``D``.

    ``windows`` maps an output column to ``(first, last)``, e.g. ``(7, 1)`` for
    the seven days before ``D``. One pass serves all windows: an event on day s
    covers the days s+last .. s+first, cut short where the same key's next
    event takes over, so each key is counted once per day by construction and
    the cost does not grow with the window length.
    """
    days = events.select(F.col(key).alias("_key"), F.col(day).alias("_day")).filter("_day is not null").distinct()
    following = F.lead("_day").over(Window.partitionBy("_key").orderBy("_day"))
    names = list(windows)
    steps = []
    for i, (first, last) in enumerate(windows.values()):
        opens = F.date_add("_day", last)
        closes = F.least(F.date_add("_day", first + 1), F.date_add("_next", last))
        for when, delta in ((opens, 1), (closes, -1)):
            steps.append(F.struct(when.alias("day"), F.lit(i).alias("window"), F.lit(delta).alias("delta")))
    exploded = (
        days.withColumn("_next", following)
        .select(F.explode(F.array(*steps)).alias("s"))
        .select(
            F.col("s.day").alias(spine_day),
            *[F.when(F.col("s.window") == i, F.col("s.delta")).otherwise(0).alias(n) for i, n in enumerate(names)],
        )
    )
    return running_totals(exploded, spine_day, names, spine, spine_day)
