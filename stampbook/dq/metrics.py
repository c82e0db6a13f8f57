"""Cut-off metrics over daily counts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class PercentageOfMedian:
    """A day fails when its value is below ``tolerance`` times the median of all days."""

    tolerance: float

    def flag(self, daily: DataFrame, value: str = "row_count", strict: bool = False) -> DataFrame:
        """Adds ``low_count_cutoff`` and ``pass_check``; one row per day in ``daily``."""
        cutoff = daily.agg((F.median(value) * F.lit(self.tolerance)).alias("low_count_cutoff"))
        passed = F.col(value) > F.col("low_count_cutoff") if strict else F.col(value) >= F.col("low_count_cutoff")
        return daily.withColumn("low_count_cutoff", cutoff.scalar()).withColumn(
            "pass_check", F.coalesce(passed, F.lit(False))
        )


def require_rows(daily: DataFrame) -> DataFrame:
    """Raises on an empty frame (runs a small job)."""
    if daily.isEmpty():
        raise ValueError("no daily counts to test")
    return daily


def daily_counts(rows: DataFrame, day, value=None) -> DataFrame:
    """Rows (or another aggregate) per day as ``dt``, ``row_count``."""
    measure = F.count(F.lit(1)) if value is None else value
    return rows.groupBy(day.alias("dt")).agg(measure.alias("row_count"))


def rolling_cutoffs(
    daily: DataFrame,
    window: int,
    median_share: float = 0.4,
    quartile_share: float = 0.4,
    mean_share: float = 0.4,
    iqr_factor: float = 1.5,
    deviations: float = 3.0,
    mad_factor: float = 3.0,
) -> DataFrame:
    """Six candidate cut-offs per day over that day and the ``window - 1`` days after it.

    The back-test walks from the newest day to the oldest. ``daily`` has one row
    per calendar day, which bounds the single ordered window.
    """
    newest_first = Window.orderBy(F.col("dt").desc())
    frame = newest_first.rowsBetween(-(window - 1), 0)
    value = F.col("row_count").cast("double")
    q1, q2, q3 = (F.percentile(value, p).over(frame) for p in (0.25, 0.5, 0.75))
    values = F.collect_list(value).over(frame)
    spread = F.array_sort(F.transform("_values", lambda v: F.abs(v - F.col("_median"))))
    low, high = (window + 1) // 2, window // 2 + 1
    mad = (F.element_at(spread, low) + F.element_at(spread, high)) / 2
    return (
        daily.withColumn("_n", F.row_number().over(newest_first))
        .withColumn("_values", values)
        .withColumn("_median", q2)
        .withColumn("_q1", q1)
        .withColumn("_q3", q3)
        .withColumn("_mean", F.avg(value).over(frame))
        .withColumn("_std", F.stddev_samp(value).over(frame))
        .filter(F.col("_n") >= window)
        .select(
            "dt",
            "row_count",
            (F.col("_median") * median_share).alias("pct_of_median"),
            (F.col("_q1") * quartile_share).alias("pct_of_lower_quartile"),
            (F.col("_mean") * mean_share).alias("pct_of_mean"),
            (F.col("_q1") - iqr_factor * (F.col("_q3") - F.col("_q1"))).alias("interquartile_range"),
            (F.col("_mean") - deviations * F.col("_std")).alias("deviations_from_mean"),
            (F.col("_median") - mad_factor * mad).alias("median_absolute_deviation"),
        )
    )


CUTOFF_COLUMNS = (
    "pct_of_median",
    "pct_of_lower_quartile",
    "pct_of_mean",
    "interquartile_range",
    "deviations_from_mean",
    "median_absolute_deviation",
)


def rejected_share(cutoffs: DataFrame) -> DataFrame:
    """Percentage of days each cut-off would have rejected (one row per cut-off)."""
    shares = cutoffs.agg(
        *[(F.avg((F.col("row_count") < F.col(c)).cast("int")) * 100).alias(c) for c in CUTOFF_COLUMNS]
    )
    rows = [F.struct(F.lit(c).alias("metric"), F.col(c).alias("rejected_percent")) for c in CUTOFF_COLUMNS]
    return shares.select(F.inline(F.array(*rows)))
