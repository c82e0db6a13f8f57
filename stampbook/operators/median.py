"""Exact median of a large integer column in two bounded passes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def exact_median(df: DataFrame, value: str, bucket_width: int = 3600, alias: str = "median") -> DataFrame:
    """One-row frame with the exact median of the integral column ``value``.

    Pass one counts rows per bucket of ``bucket_width`` values and finds the
    bucket(s) holding the middle ranks; pass two counts single values inside
    those buckets only. The ordered windows see one row per bucket and at most
    ``2 * bucket_width`` rows, whatever the size of the input.
    """
    rows = df.select(F.col(value).cast("long").alias("v")).filter("v is not null")
    bucketed = rows.withColumn("bucket", F.floor(F.col("v") / F.lit(bucket_width)))
    running = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    buckets = (
        bucketed.groupBy("bucket")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("upto", F.sum("n").over(running))
        .withColumn("total", F.sum("n").over(Window.partitionBy()))
        .withColumn("low_rank", F.floor((F.col("total") + 1) / 2))
        .withColumn("high_rank", F.floor((F.col("total") + 2) / 2))
        .withColumn("before", F.col("upto") - F.col("n"))
        .filter("(low_rank > before and low_rank <= upto) or (high_rank > before and high_rank <= upto)")
        .select("bucket", "before", "low_rank", "high_rank")
    )
    inside = Window.partitionBy("bucket").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    values = (
        bucketed.join(buckets.select("bucket"), "bucket", "left_semi")
        .groupBy("bucket", "v")
        .agg(F.count(F.lit(1)).alias("n"))
        .join(buckets, "bucket")
        .withColumn("upto", F.col("before") + F.sum("n").over(inside))
        .withColumn("from_", F.col("upto") - F.col("n"))
    )
    low = F.max(F.when((F.col("low_rank") > F.col("from_")) & (F.col("low_rank") <= F.col("upto")), F.col("v")))
    high = F.max(F.when((F.col("high_rank") > F.col("from_")) & (F.col("high_rank") <= F.col("upto")), F.col("v")))
    return values.agg(((low + high) / F.lit(2.0)).alias(alias))
