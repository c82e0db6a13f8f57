"""Total rows by grouping sets, and metric grids from one conditional aggregate."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_total_row(
    df: DataFrame,
    keys: Sequence[str],
    split: str,
    aggregates: Sequence[Column],
    total_label: str = "All",
) -> DataFrame:
    """Aggregate per ``keys`` x ``split`` and once more per ``keys`` under ``total_label``.

    One read of the input; distinct counts of the total row are counted afresh.
    """
    sets = [[*keys, split], list(keys)]
    grouped = df.groupingSets(sets, *keys, split).agg(*aggregates, F.grouping(split).alias("_is_total"))
    label = F.when(F.col("_is_total") == 1, F.lit(total_label)).otherwise(F.col(split))
    return grouped.withColumn(split, label).drop("_is_total")


def metric_grid(
    df: DataFrame,
    metrics: Sequence[tuple[str, Mapping[str, Column | None]]],
    type_column: str = "type",
    index_column: str = "index",
) -> DataFrame:
    """Count rows per (metric, column) cell in a single pass, one output row per metric.

    Each metric is a name and a mapping from output column to row condition;
    ``None`` stands for a cell that is always zero.
    """
    columns = list(metrics[0][1])
    cells = []
    for m, (_, conditions) in enumerate(metrics):
        for c in columns:
            condition = conditions[c]
            count = F.lit(0).cast("long") if condition is None else F.count_if(F.coalesce(condition, F.lit(False)))
            cells.append((f"_{m}_{c}", count))
    totals = df.agg(*[expr.alias(name) for name, expr in cells])
    rows = [
        F.struct(
            F.lit(name).alias(type_column),
            F.lit(m + 1).alias(index_column),
            *[F.col(f"_{m}_{c}").alias(c) for c in columns],
        )
        for m, (name, _) in enumerate(metrics)
    ]
    return totals.select(F.inline(F.array(*rows)))
