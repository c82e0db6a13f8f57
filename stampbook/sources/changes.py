"""The difference between a table and what it should be, as row changes, and their application."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

INSERT, UPDATE, DELETE = "insert", "update", "delete"
CHANGE = "change"


def row_changes(target: DataFrame, source: DataFrame, keys: Sequence[str], delete: bool = True) -> DataFrame:
    """The target's columns and ``change``: the rows to insert, to update (new values) and to delete (old values).

    Rows meet in one aggregate over both tables, told apart by all columns compared null-safe; unchanged rows have
    no change. NULL keys match NULL keys, so that a sync ends. A key that the source or the target has more than once
    raises: which of its rows should win is not known. Without ``delete``, rows that the source lacks are kept.
    """
    columns = target.columns
    rest = [c for c in columns if c not in keys]
    sides = [("_new", source.select(*columns)), ("_old", target)]
    tagged = None
    for side, df in sides:
        row = F.struct(F.lit(1).alias("one"), *[F.col(f"`{c}`").alias(c) for c in rest])
        own = df.select(*[F.col(f"`{k}`").alias(k) for k in keys], row.alias(side))
        tagged = own if tagged is None else tagged.unionByName(own, allowMissingColumns=True)
    both = tagged.groupBy(*keys).agg(
        F.first("_new", ignorenulls=True).alias("_new"), F.first("_old", ignorenulls=True).alias("_old"),
        F.count("_new").alias("_news"), F.count("_old").alias("_olds"),
    )
    single = F.when((F.col("_news") > 1) | (F.col("_olds") > 1), F.raise_error(F.lit("a key occurs more than once"))).otherwise(F.lit(True))
    kind = (
        F.when(F.col("_olds") == 0, INSERT)
        .when(F.col("_news") == 0, DELETE if delete else None)
        .when(~F.col("_new").eqNullSafe(F.col("_old")), UPDATE)
    )
    changed = both.filter(single).withColumn(CHANGE, kind).filter(F.col(CHANGE).isNotNull())
    kept = F.coalesce(F.col("_new"), F.col("_old"))
    return changed.withColumn("_kept", kept).select(*[F.col(c) if c in keys else F.col(f"_kept.`{c}`").alias(c) for c in columns], CHANGE)


def applied(target: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The target after its row changes."""
    right = changes.select(*[F.col(f"`{k}`").alias(f"_c_{k}") for k in keys])
    same = None
    for k in keys:
        equal = F.col(f"`{k}`").eqNullSafe(F.col(f"_c_{k}"))
        same = equal if same is None else same & equal
    kept = target.join(right, same, "left_anti")
    return kept.unionByName(changes.filter(F.col(CHANGE) != DELETE).drop(CHANGE))
