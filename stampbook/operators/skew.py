"""Join of a skewed fact with a smaller side that may be too large to broadcast."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def salted_join(
    fact: DataFrame,
    side: DataFrame,
    on: Sequence[str],
    spread_by: Sequence[str | Column],
    how: str = "inner",
    salts: int | None = None,
) -> DataFrame:
    """Equi-join that splits every key of ``fact`` over ``salts`` tasks (as many as shuffle partitions, if not given).

    ``spread_by`` names columns of the fact that vary within a key (an id, a
    timestamp); ``side`` is repeated once per salt. Only joins that keep the
    fact's rows (inner, left, left_semi) are meaningful. Spark still broadcasts
    the side instead when its size is under the threshold.
    """
    if how not in ("inner", "left", "left_semi"):
        raise ValueError(f"salted_join cannot do a {how} join")
    if salts is None:
        salts = int(fact.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salted_fact = fact.withColumn("_salt", F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int"))
    salted_side = side.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted_fact.join(salted_side, [*on, "_salt"], how).drop("_salt")


def hot_split_join(
    fact: DataFrame, side: DataFrame, on: Sequence[str], spread_by: Sequence[str | Column], how: str = "inner", parts: int | None = None
) -> DataFrame:
    """Equi-join that splits only the hot keys of ``fact``, each into as many parts as its rows need.

    A key is hot if it holds more than 1 / ``parts`` of the fact's rows (``parts``: shuffle partitions, if not given),
    so there are fewer than ``parts`` hot keys whatever the data, and the side's rows of hot keys alone
    are repeated: at most 2 x ``parts`` times all keys together. Counting the keys reads their columns once more,
    folded before the shuffle; Spark broadcasts the few that are hot when it sees their size. NULL keys never match.
    """
    if how not in ("inner", "left", "left_semi"):
        raise ValueError(f"hot_split_join cannot do a {how} join")
    if parts is None:
        parts = int(fact.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = fact.select(*on).dropna(subset=list(on)).groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
    share = counts.agg((F.sum("_n") / F.lit(parts)).alias("share")).scalar()
    hot = counts.filter(F.col("_n") > share).select(*on, F.ceil(F.col("_n") / share).cast("int").alias("_salts"))
    salt = F.coalesce(F.pmod(F.xxhash64(*spread_by), F.col("_salts")).cast("int"), F.lit(0))
    salted_fact = fact.join(hot, list(on), "left").withColumn("_salt", salt).drop("_salts")
    each = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1))
    salted_side = side.join(hot, list(on), "left").withColumn("_salt", each).drop("_salts")
    return salted_fact.join(salted_side, [*on, "_salt"], how).drop("_salt")
