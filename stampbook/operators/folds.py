"""Distinct counts from folded rows: no row is repeated for each count or for a total row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _true(condition: Column | None) -> Column:
    return F.lit(True) if condition is None else F.coalesce(condition, F.lit(False))


def distinct_by_fold(
    rows: DataFrame,
    keys: Sequence[str],
    ids: Mapping[str, tuple[Column, Mapping[str, Column | None]]],
    sums: Mapping[str, Column],
) -> DataFrame:
    """Per ``keys``: distinct ids under conditions, and sums.

    ``ids`` maps a name to an id column and its counts: an output column and the condition that rows must meet
    (None for all). NULL ids don't count; ``sums`` are of the rows, NULL where all values are.

    Rows fold once per keys and all ids, with a flag for each condition; each id folds what is left once
    more, to one row per keys and id, whose flags are then counted. All of it is partial before each shuffle, a hot
    key is spread by its ids, and the fold's exchange is shared.
    """
    counts = [(name, alias, condition) for name, (_, wanted) in ids.items() for alias, condition in wanted.items()]
    folded = rows.groupBy(*keys, *[column.alias(f"_id_{name}") for name, (column, _) in ids.items()]).agg(
        *[F.bool_or(_true(condition)).alias(alias) for _, alias, condition in counts],
        *[F.sum(value).alias(alias) for alias, value in sums.items()],
    )
    parts = []
    for i, name in enumerate(ids):
        flags = [alias for n, alias, _ in counts if n == name]
        carried = list(sums) if i == 0 else []
        per_id = folded.groupBy(*keys, f"_id_{name}").agg(
            *[F.bool_or(alias).alias(alias) for alias in flags], *[F.sum(alias).alias(alias) for alias in carried]
        )
        found = per_id.groupBy(*keys).agg(
            *[F.count_if(F.col(alias) & F.col(f"_id_{name}").isNotNull()).alias(alias) for alias in flags],
            *[F.sum(alias).alias(alias) for alias in carried],
        )
        parts.append((found, [*flags, *carried]))

    def joined(left: tuple[DataFrame, list[str]], right: tuple[DataFrame, list[str]]) -> tuple[DataFrame, list[str]]:
        other = right[0].select(*[F.col(k).alias(f"_r_{k}") for k in keys], *right[1])
        same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
        return left[0].join(other, same).select(*keys, *left[1], *right[1]), [*left[1], *right[1]]

    return reduce(joined, parts)[0]


def with_total_by_fold(
    rows: DataFrame,
    keys: Sequence[str],
    split: str,
    id_: str,
    flags: Mapping[str, Column | None],
    sums: Mapping[str, Column] | None = None,
    total_label: str = "All",
) -> DataFrame:
    """Per ``keys`` x ``split``, and once more per ``keys`` under ``total_label``: distinct ids under conditions, and sums.

    As ``with_total_row``, but rows first fold to one per keys, split and id, and then to one per keys and id that holds
    the few values of ``split`` it has; an id adds one row to each of its splits and one to the total, and
    the last aggregate only counts and sums. NULL ids are not counted, their sums are.
    """
    sums = sums or {}
    per_split = rows.groupBy(*keys, split, F.col(id_).alias("_id")).agg(
        *[F.bool_or(_true(condition)).alias(alias) for alias, condition in flags.items()],
        *[F.sum(value).alias(alias) for alias, value in sums.items()],
    )
    values = [*flags, *sums]
    each = F.struct(F.lit(0).alias("_total"), split, *values)
    per_id = per_split.groupBy(*keys, "_id").agg(
        F.collect_list(each).alias("_each"),
        *[F.bool_or(alias).alias(alias) for alias in flags],
        *[F.sum(alias).alias(alias) for alias in sums],
    )
    whole = F.struct(F.lit(1).alias("_total"), F.lit(total_label).alias(split), *[F.col(alias) for alias in values])
    spread = per_id.select(*keys, "_id", F.inline(F.concat("_each", F.array(whole))))
    return spread.groupBy(*keys, "_total", split).agg(
        *[F.count_if(F.col(alias) & F.col("_id").isNotNull()).alias(alias) for alias in flags],
        *[F.sum(alias).alias(alias) for alias in sums],
    ).drop("_total")
