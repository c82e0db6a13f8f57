"""Latest / first row per key, and attribution by equal timestamps."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stampbook.functions import on_days


def _best_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], ties: bool) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    position = F.rank() if ties else F.row_number()
    # Spark turns the "= 1" filter into a group limit on both sides of the
    # shuffle, so a hot key sends one row (plus ties) per map task.
    return df.withColumn("_position", position.over(window)).filter("_position = 1").drop("_position")


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    version: str,
    ties: bool = False,
    tie_breakers: Sequence[Column] = (),
) -> DataFrame:
    """Rows with the greatest ``version`` per key; ``ties=True`` keeps all of them."""
    return _best_per_key(df, keys, [F.col(version).desc(), *tie_breakers], ties)


def first_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], ties: bool = False
) -> DataFrame:
    return _best_per_key(df, keys, order, ties)


def scan_points(
    scans: DataFrame,
    columns: Sequence[str | Column] = ("store_nbr", "chnl_nm"),
    ts_alias: str = "event_ts",
    first: date | None = None,
    before: date | None = None,
) -> DataFrame:
    """Scans on days ``[first, before)``, reduced to one row per (wallet, timestamp, attributes).

    The days are those of the rows that look for their scan: equal timestamps lie
    on equal days, so the bounds change no result and let the reader skip files.

    Redemptions are attributed to the scan with the same wallet and timestamp;
    the reduction stops repeated scan rows from multiplying redemptions. The
    timestamp in the key spreads a wallet that holds many rows.
    """
    if first is not None or before is not None:
        scans = scans.filter(on_days("event_ts", first, before))
    return scans.select("wallet_id", F.col("event_ts").alias(ts_alias), *columns).distinct()


def attach_scan(rows: DataFrame, points: DataFrame, ts: str) -> DataFrame:
    """Left join of ``rows`` with ``scan_points`` on (wallet, ``ts``), where ``ts`` may be NULL.

    Rows without a timestamp cannot match. They bypass the join, since they
    would all meet in one partition per wallet.
    """
    dated = rows.filter(F.col(ts).isNotNull()).join(points, ["wallet_id", ts], "left")
    return dated.unionByName(rows.filter(F.col(ts).isNull()), allowMissingColumns=True)
