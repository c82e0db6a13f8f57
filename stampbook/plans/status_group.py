"""Reports on holders of a verified status (a key-worker or membership card id)."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stampbook.functions import minor_to_major, on_days
from stampbook.operators import scan_points
from stampbook.plans.bases import archive_columns
from stampbook.scheme import Scheme

NEW, EXISTING = "New to Rewards", "Existed in Rewards"


def holders(accounts: DataFrame, archive: DataFrame) -> DataFrame:
    """Status holders with the earliest known day of their status."""
    return (
        accounts.filter("status_id_last_upd_ts is not null")
        .select("wallet_id", "singl_profl_id", "status_id", "regtn_ts", "status_id_last_upd_ts")
        .join(archive_columns(archive), "wallet_id", "left")
        .withColumn("status_upd_dt", F.to_date(F.coalesce("_archived_ts", "status_id_last_upd_ts")))
        .drop("_archived_ts")
    )


def status_activity_funnel(
    accounts: DataFrame, archive: DataFrame, scans: DataFrame, as_of: date, scheme: Scheme = Scheme()
) -> DataFrame:
    """Holders whose last in-store scan follows their status, in four periods (one row)."""
    last = (
        scans.filter(on_days("event_ts", scheme.status_launch, as_of) & (F.col("chnl_nm") == "store"))
        .groupBy("wallet_id")
        .agg(F.max("event_ts").alias("last_scan"))
    )
    recent = holders(accounts, archive).join(last, "wallet_id").filter(
        F.col("status_upd_dt") <= F.col("last_scan")
    )

    def since(days: int) -> Column:
        return F.count_if(on_days(F.col("last_scan"), as_of - timedelta(days=days), None))

    return recent.agg(
        F.count(F.lit(1)).alias("scanned_total"),
        since(30).alias("scanned_30day"),
        since(7).alias("scanned_7day"),
        since(1).alias("scanned_1day"),
    )


def status_earns(missions: DataFrame, scans: DataFrame, as_of: date, scheme: Scheme = Scheme()) -> DataFrame:
    """Redemptions and pounds of the status campaign per day and store."""
    points = scan_points(scans, columns=("store_nbr",), ts_alias="cmpgn_cmplt_ts", before=as_of)
    return (
        missions.filter(
            (F.col("cmpgn_id") == scheme.status_campaign)
            & on_days("cmpgn_cmplt_ts", None, as_of)
            & (F.col("mssn_status_desc") != "CANCELLED")
        )
        .select("wallet_id", "cmpgn_cmplt_ts", "rdmpt_val")
        .join(points, ["wallet_id", "cmpgn_cmplt_ts"], "left")
        .groupBy(F.to_date("cmpgn_cmplt_ts").alias("cmpgn_cmplt_dt"), "store_nbr")
        .agg(F.count(F.lit(1)).alias("redemptions"), minor_to_major(F.sum("rdmpt_val")).alias("earned"))
        .withColumn("cumu_redemptions", F.lit(0))
        .withColumn("cumu_earned", F.lit(0))
    )


def status_breakdown(accounts: DataFrame, scans: DataFrame, scheme: Scheme = Scheme(), as_of: date | None = None) -> DataFrame:
    """Existing against new members: total, scanned since launch, before it, and never; by scans before ``as_of``."""
    last = scans.filter(on_days("event_ts", None, as_of)).groupBy("wallet_id").agg(F.to_date(F.max("event_ts")).alias("scan"))
    rows = (
        accounts.filter("status_id_last_upd_ts is not null")
        .select("wallet_id", F.to_date("regtn_ts").alias("reg_dt"))
        .join(last, "wallet_id", "left")
    )
    launch = F.lit(scheme.status_launch)
    new, old = F.col("reg_dt") >= launch, F.col("reg_dt") < launch
    scan = F.col("scan")
    counts = rows.agg(
        F.count_if(old).alias("old_all"),
        F.count_if(old & (scan >= launch)).alias("old_since"),
        F.count_if(old & (scan < launch)).alias("old_before"),
        F.count_if(old & scan.isNull()).alias("old_never"),
        F.count_if(new).alias("new_all"),
        F.count_if(new & scan.isNotNull()).alias("new_since"),
        F.count_if(new & scan.isNull()).alias("new_never"),
    )

    def row(name: str, existing: Column, newcomers: Column) -> Column:
        return F.struct(F.lit(name).alias("group"), existing.alias("existing"), newcomers.alias("new"))

    none = F.lit(None).cast("long")
    return counts.select(
        F.inline(
            F.array(
                row("Index", F.lit(2).cast("long"), F.lit(1).cast("long")),
                row("Grand Total", F.col("old_all"), F.col("new_all")),
                row("Users Scanned Post inc. launch", F.col("old_since"), F.col("new_since")),
                row("Users Scanned Pre launch", F.col("old_before"), none),
                row("Users Not Scanned", F.col("old_never"), F.col("new_never")),
            )
        )
    )


def status_scans(accounts: DataFrame, archive: DataFrame, scans: DataFrame, as_of: date) -> DataFrame:
    """Scans on or after the status day, per day and store.

    Scans fold to (wallet, day, store) counts before they meet the holders.
    """
    daily = (
        scans.filter(on_days("event_ts", None, as_of))
        .groupBy("wallet_id", F.to_date("event_ts").alias("scan_dt"), "store_nbr")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return (
        daily.join(holders(accounts, archive).select("wallet_id", "status_upd_dt"), "wallet_id")
        .filter("status_upd_dt <= scan_dt")
        .groupBy("scan_dt", "store_nbr")
        .agg(F.sum("n").alias("status_group_scans"))
    )


def status_users_series(
    accounts: DataFrame, archive: DataFrame, as_of: date, scheme: Scheme = Scheme()
) -> DataFrame:
    """New holders per day and group, with running totals per group and overall."""
    group = F.when(F.to_date("regtn_ts") >= F.lit(scheme.status_launch), NEW).otherwise(EXISTING)
    daily = (
        holders(accounts, archive)
        .filter(F.col("status_upd_dt") < F.lit(as_of))
        .groupBy("status_upd_dt", group.alias("new_rewards"))
        .agg(F.count("wallet_id").alias("num_users"))
    )
    # two rows per day at most, so the ordered windows are bounded by the calendar
    per_day = Window.partitionBy("status_upd_dt")
    per_group = Window.partitionBy("new_rewards").orderBy("status_upd_dt")
    overall = Window.orderBy("status_upd_dt").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        daily.withColumn("total_users", F.sum("num_users").over(per_day))
        .withColumn("cumu_users", F.sum("num_users").over(per_group))
        .withColumn("cumu_total_users", F.sum("num_users").over(overall))
    )
