"""Conformed bases the other reports build on: calendar, accounts, sign-ups, scans."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stampbook.functions import (
    band_label,
    band_order,
    bands_from_edges,
    day_window,
    is_numeric_store,
    on_days,
    profile_or_wallet,
)
from stampbook.scheme import Scheme

# fixed values: balance bands in pence and their labels
BALANCE_BANDS = bands_from_edges(
    [0, 1, 100, 200, 300, 400, 500, 1000, 2000],
    ["£0", "£0-£0.99", "£1-£1.99", "£2-£2.99", "£3-£3.99", "£4-£4.99", "£5-£9.99", "£10-£19.99", "£20+"],
)
LAST_DAY = date(2099, 12, 31)


def calendar(calendar_days: DataFrame, as_of: date, scheme: Scheme = Scheme()) -> DataFrame:
    """Days in ``[launch, as_of)`` with their retail week."""
    return calendar_days.filter(
        (F.col("day_date") >= F.lit(scheme.launch)) & (F.col("day_date") < F.lit(as_of))
    ).select(
        F.col("day_date").alias("full_date"), "retail_week", F.col("retail_week").alias("retail_year_week")
    )


def last_complete_week(calendar_days: DataFrame, as_of: date, scheme: Scheme = Scheme()) -> DataFrame:
    """First and last day of the second newest retail week before ``as_of`` (one row)."""
    spans = (
        calendar(calendar_days, as_of, scheme)
        .groupBy("retail_week")
        .agg(F.min("full_date").alias("start_date"), F.max("full_date").alias("end_date"))
    )
    newest_first = F.row_number().over(Window.orderBy(F.col("retail_week").desc()))
    # one row per week of the calendar, so the ordered window is small
    return spans.withColumn("_n", newest_first).filter("_n = 2").select("start_date", "end_date")


def retail_years(calendar_days: DataFrame, as_of: date) -> DataFrame:
    """Span of each retail year and a flag on the one that holds ``as_of``."""
    starts = calendar_days.groupBy("retail_year").agg(F.min("day_date").alias("start_dt"))
    next_start = F.lead("start_dt").over(Window.orderBy("retail_year"))
    return starts.withColumn("end_dt", F.coalesce(F.date_sub(next_start, 1), F.lit(LAST_DAY))).withColumn(
        "yr_flag", F.lit(as_of).between(F.col("start_dt"), F.col("end_dt")).cast("int")
    )


def this_year(day: Column, calendar_days: DataFrame, as_of: date) -> Column:
    """``day`` lies in the retail year that holds ``as_of``."""
    year = retail_years(calendar_days, as_of).filter("yr_flag = 1")
    start = year.agg(F.min("start_dt").alias("d")).scalar()
    end = year.agg(F.max("end_dt").alias("d")).scalar()
    return day.between(start, end)


def expired_guest(as_of: date, days: int, ts: str = "regtn_ts") -> Column:
    """1 for a temporary account registered more than ``days`` before ``as_of``."""
    old = F.col(ts) < F.lit(as_of - timedelta(days=days))
    return F.when(old & (F.col("acct_status_id") == "TEMP"), 1).otherwise(0)


def ever_guest() -> Column:
    """1 when the account was not permanent from the start."""
    converted = F.col("dt_cnvrt_to_full_acct_ts")
    return F.when(converted.isNull() | (F.col("regtn_ts") != converted), 1).otherwise(0)


def account_base(accounts: DataFrame, scans: DataFrame, as_of: date, scheme: Scheme = Scheme()) -> DataFrame:
    """One row per account with activity, guest, expiry and balance-band flags."""
    # only scans of the registration day count, which lies in the same span
    days = scans.filter(on_days("event_ts", scheme.launch, as_of)).select("wallet_id", F.to_date("event_ts").alias("reg_dt"))
    scan_days = days.distinct().withColumn("active_ind", F.lit(1))
    registered = (
        accounts.filter(on_days("regtn_ts", scheme.launch, as_of))
        .select(
            "wallet_id",
            profile_or_wallet().alias("singl_profl_id"),
            F.to_date("regtn_ts").alias("reg_dt"),
            "curr_cash_bnk_pnts_qty",
            "lifetime_pnts_qty",
            "last_shopped_store_id",
            "acct_status_id",
            "dt_cnvrt_to_full_acct_ts",
            "regtn_ts",
            ever_guest().alias("guest_ind"),
            expired_guest(as_of, scheme.guest_expiry_days).alias("acct_del_ind_1"),
            "src_modfd_ts",
        )
        # one shuffle on the join key serves the reduction and the join
        .repartition("wallet_id", "reg_dt")
        .distinct()
    )
    balance = F.col("curr_cash_bnk_pnts_qty")
    return (
        registered.join(scan_days, ["wallet_id", "reg_dt"], "left")
        .withColumn("active_ind", F.coalesce("active_ind", F.lit(0)))
        .withColumn("cashbank_categorised", band_label(balance, BALANCE_BANDS))
        .withColumn("cashbank_categorised_order", band_order(balance, BALANCE_BANDS))
    )


def sign_ups(
    accounts: DataFrame, consents: DataFrame, profiles: DataFrame, as_of: date, scheme: Scheme = Scheme()
) -> DataFrame:
    """One row per sign-up with new-customer, opt-in and expiry flags."""
    base = (
        accounts.filter(on_days("regtn_ts", None, as_of))
        .select(
            profile_or_wallet().alias("singl_profl_id"), "regtn_ts", "acct_status_id", ever_guest().alias("guest_ind")
        )
        .distinct()
    )
    opted = (F.col("mktg_consent_email") == "Y") | (F.col("push_notif_consent") == "Y")
    return (
        base.join(consents.select("singl_profl_id", "mktg_consent_email", "push_notif_consent"), "singl_profl_id", "left")
        .join(
            profiles.select("singl_profl_id", "registration_channel", "registration_date", "tnc_accepted_at_loyalty"),
            "singl_profl_id",
            "left",
        )
        .select(
            "singl_profl_id",
            F.to_date("regtn_ts").alias("signup_dt"),
            F.when(new_to_brand(), 1).otherwise(0).alias("new_ind"),
            F.when(opted, 1).otherwise(0).alias("opt_in_flag"),
            expired_guest(as_of, scheme.guest_expiry_days).alias("acct_del_ind_1"),
            "acct_status_id",
        )
    )


def new_to_brand() -> Column:
    """The profile was created through the scheme, or on the day its terms were accepted."""
    same_day = F.to_date("registration_date") == F.to_date("tnc_accepted_at_loyalty")
    return (F.col("registration_channel") == "LOYALTY") | same_day


def sign_ups_daily(sign_up_rows: DataFrame) -> DataFrame:
    """Sign-ups, new customers, opt-ins and deletions per day and account status."""
    permanent = F.col("acct_status_id") == "DEFAULT"
    return sign_up_rows.groupBy("signup_dt", "acct_status_id").agg(
        F.count("singl_profl_id").alias("num_sign_ups"),
        F.sum("new_ind").alias("num_new_ind"),
        F.sum("opt_in_flag").alias("num_opt_in_flag"),
        F.sum("acct_del_ind_1").alias("num_acct_del"),
        F.count_if(permanent & (F.col("opt_in_flag") == 1)).alias("opt_in_perm_only"),
        F.count_if(permanent & (F.col("new_ind") == 1)).alias("new_ind_perm_only"),
    )


def scan_base(scans: DataFrame, as_of: date, scheme: Scheme = Scheme()) -> DataFrame:
    """Scans since launch at real stores, with three id-or-0 seven-day flags."""
    day = F.to_date("event_ts")
    # column name -> first and last day of the window, counted back from as_of
    flags = {
        "current_7_day_active_flag": (7, 0),
        "yesterday_7_day_active_flag": (8, 2),
        "rolling_7_day_active_flag": (14, 8),
    }
    return scans.filter(on_days("event_ts", scheme.launch, as_of) & is_numeric_store()).select(
        "wallet_id",
        "store_nbr",
        "event_ts",
        *[
            F.when(day_window(day, as_of, first, last), F.col("wallet_id")).otherwise(0).alias(name)
            for name, (first, last) in flags.items()
        ],
    )


def wallet_activity(
    scans: DataFrame, calendar_days: DataFrame, as_of: date, scheme: Scheme = Scheme()
) -> DataFrame:
    """One row per wallet: twelve activity-window flags and a year-to-date flag."""
    day = F.col("_day")
    days = (
        scans.filter(on_days("event_ts", scheme.launch, as_of) & is_numeric_store())
        .select("wallet_id", F.to_date("event_ts").alias("_day"))
        .distinct()
    )
    # fixed values: window ends in days before as_of, per family and length
    spans = {
        "current": {1: (1, 0), 7: (7, 0), 30: (30, 0), 91: (91, 0)},
        "yesterday": {1: (2, 2), 7: (8, 2), 30: (31, 2), 91: (92, 2)},
        "rolling": {1: (8, 8), 7: (14, 8), 30: (37, 8), 91: (98, 8)},
    }
    flags = [
        F.max(day_window(day, as_of, first, last).cast("int")).alias(f"{family}_{length}_day_active_flag")
        for family, lengths in spans.items()
        for length, (first, last) in lengths.items()
    ]
    in_year = F.coalesce(this_year(day, calendar_days, as_of), F.lit(False))
    return days.groupBy("wallet_id").agg(*flags, F.max(in_year.cast("int")).alias("ytd_flag"))


def store_details(stores: DataFrame, regions: DataFrame, extra: DataFrame | None = None) -> DataFrame:
    """Listed stores with region, short name and position.

    ``regions`` maps store_nbr to region; ``extra`` maps forced stores to the
    region they are shown under.
    """
    short_name = F.split_part(F.min("store_nm"), F.lit(" ("), F.lit(1)).alias("store_nm")

    def named(mapping: DataFrame, rows: DataFrame) -> DataFrame:
        return (
            rows.join(mapping, "store_nbr")
            .groupBy("store_nbr", "region", "latitude", "longitude")
            .agg(short_name)
            .select("store_nbr", "region", "store_nm", "latitude", "longitude")
        )

    listed = named(regions, stores.filter(~F.col("store_nm").like("%, %")))
    if extra is None:
        return listed
    placed = stores.filter("latitude is not null")
    forced = placed.withColumn(
        "_n", F.row_number().over(Window.partitionBy("store_nbr").orderBy("store_nm", "latitude", "longitude"))
    ).filter("_n = 1")
    return listed.unionByName(named(extra, forced)).distinct()


def status_lookup(vouchers: DataFrame) -> DataFrame:
    return vouchers.select("acct_status_id").filter("acct_status_id is not null").distinct()


def channel_lookup(vouchers: DataFrame) -> DataFrame:
    return vouchers.select("chnl_nm").filter("chnl_nm is not null").distinct()


def archive_columns(accounts: DataFrame) -> DataFrame:
    """Earliest archived status change per wallet."""
    return (
        accounts.filter("status_id_last_upd_ts is not null")
        .groupBy("wallet_id")
        .agg(F.min("status_id_last_upd_ts").alias("_archived_ts"))
    )
