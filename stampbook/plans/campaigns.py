"""Campaigns, missions, vouchers and coupons: set-up, attribution and summaries."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stampbook.functions import (
    day_window,
    first_match,
    is_numeric_store,
    minor_to_major,
    on_days,
    ratio,
    strip_check_digit,
)
from stampbook.operators import (
    attach_scan,
    distinct_by_fold,
    latest_per_key,
    met_in_intervals,
    next_event_day,
    reach_in_intervals,
    scan_points,
    with_total_row,
)
from stampbook.plans.bases import this_year
from stampbook.scheme import Scheme

STAR_TYPES = ("Super Star Product", "Star Product")
SIMPLE_MISSIONS = ("ACCA", "Mission")
CURRENT = "CURRENT"


def _is_current(column: str = "rec_status_ind") -> Column:
    return F.upper(column) == CURRENT


def online_or_store(channel: str = "chnl_nm") -> Column:
    name = F.upper(channel)
    return first_match([(name == "ECOM", "Online Only"), (name == "STORE", "In-store Only")], "???")


# --- set-up ------------------------------------------------------------------


def campaign_setup(versions: DataFrame, as_of: date, scheme: Scheme = Scheme()) -> DataFrame:
    """Latest version of each reportable campaign, classified.

    Equally late versions are all kept. ``value_pence`` is the campaign value in
    minor units; sums are made on it and divided once at the edge.
    """
    tag = F.upper("cmpgn_tag_array")
    star = (
        tag.contains("STARPRODUCT")
        | tag.contains("OPENSP")
        | ((F.col("offr_type_desc") == "FIXED_POINTS_PRODUCTS") & (F.col("cmpgn_type_nm") == "POINTS_FIXED"))
    )
    basket = F.col("cmpgn_type_nm") == "DISCOUNT_BASKET"
    category = first_match(
        [
            (F.col("cmpgn_id") == scheme.status_campaign, scheme.status_label),
            (F.col("cmpgn_id") == scheme.club_campaign, scheme.club_label),
            (basket, "Voucher"),
            (tag.contains("MISSION") | tag.contains("ACCA"), "Mission"),
            (star, "Star Product"),
        ]
    )
    activity_type = first_match(
        [
            (tag.contains("FREQ") | tag.contains("ACCA"), "ACCA"),
            (tag.contains("MISSION"), "Mission"),
            (tag.contains("SUPERSTAR"), "Super Star Product"),
            (tag.endswith("ESSENTIAL_WORKER"), scheme.status_label),
            (tag.like("%CLUB_%"), "Clubs"),
            (star, "Star Product"),
        ]
    )
    value_pence = F.when(F.col("reward_pnt_qty").isNull(), F.col("disc_amt")).when(
        F.col("disc_amt").isNull(), F.col("reward_pnt_qty")
    )
    started = F.to_date("cmpgn_start_ts") <= F.lit(as_of)
    reportable = (
        (F.col("cmpgn_status_desc") != "DRAFT")
        & ~F.col("cmpgn_nm").contains("TEST")
        & started
        & (F.to_date("cmpgn_end_ts") >= F.lit(scheme.campaign_end_floor))
        & (F.col("cmpgn_type_nm") != "MANUAL")
    )
    evergreen = (
        basket
        & (F.col("cmpgn_nm") == scheme.evergreen_voucher_name)
        & (F.to_date("cmpgn_end_ts") >= F.lit(scheme.evergreen_end_floor))
    )
    return (
        latest_per_key(versions, ["cmpgn_id"], "upd_ts", ties=True)
        .filter((reportable | evergreen) & (F.col("rec_status_ind") == CURRENT))
        .withColumn("value_pence", value_pence)
        .select(
            "cmpgn_id",
            "cmpgn_nm",
            "cmpgn_start_ts",
            "cmpgn_end_ts",
            "upd_ts",
            "offr_type_desc",
            "cmpgn_type_nm",
            "cmpgn_tag_array",
            category.alias("category"),
            F.when(basket, "Burn").otherwise("Earn").alias("burn_earn"),
            "cmpgn_status_desc",
            minor_to_major("value_pence").alias("pound_value"),
            "cmpgn_mode_nm",
            "cmpgn_clsfctn_nm",
            "coupn_exp_type_desc",
            activity_type.alias("activity_type"),
            "value_pence",
        )
    )


def summed_setup(setup: DataFrame) -> DataFrame:
    """One row per campaign of ``campaign_setup``: the values of its tied versions, summed (NULL where all are)."""
    pence = F.sum("value_pence")
    summed = setup.groupBy("cmpgn_id").agg(minor_to_major(pence).alias("pound_value"), pence.alias("value_pence"))
    return _sized(summed)


def _sized(few: DataFrame) -> DataFrame:
    """The rows after an exchange of their own: AQE then knows how few they are, not only how many they were made of.

    Spark leaves out an exchange by the key that they are grouped by already, so it is by all columns.
    """
    return few.repartition(*few.columns)


# --- vouchers ----------------------------------------------------------------


def vouchers(
    reward_wallets: DataFrame,
    scans: DataFrame,
    setup: DataFrame,
    account_rows: DataFrame,
    as_of: date,
    scheme: Scheme = Scheme(),
) -> DataFrame:
    """Current vouchers with the store and channel of the scan that redeemed them.

    A voucher comes once per tied version of its campaign. Reports that only sum values pass ``summed_setup``.
    """
    redeemed = F.col("reward_redm_ts")
    rows = reward_wallets.filter(
        (F.col("rec_status_ind") == CURRENT)
        & on_days("reward_gained_ts", scheme.launch, as_of)
        & (redeemed.isNull() | on_days(redeemed, scheme.launch, as_of))
        & ~F.col("wallet_id").isin(*scheme.excluded_voucher_wallets)
    ).select("wallet_id", "cmpgn_id", "reward_gained_ts", "reward_end_ts", "reward_redm_ts", "cmpgn_type_desc")
    points = scan_points(scans, ts_alias="reward_redm_ts", first=scheme.launch, before=as_of)
    value = setup.select("cmpgn_id", "value_pence", F.col("pound_value").alias("voucher_value_pounds"))
    status = account_rows.select("wallet_id", "acct_status_id")
    return (
        attach_scan(rows, points, "reward_redm_ts")
        .join(value, "cmpgn_id", "left")
        .join(status, "wallet_id", "left")
        .select(
            "wallet_id",
            "cmpgn_id",
            "reward_gained_ts",
            "reward_end_ts",
            "reward_redm_ts",
            "voucher_value_pounds",
            "value_pence",
            "store_nbr",
            "cmpgn_type_desc",
            "chnl_nm",
            "acct_status_id",
        )
    )


# --- missions ----------------------------------------------------------------


def mission_value_pence(scheme: Scheme) -> Column:
    """Pence earned by one completion, by activity type."""
    kind, cnt, val = F.col("activity_type"), F.col("rdmpt_cnt"), F.col("rdmpt_val")
    fixed_value = F.col("cmpgn_cmplt_ts") <= F.lit(scheme.star_value_change)
    return first_match(
        [
            ((kind == "Star Product") & fixed_value, F.col("value_pence") * cnt),
            ((kind == "Star Product") & ~fixed_value, val),
            (kind == "Super Star Product", val * cnt),
            (kind.isin(scheme.status_label, "Clubs"), val),
            (kind.isin(*SIMPLE_MISSIONS), F.col("value_pence")),
        ],
        F.lit(None).cast("long"),
    )


def mission_sums(scheme: Scheme) -> dict[str, Column]:
    """What ``summed_mission_value`` needs of each completion, to be summed (NULL where all are)."""
    cnt, val = F.col("rdmpt_cnt"), F.col("rdmpt_val")
    fixed_value = F.col("cmpgn_cmplt_ts") <= F.lit(scheme.star_value_change)
    return {
        "_fixed_cnt": F.when(fixed_value, cnt),
        "_other_val": F.when(~fixed_value, val),
        "_val_cnt": val * cnt,
        "_val": val,
        "_rows": F.lit(1).cast("long"),
    }


def summed_mission_value(scheme: Scheme) -> Column:
    """The sum of ``mission_value_pence`` over completions of one campaign, from their ``mission_sums``."""
    kind, value = F.col("activity_type"), F.col("value_pence")
    fixed, other = value * F.col("_fixed_cnt"), F.col("_other_val")
    return first_match(
        [
            (kind == "Star Product", F.coalesce(fixed + other, fixed, other)),
            (kind == "Super Star Product", F.col("_val_cnt")),
            (kind.isin(scheme.status_label, "Clubs"), F.col("_val")),
            (kind.isin(*SIMPLE_MISSIONS), value * F.col("_rows")),
        ],
        F.lit(None).cast("long"),
    )


def mission_completions(
    missions: DataFrame,
    scans: DataFrame,
    setup: DataFrame,
    calendar_days: DataFrame,
    last_week: DataFrame,
    account_rows: DataFrame,
    as_of: date,
    scheme: Scheme = Scheme(),
    per_value: bool = True,
) -> DataFrame:
    """Completed missions with value, store, channel, status and period flags.

    Always-on campaigns count in any record version, all others only in the
    current one. A completion comes once per type and value of its campaign's tied
    versions; without ``per_value`` once per type, with the values of all its rows summed.
    """
    always_on = F.col("cmpgn_id").isin(*scheme.always_on_campaigns)
    day = F.to_date("cmpgn_cmplt_ts")
    completed = missions.filter(
        on_days("cmpgn_cmplt_ts", scheme.launch, as_of) & (always_on | (F.col("rec_status_ind") == CURRENT))
    ).select("wallet_id", "cmpgn_id", "cmpgn_seen_ts", "cmpgn_cmplt_ts", "rdmpt_cnt", "rdmpt_val", "rec_status_ind")
    points = scan_points(scans, ts_alias="cmpgn_cmplt_ts", first=scheme.launch, before=as_of).filter(is_numeric_store())
    # tied versions of one type and value would repeat every completion of their campaign
    values = setup.select("cmpgn_id", "activity_type", "value_pence").distinct()
    valued = completed.join(points, ["wallet_id", "cmpgn_cmplt_ts"])
    if per_value:
        valued = valued.join(values, "cmpgn_id", "left")
    else:
        # a mission is worth the campaign's value or its own, once for each row summed
        per_type = values.groupBy("cmpgn_id", "activity_type").agg(
            F.sum("value_pence").alias("value_pence"), F.count(F.lit(1)).alias("_values")
        )
        own = F.col("rdmpt_val") * F.col("_values")
        valued = valued.join(_sized(per_type), "cmpgn_id", "left").withColumn("rdmpt_val", own)
    attributed = (
        valued.withColumn("mission_value_pence", mission_value_pence(scheme))
        .select(
            "wallet_id",
            "cmpgn_id",
            "cmpgn_seen_ts",
            "cmpgn_cmplt_ts",
            F.when(F.col("activity_type").isin(*SIMPLE_MISSIONS), 1)
            .otherwise(F.col("rdmpt_cnt"))
            .alias("rdmpt_cnt"),
            "mission_value_pence",
            "value_pence",
            "store_nbr",
            "rec_status_ind",
            "chnl_nm",
            "activity_type",
        )
        .distinct()
    )
    in_year = F.coalesce(this_year(day, calendar_days, as_of), F.lit(False))
    return (
        attributed.join(account_rows.select("wallet_id", "acct_status_id"), "wallet_id", "left")
        .select(
            "wallet_id",
            "cmpgn_id",
            "cmpgn_seen_ts",
            "cmpgn_cmplt_ts",
            "rdmpt_cnt",
            minor_to_major("mission_value_pence").alias("mission_value_pounds_new"),
            minor_to_major("value_pence").alias("mission_value_pounds"),
            "mission_value_pence",
            "store_nbr",
            "rec_status_ind",
            "chnl_nm",
            "activity_type",
            F.when(day_window(day, as_of, 7, 0), F.col("wallet_id")).alias("cmplt_lst_wk"),
            F.when(day_window(day, as_of, 14, 8), F.col("wallet_id")).alias("cmplt_prior_wk"),
            in_year.cast("int").alias("cmplt_ytd"),
            (day <= last_week.select("end_date").scalar()).cast("int").alias("last_week_flag"),
            "acct_status_id",
        )
    )


def missions_daily(completions: DataFrame) -> DataFrame:
    """Completions and pounds by campaign, day, store, channel, type and status."""
    return (
        completions.groupBy(
            "cmpgn_id",
            F.to_date("cmpgn_cmplt_ts").alias("cmpgn_cmplt_dt"),
            "store_nbr",
            "chnl_nm",
            "activity_type",
            "acct_status_id",
        )
        .agg(
            F.sum("rdmpt_cnt").alias("rdmpt_cnt"),
            minor_to_major(F.sum("mission_value_pence")).alias("earn_value_gbp"),
        )
        .withColumn("expr", F.lit(None).cast("string"))
    )


def mission_activity(
    completions: DataFrame, scans: DataFrame, last_week: DataFrame, as_of: date, scheme: Scheme = Scheme()
) -> DataFrame:
    """Activity types over the rolling week and the last complete week, side by side.

    The participation base is the number of scans in the same period.
    """
    day = F.to_date("cmpgn_cmplt_ts")
    week_end = last_week.select("end_date").scalar()
    rolling = F.col("cmplt_lst_wk").isNotNull()
    prior = F.col("cmplt_prior_wk").isNotNull()
    week = day.between(F.date_sub(week_end, 6), week_end)
    week_before = day.between(F.date_sub(week_end, 13), F.date_sub(week_end, 7))
    this_year = F.col("cmplt_ytd") == 1
    pence = F.col("mission_value_pence")

    def pounds(condition: Column) -> Column:
        return F.sum(F.when(condition, pence))

    sums = {
        "rolling": rolling,
        "ytd": this_year,
        "prior": prior,
        "week": week,
        "week_ytd": this_year & (F.col("last_week_flag") == 1),
        "week_before": week_before,
    }
    per_wallet = (
        completions.groupBy("activity_type", "wallet_id")
        .agg(
            *[pounds(condition).alias(name) for name, condition in sums.items()],
            F.max(rolling.cast("int")).alias("in_rolling"),
            F.max(week.cast("int")).alias("in_week"),
        )
    )
    # at most one row per activity type from here on
    types = Window.partitionBy()
    per_type = (
        per_wallet.groupBy("activity_type")
        .agg(
            *[F.sum(name).alias(name) for name in sums],
            F.sum("in_rolling").alias("in_rolling"),
            F.sum("in_week").alias("in_week"),
        )
        .withColumn("rolling_total", F.sum("rolling").over(types))
        .withColumn("week_total", F.sum("week").over(types))
    )
    scan_day = F.to_date("event_ts")
    base = scans.filter(on_days("event_ts", scheme.launch, as_of) & is_numeric_store()).agg(
        F.count_if(day_window(scan_day, as_of, 7, 0)).alias("rolling"),
        F.count_if(scan_day.between(F.date_sub(week_end, 6), week_end)).alias("week"),
    )
    return (
        per_type.filter("activity_type is not null and in_rolling > 0 and in_week > 0")
        .withColumn("scans_rolling", base.select("rolling").scalar())
        .withColumn("scans_week", base.select("week").scalar())
        .select(
            "activity_type",
            minor_to_major("rolling").alias("rdmpt_val"),
            ratio("rolling", "rolling_total").alias("week_percentage_rdmpt_val"),
            F.col("in_rolling").alias("number_unique_completions"),
            ratio("in_rolling", "scans_rolling").alias("percentage_active_customers"),
            minor_to_major("ytd").alias("ytd_total_sum"),
            minor_to_major("prior").alias("pr_wk"),
            minor_to_major("week").alias("rdmpt_val_last_week"),
            ratio("week", "week_total").alias("week_percentage_rdmpt_val_last_week"),
            F.col("in_week").alias("number_unique_completions_last_week"),
            F.col("scans_week").alias("number_active_customers_last_week"),
            F.col("in_week").alias("number_active_customers_per_area_last_week"),
            ratio("in_week", "scans_week").alias("percentage_active_customers_last_week"),
            minor_to_major("week_ytd").alias("ytd_total_sum_last_week"),
            minor_to_major("week_before").alias("pr_wk_last_week"),
        )
    )


def mission_participation(
    missions: DataFrame, versions: DataFrame, activity: DataFrame, as_of: date
) -> DataFrame:
    """Share of the active base that started or completed each campaign (long format).

    ``missions`` carries the progress struct ``mssn_prgrss_struct``; a wallet has
    started when the struct holds any value.
    """
    tag = F.col("cmpgn_tag_array")
    kinds = versions.groupBy("cmpgn_id").agg(
        F.max(tag.contains("MISSION") | tag.contains("ACCA")).alias("is_mission"),
        F.max(tag.contains("STARPRODUCT") | tag.endswith("OPENSP")).alias("is_star"),
    )
    completed = F.col("cmpgn_cmplt_ts").isNotNull()
    started = ~completed & (F.to_json("mssn_prgrss_struct") != "{}")
    per_campaign = (
        missions.filter(on_days("event_ts", as_of - timedelta(days=8), as_of - timedelta(days=1)))
        .groupBy("cmpgn_id", "wallet_id")
        .agg(F.max(completed.cast("int")).alias("completed"), F.max(started.cast("int")).alias("started"))
        .groupBy("cmpgn_id")
        .agg(
            F.sum("completed").alias("completed"),
            F.sum("started").alias("started"),
            F.count(F.lit(1)).alias("reached"),
        )
    )
    base = activity.agg(F.sum("yesterday_7_day_active_flag").alias("total"))

    def line(condition: Column, kind: str, calc: str, count: str) -> Column:
        return F.when(
            condition,
            F.struct(F.lit(kind).alias("mssn_type"), F.lit(calc).alias("calc_type"), F.col(count).alias("dist_cmplt")),
        )

    mission, star = F.col("is_mission"), F.col("is_star")
    lines = F.array_compact(
        F.array(
            line(mission, "Mission", "active_perc", "started"),
            line(mission, "Mission", "redemption_perc", "completed"),
            line(star, "SP", "redemption_perc", "reached"),
        )
    )
    return (
        per_campaign.join(kinds, "cmpgn_id")
        .select("cmpgn_id", F.inline(lines))
        .withColumn("total", base.scalar())
        .withColumn("proportion", ratio("dist_cmplt", "total"))
    )


def mission_campaigns(setup: DataFrame, scheme: Scheme) -> DataFrame:
    return setup.filter(
        F.upper("activity_type").isin("ACCA", "MISSION")
        & F.upper("cmpgn_status_desc").isin("ACTIVE", "EXPIRED")
        & (F.to_date("cmpgn_start_ts") >= F.lit(scheme.trading_start))
    )


def mission_scanners(
    setup: DataFrame, scans: DataFrame, missions: DataFrame, as_of: date, scheme: Scheme = Scheme()
) -> DataFrame:
    """Per mission: wallets that scanned while it ran, and those that also saw it.

    A mission runs from its start to its end, to the timestamp; if several versions of it are the latest, over the
    union of their times. No scan is paired with a campaign but on the days it begins and ends.
    """
    spans = mission_campaigns(setup, scheme).select("cmpgn_id", "cmpgn_start_ts", "cmpgn_end_ts").distinct()
    times = scans.filter(on_days("event_ts", scheme.scanners_start, as_of)).select("wallet_id", "event_ts")
    reach = reach_in_intervals(
        times, "wallet_id", "event_ts", spans, "cmpgn_id", "cmpgn_start_ts", "cmpgn_end_ts", alias="rewards_swipers", before=as_of
    )
    seen = (
        missions.filter(
            _is_current() & F.col("cmpgn_seen_ts").isNotNull() & on_days("event_ts", scheme.trading_start, None)
        )
        .select("wallet_id", "cmpgn_id")
        .distinct()
        .join(spans, "cmpgn_id")
    )
    delivered = (
        met_in_intervals(seen, times, "wallet_id", "event_ts", "cmpgn_start_ts", "cmpgn_end_ts", before=as_of)
        .groupBy("cmpgn_id")
        .agg(F.countDistinct("wallet_id").alias("rewards_swipers_delivered"))
    )
    return reach.join(delivered, "cmpgn_id", "left").withColumn(
        "rewards_swipers_delivered", F.coalesce("rewards_swipers_delivered", F.lit(0).cast("long"))
    )


def scanned_in_window(targets: DataFrame, days: DataFrame) -> DataFrame:
    """Flag ``scanned`` on (wallet, start_dt, end_dt) rows with a scan day inside the window."""
    upcoming = next_event_day(
        targets.select("wallet_id", F.col("start_dt").alias("scan_day")), days, "wallet_id", "scan_day"
    ).withColumnRenamed("scan_day", "start_dt")
    return (
        targets.join(upcoming, ["wallet_id", "start_dt"], "left")
        .withColumn("scanned", F.coalesce(F.col("next_day") <= F.col("end_dt"), F.lit(False)))
        .drop("next_day")
    )


def mission_summary(
    setup: DataFrame, versions: DataFrame, missions: DataFrame, scans: DataFrame, as_of: date, scheme: Scheme = Scheme()
) -> DataFrame:
    """Customers that saw, progressed and completed each mission per day, and the earn."""
    spend_needed = versions.groupBy("cmpgn_id").agg(
        minor_to_major(F.max("trans_needed_reward_pnt_qty")).alias("trans_needed_reward_pnt_qty")
    )
    campaigns = (
        mission_campaigns(setup, scheme)
        .select(
            "cmpgn_id",
            "cmpgn_nm",
            F.to_date("cmpgn_start_ts").alias("cmpgn_start_dt"),
            F.to_date("cmpgn_end_ts").alias("cmpgn_end_dt"),
            "activity_type",
            "pound_value",
            "value_pence",
        )
        .distinct()
        .join(spend_needed, "cmpgn_id", "left")
    )
    points = scan_points(scans, [F.lit(1).alias("_scan")], first=scheme.trading_start, before=as_of)
    seen = F.col("cmpgn_seen_ts").isNotNull()
    per_day = (
        missions.filter(_is_current() & on_days("event_ts", scheme.trading_start, as_of))
        .select("cmpgn_id", "wallet_id", "event_ts", "cmpgn_seen_ts", "cmpgn_cmplt_ts")
        .join(points, ["wallet_id", "event_ts"], "left")
        .groupBy("cmpgn_id", F.to_date("event_ts").alias("event_ts"), "wallet_id")
        .agg(
            F.max(seen.cast("int")).alias("seen"),
            F.max((seen & F.col("_scan").isNotNull()).cast("int")).alias("progressed"),
            F.max((seen & F.col("cmpgn_cmplt_ts").isNotNull()).cast("int")).alias("redeemed"),
        )
        .groupBy("cmpgn_id", "event_ts")
        .agg(
            F.sum("seen").alias("customers_seen"),
            F.sum("progressed").alias("customers_progressed"),
            F.sum("redeemed").alias("redeemers"),
        )
    )
    return campaigns.join(per_day, "cmpgn_id").select(
        "cmpgn_id",
        "cmpgn_nm",
        F.when(F.col("activity_type") == "ACCA", "Accumulator").otherwise(F.col("activity_type")).alias("activity_type"),
        F.lit("Continuity").alias("offr_type_desc"),
        "pound_value",
        "trans_needed_reward_pnt_qty",
        "cmpgn_start_dt",
        "cmpgn_end_dt",
        "event_ts",
        F.when(F.col("cmpgn_end_dt") >= F.lit(as_of), "Active").otherwise("Expired").alias("mission_status"),
        "customers_seen",
        "customers_progressed",
        F.lit(0).alias("customers_seen_not_cmplt"),
        "redeemers",
        minor_to_major(F.col("redeemers") * F.col("value_pence")).alias("cashpot_earn"),
    )


# --- coupons -----------------------------------------------------------------


def item_columns(items: DataFrame, obsolete_floor: date) -> DataFrame:
    return items.filter(F.col("obsolete_dt") >= F.lit(obsolete_floor)).select(
        F.col("all_links_item_nbr").alias("prime_win"),
        F.col("item_nbr").alias("win"),
        "upc_nbr",
        "cons_item_nbr",
        "original_cin",
        "dept_desc",
        "catg_desc",
        "vendor_nm",
    )


def live_item_number(scheme: Scheme) -> Column:
    """Items folded into the 'deleted' number keep their original one."""
    return F.when(F.col("cons_item_nbr") == scheme.deleted_item, F.col("original_cin")).otherwise(F.col("cons_item_nbr"))


PRODUCT_COUPON = "Product Coupon"


@dataclass(frozen=True)
class CouponSides:
    """What coupon details are made of, each with distinct rows and ``cmpgn_id``: versions, products with items, types.

    Every version of a campaign meets every product of it, so reports that want one row per coupon
    aggregate the sides and never pair them.
    """

    versions: DataFrame
    products: DataFrame
    types: DataFrame


def coupon_sides(
    versions: DataFrame, campaign_products: DataFrame, items: DataFrame, type_map: DataFrame, scheme: Scheme = Scheme()
) -> CouponSides:
    """Coupon versions, their products and types from ``type_map(cmpgn_id, coupon_type)``, in the form of ``coupon_details``."""
    start = F.col("cmpgn_start_ts")
    coupons = (
        versions.filter(
            F.upper("cmpgn_tag_array").contains("COUPON") & on_days("cmpgn_start_ts", scheme.coupon_start, None)
        )
        .select(
            "cmpgn_tag_array",
            "cmpgn_id",
            "cmpgn_nm",
            # clock-change nudge: a start at 23:00 means midnight of the next day
            F.when(F.hour(start) == 23, F.timestamp_add("HOUR", F.lit(1), start)).otherwise(start).alias("cmpgn_start_ts"),
            "cmpgn_end_ts",
            minor_to_major("disc_amt").alias("disc_amt"),
        )
        .distinct()
    )
    products = (
        campaign_products.filter(F.col("cmpgn_status_desc").isin("ACTIVE", "EXPIRED"))
        .select(
            "cmpgn_id",
            F.when(F.col("cmpgn_prod_level_nm") == "upc_nbr", strip_check_digit("cmpgn_prod_id")).alias("upc"),
        )
        .distinct()
    )
    item = (
        item_columns(items, scheme.coupon_item_obsolete_floor)
        .select(
            F.col("upc_nbr").alias("upc"),
            "upc_nbr",
            "win",
            live_item_number(scheme).alias("cons_item_nbr"),
            "prime_win",
            F.initcap("dept_desc").alias("dept_desc"),
            "catg_desc",
            F.initcap("vendor_nm").alias("supplier"),
        )
        .distinct()
    )
    listed = products.join(coupons.select("cmpgn_id").distinct(), "cmpgn_id", "left_semi").join(item, "upc", "left")
    return CouponSides(coupons, listed, type_map.select("cmpgn_id", _coupon_type()).distinct())


def _coupon_type() -> Column:
    return F.coalesce("coupon_type", F.lit(PRODUCT_COUPON)).alias("coupon_type")


def coupon_details(
    versions: DataFrame, campaign_products: DataFrame, items: DataFrame, type_map: DataFrame, scheme: Scheme = Scheme()
) -> DataFrame:
    """Coupons with their products and a coupon type from ``type_map(cmpgn_id, coupon_type)``.

    The sides are distinct in the columns that are returned, and so are the joined rows.
    """
    sides = coupon_sides(versions, campaign_products, items, type_map, scheme)
    return (
        sides.products.join(sides.versions, "cmpgn_id")
        .join(sides.types, "cmpgn_id", "left")
        .select(
            "cmpgn_tag_array",
            "cmpgn_id",
            "cmpgn_nm",
            "cmpgn_start_ts",
            "cmpgn_end_ts",
            "disc_amt",
            "upc",
            "upc_nbr",
            "win",
            "cons_item_nbr",
            "prime_win",
            "dept_desc",
            "catg_desc",
            "supplier",
            _coupon_type(),
        )
    )


def _per_coupon(
    details: DataFrame | CouponSides, version: Column | None = None, product: Column | None = None
) -> DataFrame:
    """One row per coupon campaign, of the versions and products that meet a condition.

    The greatest value over all pairs of a version and a product is that of its own side.
    """
    of_version = [
        F.max("cmpgn_nm").alias("cmpgn_nm"),
        F.min("cmpgn_start_ts").alias("cmpgn_start_ts"),
        F.max("cmpgn_end_ts").alias("cmpgn_end_ts"),
        F.max("disc_amt").alias("disc_amt"),
    ]
    of_product = [
        F.max("supplier").alias("supplier"),
        F.initcap(F.max("dept_desc")).alias("department"),
        F.max("catg_desc").alias("category"),
    ]
    of_type = F.max("coupon_type").alias("coupon_type")
    every = F.lit(True)
    version, product = every if version is None else version, every if product is None else product
    if isinstance(details, DataFrame):
        return details.filter(version & product).groupBy("cmpgn_id").agg(*of_version, *of_product, of_type)
    return (
        details.versions.filter(version)
        .groupBy("cmpgn_id")
        .agg(*of_version)
        .join(details.products.filter(product).groupBy("cmpgn_id").agg(*of_product), "cmpgn_id")
        .join(details.types.groupBy("cmpgn_id").agg(of_type), "cmpgn_id", "left")
        .withColumn("coupon_type", _coupon_type())
    )


def coupon_daily_items(adjustments: DataFrame, details: DataFrame | CouponSides, scheme: Scheme = Scheme()) -> DataFrame:
    """Coupon volume, value and spend per item, day and channel, with an all-channel row."""
    facts = (
        adjustments.filter(
            (F.col("visit_dt") >= F.lit(scheme.coupon_start))
            & (F.col("supplier_bill_ind") == 1)
            & (F.col("in_cmpgn_ind") == 1)
            & ~F.col("cmpgn_id").isin(*scheme.excluded_coupon_campaigns)
        )
        .withColumn("redemption_date", F.to_date("coupn_redm_ts"))
        .withColumn("chnl_nm", F.when(F.upper("chnl_nm") == "ECOM", "Online").otherwise("In-store"))
    )
    keys = ["cmpgn_id", "item_nbr", "prod_disp_nm", "redemption_date"]
    totals = with_total_row(
        facts,
        keys,
        "chnl_nm",
        [
            F.sum("rdmpt_cnt").alias("redemption_vol"),
            F.sum("rdmpt_val").alias("redemption_value"),
            F.sum("vat_sell_price_amt").cast("double").alias("basket_spend"),
        ],
    )
    # the coupon attributes join the aggregate, not the facts
    return totals.join(_per_coupon(details, product=F.col("win").isNotNull()).drop("coupon_type"), "cmpgn_id")


def _redeeming_channel(coupons: DataFrame, scans: DataFrame, as_of: date, scheme: Scheme) -> DataFrame:
    points = scan_points(
        scans, [F.upper("chnl_nm").alias("_channel")], "coupn_redm_ts", first=scheme.coupon_start, before=as_of
    )
    return attach_scan(coupons, points, "coupn_redm_ts")


COUPON_MONEY = ("redemption_value", "cost_store", "cost_online")


def _coupon_sums() -> dict[str, Column]:
    online, store = F.col("_channel") == "ECOM", F.col("_channel") != "ECOM"
    count, value = F.col("rdmpt_cnt"), F.col("rdmpt_val")
    return {
        "redemption_count": count,
        "redemption_value": value,
        "redemptions_store": F.when(store, count),
        "redemptions_online": F.when(online, count),
        "cost_store": F.when(store, value),
        "cost_online": F.when(online, value),
    }


def _coupon_measures() -> list[Column]:
    return [(minor_to_major(F.sum(v)) if name in COUPON_MONEY else F.sum(v)).alias(name) for name, v in _coupon_sums().items()]


def coupon_daily_redemptions(
    coupons: DataFrame, details: DataFrame | CouponSides, scans: DataFrame, as_of: date, scheme: Scheme = Scheme()
) -> DataFrame:
    """Redemptions per coupon and day, split by channel (redeemers are rows, not wallets)."""
    redeemed = coupons.filter(_is_current() & on_days("coupn_redm_ts", None, as_of)).select(
        "cmpgn_id", "wallet_id", "coupn_redm_ts", "rdmpt_cnt", "rdmpt_val"
    )
    daily = (
        _redeeming_channel(redeemed, scans, as_of, scheme)
        .groupBy("cmpgn_id", F.to_date("coupn_redm_ts").alias("coupn_redm_dt"))
        .agg(F.count("wallet_id").alias("redeemers"), *_coupon_measures())
    )
    return daily.join(_per_coupon(details), "cmpgn_id")


def coupon_summary(
    coupons: DataFrame, details: DataFrame | CouponSides, scans: DataFrame, as_of: date, scheme: Scheme = Scheme()
) -> DataFrame:
    """Allocation, reach and redemption totals per coupon.

    'Allocated and scanned' asks for a scan day inside the coupon's window; it is
    answered per (wallet, start day), so scans and coupons are never paired.
    """
    spans = _per_coupon(details).select(
        "cmpgn_id", F.to_date("cmpgn_start_ts").alias("start_dt"), F.to_date("cmpgn_end_ts").alias("end_dt")
    )
    days = scans.filter(on_days("event_ts", scheme.coupon_start, as_of)).select(
        "wallet_id", F.to_date("event_ts").alias("scan_day")
    )
    current = coupons.filter(_is_current() & on_days("event_ts", None, as_of)).select(
        "cmpgn_id", "acct_id", "wallet_id", "coupn_redm_ts", "rdmpt_cnt", "rdmpt_val"
    )
    targets = current.select("cmpgn_id", "wallet_id").distinct().join(spans, "cmpgn_id")
    scanned = scanned_in_window(targets, days).filter("scanned").select("cmpgn_id", "wallet_id", "scanned")
    rows = _redeeming_channel(current, scans, as_of, scheme).join(scanned, ["cmpgn_id", "wallet_id"], "left")
    redeemed = F.col("coupn_redm_ts").isNotNull()
    totals = distinct_by_fold(
        rows,
        ["cmpgn_id"],
        {
            "acct": (F.col("acct_id"), {"allocated": None, "allocated_scanned": F.col("scanned")}),
            "wallet": (F.col("wallet_id"), {"redeemers": redeemed}),
        },
        {"redemptions": (redeemed & F.col("acct_id").isNotNull()).cast("long"), **_coupon_sums()},
    ).withColumns({"wallets": F.lit(0), **{name: minor_to_major(F.col(name)) for name in COUPON_MONEY}})
    listed = (F.col("prime_win") == F.col("win")) | F.col("win").isNull()
    return totals.join(_per_coupon(details, on_days("cmpgn_start_ts", None, as_of), listed), "cmpgn_id")


def coupon_alloc(coupons: DataFrame, as_of: date) -> DataFrame:
    """Allocations per campaign and day, and those not redeemed."""
    return (
        coupons.filter((F.col("rec_status_ind") == CURRENT) & on_days("coupn_alloc_ts", None, as_of))
        .groupBy("cmpgn_id", F.to_date("coupn_alloc_ts").alias("alloc_dt"))
        .agg(
            F.count(F.lit(1)).alias("total_alloc"),
            F.count_if(F.col("coupn_redm_ts").isNull()).alias("alloc_not_redeemed"),
        )
    )


def coupon_redm(coupons: DataFrame, scans: DataFrame, orders: DataFrame, as_of: date) -> DataFrame:
    """Redemptions per day, campaign, store and channel; store '-1' is taken from the order.

    Both sides are folded per (wallet, timestamp) before they meet: redemptions
    to sums per campaign, scans to a count per store and channel that the sums
    are multiplied by. Many rows at one instant therefore do not pair up.
    """
    redeemed = (
        coupons.filter((F.col("rec_status_ind") == CURRENT) & on_days("coupn_redm_ts", None, as_of))
        .groupBy("wallet_id", "coupn_redm_ts", "cmpgn_id")
        .agg(F.sum("rdmpt_cnt").alias("cnt"), F.sum("rdmpt_val").alias("val"))
    )
    elsewhere = F.col("store_nbr") == "-1"
    points = (
        scan_points(scans, ["store_nbr", "chnl_nm", "trans_rcpt_nbr"], "coupn_redm_ts", before=as_of)
        .withColumn("_receipt", F.when(elsewhere, F.col("trans_rcpt_nbr")))
        .groupBy("wallet_id", "coupn_redm_ts", "store_nbr", "chnl_nm", "_receipt")
        .agg(F.count(F.lit(1)).alias("scans"))
    )
    order_store = orders.select(F.col("web_order_id").alias("_order"), F.col("store_nbr").alias("_order_store"))
    # only scans without a store look it up; the other rows get a key that matches no order and spreads them
    unmatched = F.concat(F.lit("-"), F.xxhash64("wallet_id", "coupn_redm_ts", "cmpgn_id").cast("string"))
    times = F.coalesce(F.col("scans"), F.lit(1))
    count, value = F.col("cnt") * times, F.col("val") * times
    online, store = F.col("chnl_nm") == "ecom", F.col("chnl_nm") == "store"

    def only(condition: Column, measure: Column) -> Column:
        return F.sum(F.when(condition, measure).otherwise(0))

    return (
        redeemed.join(points, ["wallet_id", "coupn_redm_ts"], "left")
        .withColumn("_order", F.coalesce(F.col("_receipt"), unmatched))
        .join(order_store, "_order", "left")
        .groupBy(
            F.to_date("coupn_redm_ts").alias("redm_dt"),
            "cmpgn_id",
            F.when(elsewhere, F.col("_order_store")).otherwise(F.col("store_nbr")).alias("store_nbr"),
            "chnl_nm",
        )
        .agg(
            F.sum(count).alias("redm_cnt"),
            minor_to_major(F.sum(value)).alias("redm_pounds"),
            only(online, count).alias("online_redm"),
            only(store, count).alias("store_redm"),
            minor_to_major(only(online, value)).alias("online_pounds"),
            minor_to_major(only(store, value)).alias("store_pounds"),
        )
    )
