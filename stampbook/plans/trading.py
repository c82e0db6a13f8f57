"""Trading reports on star products: items, customers, redeemers and reach."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stampbook.functions import minor_to_major, on_days, strip_check_digit
from stampbook.operators import first_days, hot_split_join, reach_in_intervals, scan_points, with_total_by_fold, with_total_row
from stampbook.plans.campaigns import (
    STAR_TYPES,
    item_columns,
    live_item_number,
    mission_sums,
    online_or_store,
    summed_mission_value,
)
from stampbook.scheme import Scheme


def scanners_daily(scans: DataFrame, as_of: date, start: date | None = None) -> DataFrame:
    """Distinct scanning wallets per day and channel, with an all-channel row."""
    wallets = (
        scans.filter(on_days("event_ts", start, as_of))
        .select(F.to_date("event_ts").alias("scan_date"), online_or_store().alias("chnl_nm"), "wallet_id")
        .distinct()
    )
    return with_total_row(wallets, ["scan_date"], "chnl_nm", [F.countDistinct("wallet_id").alias("scanners")])


def star_product_list(
    campaign_products: DataFrame, items: DataFrame, setup: DataFrame, scheme: Scheme = Scheme()
) -> DataFrame:
    """Products of star campaigns with item and campaign attributes.

    Rows are distinct: each side is, in the form in which it is returned, before they meet. A campaign's
    tied versions that agree in these columns therefore meet its products once.
    """
    products = (
        campaign_products.filter(
            F.col("cmpgn_status_desc").isin("ACTIVE", "EXPIRED")
            & (F.col("cmpgn_prod_level_nm") == "upc_nbr")
            & ~F.col("cmpgn_id").isin(*scheme.excluded_star_campaigns)
        )
        .select("cmpgn_id", strip_check_digit("cmpgn_prod_id").alias("upc"))
        .distinct()
    )
    campaigns = (
        setup.filter(F.col("activity_type").isin(*STAR_TYPES) & (F.to_date("cmpgn_start_ts") >= F.lit(scheme.trading_start)))
        .select("cmpgn_id", "cmpgn_nm", "cmpgn_start_ts", "cmpgn_end_ts", "pound_value", "value_pence", "activity_type")
        .distinct()
    )
    # products without an item have no number to compare, and are left out as deleted ones are
    deleted = (F.col("original_cin") == scheme.deleted_item) & (F.col("cons_item_nbr") == scheme.deleted_item)
    item = (
        item_columns(items, scheme.item_obsolete_floor)
        .filter(~deleted)
        .select(
            "win",
            "prime_win",
            live_item_number(scheme).alias("cons_item_nbr"),
            "upc_nbr",
            "dept_desc",
            "catg_desc",
            F.initcap("vendor_nm").alias("vendor_nm"),
            F.col("upc_nbr").alias("upc"),
        )
        .distinct()
    )
    return (
        products.join(item, "upc")
        .join(campaigns, "cmpgn_id")
        .select(
            "win",
            "prime_win",
            "cons_item_nbr",
            "upc_nbr",
            "dept_desc",
            "catg_desc",
            "vendor_nm",
            "upc",
            "cmpgn_id",
            "cmpgn_nm",
            "cmpgn_start_ts",
            "cmpgn_end_ts",
            "pound_value",
            "value_pence",
            "activity_type",
        )
    )


def epos_items_daily(
    star_products: DataFrame, basket_items: DataFrame, as_of: date, scheme: Scheme = Scheme(), grace_days: int = 30
) -> DataFrame:
    """Baskets, items and spend on star products per campaign, day and channel.

    In ``star_product_list`` every tied version of a campaign has all its products. Lines are therefore summed per
    campaign, over the days of any of its versions, before they meet the versions' names and spans.
    A best-selling item can hold a large share of all basket lines, so the join
    on the item number splits such items by basket.
    """
    versions = star_products.select(
        "activity_type",
        "cmpgn_nm",
        "cmpgn_id",
        F.to_date("cmpgn_start_ts").alias("_from"),
        F.date_add(F.to_date("cmpgn_end_ts"), grace_days).alias("_to"),
    ).distinct()
    products = star_products.groupBy("cmpgn_id", "cons_item_nbr").agg(
        F.to_date(F.min("cmpgn_start_ts")).alias("_first"),
        F.date_add(F.to_date(F.max("cmpgn_end_ts")), grace_days).alias("_last"),
    )
    lines = basket_items.filter(
        (F.col("visit_dt") >= F.lit(scheme.trading_start)) & (F.col("visit_dt") < F.lit(as_of))
    ).select(
        "cons_item_nbr",
        "visit_dt",
        "basket_id",
        "unmeasured_qty",
        "sale_amt_inc_vat",
        F.when(F.col("channel_src_id") == 2, "Online Only").otherwise("In-store Only").alias("chnl_nm"),
    )
    sold = hot_split_join(lines, products, ["cons_item_nbr"], ["basket_id"]).filter(
        F.col("visit_dt").between(F.col("_first"), F.col("_last"))
    )
    per_campaign = with_total_by_fold(
        sold,
        ["cmpgn_id", "visit_dt"],
        "chnl_nm",
        "basket_id",
        {"customers_proxy": None},
        {"items": F.col("unmeasured_qty"), "spend": F.col("sale_amt_inc_vat")},
    )
    # spans of one name share its baskets, and each adds its items and spend
    return (
        per_campaign.join(versions, "cmpgn_id")
        .filter(F.col("visit_dt").between(F.col("_from"), F.col("_to")))
        .groupBy("activity_type", "cmpgn_nm", "cmpgn_id", "visit_dt", "chnl_nm")
        .agg(
            F.max("customers_proxy").alias("customers_proxy"),
            F.sum("items").alias("items"),
            F.round(F.sum("spend"), 2).cast("double").alias("spend"),
        )
    )


def star_products_daily(
    star_products: DataFrame, missions: DataFrame, scans: DataFrame, as_of: date, scheme: Scheme = Scheme()
) -> DataFrame:
    """Customers, first-scan customers, items and earn per star campaign, day and channel.

    Redemptions are summed per campaign before they meet its tied versions, which have names and values of their own.
    """
    campaigns = star_products.select("activity_type", "cmpgn_nm", "cmpgn_id", "value_pence").distinct()
    points = scan_points(
        scans, [online_or_store().alias("chnl_nm")], first=scheme.trading_start, before=as_of
    )
    firsts = first_days(scans, "wallet_id", "event_ts", "first_swipe")
    redemptions = (
        missions.filter(
            F.col("cmpgn_cmplt_ts").isNotNull()
            & (F.upper("rec_status_ind") == "CURRENT")
            & on_days("event_ts", scheme.trading_start, as_of)
        )
        .select("wallet_id", "cmpgn_id", "event_ts", "cmpgn_cmplt_ts", "rdmpt_cnt", "rdmpt_val")
        .join(campaigns.select("cmpgn_id").distinct(), "cmpgn_id", "left_semi")
        .join(points, ["wallet_id", "event_ts"])
        .join(firsts, "wallet_id", "left")
        .withColumn("visit_dt", F.to_date("event_ts"))
    )
    first = F.col("visit_dt") == F.col("first_swipe")
    sums = mission_sums(scheme)
    per_campaign = with_total_by_fold(
        redemptions,
        ["cmpgn_id", "visit_dt"],
        "chnl_nm",
        "wallet_id",
        {"customers": None, "first_swipe_customers": first},
        {"items": F.col("rdmpt_cnt"), **sums},
    )
    # versions of one name share its customers, and each value adds its items and earn
    return (
        per_campaign.join(campaigns, "cmpgn_id")
        .groupBy("activity_type", "cmpgn_nm", "cmpgn_id", "visit_dt", "chnl_nm")
        .agg(
            F.max("customers").alias("customers"),
            F.max("first_swipe_customers").alias("first_swipe_customers"),
            F.sum("items").alias("items"),
            minor_to_major(F.sum(summed_mission_value(scheme))).alias("cashpot"),
        )
    )


def sp_details(star_products: DataFrame, scheme: Scheme = Scheme()) -> DataFrame:
    """One row per star campaign; attributes come from the prime item where it is listed."""
    attributes = ["prime_win", "catg_desc", "dept_desc", "vendor_nm", "cmpgn_start_ts", "cmpgn_end_ts", "pound_value"]
    listed = star_products.select("cmpgn_id", "win", *attributes)

    def of(prefix: str, match: str) -> DataFrame:
        return listed.select(
            "cmpgn_id", F.col("win").alias(match), *[F.col(a).alias(f"{prefix}_{a}") for a in attributes]
        )

    def either(name: str):
        return F.coalesce(f"prime_{name}", f"own_{name}")

    # products per campaign are few; both look-ups are on (campaign, item)
    wins = listed.select("cmpgn_id", "prime_win", "win").distinct()
    chosen = (
        wins.join(of("prime", "prime_win"), ["cmpgn_id", "prime_win"], "left")
        .join(of("own", "win"), ["cmpgn_id", "win"], "left")
        .groupBy("cmpgn_id")
        .agg(
            F.min(either("prime_win")).alias("prime_win"),
            F.min(either("catg_desc")).alias("catg_desc"),
            F.min(either("dept_desc")).alias("dept_desc"),
            F.min(either("vendor_nm")).alias("vendor_nm"),
            F.to_date(F.min(either("cmpgn_start_ts"))).alias("cmpgn_start_ts"),
            F.to_date(F.max(either("cmpgn_end_ts"))).alias("cmpgn_end_ts"),
            F.max(either("pound_value")).alias("pound_value"),
        )
    )
    special = F.col("cmpgn_id") == scheme.food_to_go_campaign

    def shown(name: str, forced: str):
        return F.when(special, forced).otherwise(F.initcap(name)).alias(name)

    pounds = F.concat(F.lit("£"), F.rpad(F.col("pound_value").cast("string"), 4, "0"))
    return (
        star_products.select("cmpgn_id", "cmpgn_nm", "activity_type")
        .distinct()
        .join(chosen, "cmpgn_id")
        .select(
            "activity_type",
            F.initcap("cmpgn_nm").alias("cmpgn_nm"),
            "cmpgn_id",
            F.lit(0).alias("upc_number"),
            "prime_win",
            "cmpgn_start_ts",
            "cmpgn_end_ts",
            shown("dept_desc", "Food To Go"),
            shown("catg_desc", "Food for Later"),
            shown("vendor_nm", "N/A"),
            "pound_value",
            F.when(F.col("activity_type") == "Star Product", "10%").otherwise(pounds).alias("reward_value"),
        )
    )


def sp_redeemers(
    star_products: DataFrame, missions: DataFrame, scans: DataFrame, as_of: date, scheme: Scheme = Scheme()
) -> DataFrame:
    """Distinct redeemers in the campaign window per channel.

    The all-channel row counts every redeemer, the channel rows only those
    whose scan is found.
    """
    spans = star_products.select(
        "cmpgn_id", F.to_date("cmpgn_start_ts").alias("start_dt"), F.to_date("cmpgn_end_ts").alias("end_dt")
    ).distinct()
    points = scan_points(
        scans, [online_or_store().alias("chnl_nm")], first=scheme.trading_start, before=as_of
    )
    day = F.to_date("event_ts")
    redeemers = (
        missions.filter(
            F.col("cmpgn_cmplt_ts").isNotNull()
            & (F.upper("rec_status_ind") == "CURRENT")
            & on_days("event_ts", scheme.trading_start, as_of)
        )
        .select("wallet_id", "cmpgn_id", "event_ts")
        .join(spans, "cmpgn_id")
        .filter(day.between(F.col("start_dt"), F.col("end_dt")))
        .join(points, ["wallet_id", "event_ts"], "left")
        .select("cmpgn_id", "chnl_nm", "wallet_id")
        .distinct()
    )
    counts = with_total_by_fold(redeemers, ["cmpgn_id"], "chnl_nm", "wallet_id", {"customers": None})
    return counts.filter("chnl_nm is not null")


def sp_scanners(
    star_products: DataFrame, scans: DataFrame, as_of: date, scheme: Scheme = Scheme(), channel: str | None = None
) -> DataFrame:
    """Distinct wallets that scanned while each star campaign ran, to the timestamp.

    ``channel`` is None for all channels, or 'Online Only' / 'In-store Only'.
    """
    rows = scans.filter(on_days("event_ts", scheme.scanners_start, as_of))
    if channel is not None:
        rows = rows.filter(online_or_store() == channel)
    spans = star_products.select("cmpgn_id", "cmpgn_start_ts", "cmpgn_end_ts").distinct()
    reach = reach_in_intervals(
        rows.select("wallet_id", "event_ts"),
        "wallet_id",
        "event_ts",
        spans,
        "cmpgn_id",
        "cmpgn_start_ts",
        "cmpgn_end_ts",
        alias="rewards_swipers",
        before=as_of,
    )
    return reach.select("cmpgn_id", F.lit(channel or "All").alias("chnl_nm"), "rewards_swipers")


def sp_lookup(star_products: DataFrame) -> DataFrame:
    """Campaign and item attributes for look-up, without withdrawn campaigns."""
    return (
        star_products.filter(~F.upper("cmpgn_nm").contains("REMOVED"))
        .select(
            "activity_type",
            "cmpgn_id",
            F.initcap("cmpgn_nm").alias("cmpgn_nm"),
            F.lit(0).alias("dept_nbr"),
            F.initcap("dept_desc").alias("dept_desc"),
            F.lit(0).alias("catg_id"),
            F.initcap("catg_desc").alias("catg_desc"),
            F.initcap("vendor_nm").alias("vendor_nm"),
            F.col("upc_nbr").cast("decimal(10,0)").alias("upc"),
            "win",
            "prime_win",
            "pound_value",
        )
        .distinct()
    )
