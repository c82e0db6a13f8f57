"""Earn on fuel: visits to the forecourt and the store visits that precede them."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stampbook.functions import day_window, first_match, ratio
from stampbook.operators import distinct_by_fold, first_per_key, window_sums

RECEIPT = ("visit_dt", "trans_nbr", "reg_nbr", "store_nbr")
# fixed values: store-visit offsets from the fuel day, nearest first, in days
CROSS_SHOP_FRAMES = {"1d": (0, 0), "7d": (-7, -1), "30d": (-30, -8), "13wk": (-91, -31)}
# fixed values: fuel product codes
PRODUCTS = {"FUEL1": "petrol", "FUEL2": "diesel", "FUEL0": "other_fuel", "FUEL3": "other_fuel"}
OUTAGE = (date(2024, 1, 11), date(2024, 1, 16))
# fixed values: marks of receipts that are not store visits
OTHER_RECEIPTS = ("ZD", "WMT")


@dataclass(frozen=True)
class FuelReports:
    """The three outputs of ``fuel_cross_shop``."""

    customers: DataFrame
    products: DataFrame
    visits: DataFrame


def forecourt_lines(
    fuel_lines: DataFrame, store: str, start: date, as_of: date, outage: tuple[date, date] | None
) -> DataFrame:
    """Fuel lines of one store from 91 days before ``start``, outage days left out."""
    day = F.col("visit_dt")
    lines = fuel_lines.filter(
        (F.col("store_nbr") == store)
        & F.col("upc_nbr").contains("FUEL")
        & (day >= F.lit(start - timedelta(days=91)))
        & (day < F.lit(as_of))
    )
    if outage is not None:
        lines = lines.filter(~day.between(F.lit(outage[0]), F.lit(outage[1])))
    return lines


def fuel_visits(
    fuel_lines: DataFrame,
    calendar_days: DataFrame,
    store: str,
    start: date,
    as_of: date,
    outage: tuple[date, date] | None = OUTAGE,
) -> DataFrame:
    """One row per receipt, wallet and product: the line(s) with the largest adjustment."""
    adjustment = F.abs(F.col("sales_adj").try_cast("double"))
    lines = forecourt_lines(fuel_lines, store, start, as_of, outage)
    largest = first_per_key(
        lines.withColumn("sales_adj", adjustment), RECEIPT, [F.col("sales_adj").desc()], ties=True
    ).select(*RECEIPT, "store_type", "wallet_id", "upc_nbr", "sale_amt_inc_vat", "qty", "sales_adj").distinct()
    product = first_match([(F.col("upc_nbr") == code, name) for code, name in PRODUCTS.items()], "non_fuel")
    weeks = calendar_days.select(F.col("day_date").alias("visit_dt"), F.col("retail_week").alias("visit_week"))
    known = F.col("wallet_id").isNotNull()

    def total(column: str, condition: Column | None = None) -> Column:
        value = F.col(column)
        return F.sum(value if condition is None else F.when(condition, value).otherwise(0))

    return (
        largest.withColumn("prod_type", product)
        .withColumn("ar_visit", known.cast("int"))
        .join(weeks, "visit_dt", "left")
        .groupBy("visit_week", *RECEIPT, "store_type", "wallet_id", "prod_type", "ar_visit")
        .agg(
            total("sale_amt_inc_vat").alias("total_sales"),
            total("qty").alias("total_units"),
            total("sale_amt_inc_vat", ~known).alias("non_ar_sales"),
            total("qty", ~known).alias("non_ar_units"),
            total("sale_amt_inc_vat", known).alias("ar_sales"),
            total("qty", known).alias("ar_units"),
            F.sum("sales_adj").alias("earn"),
        )
    )


def _first_receipts(rows: DataFrame, alias: str) -> DataFrame:
    order = [F.col("visit_dt"), F.col("trans_nbr"), F.col("reg_nbr"), F.col("store_nbr").desc()]
    return (
        first_per_key(rows.select("wallet_id", *RECEIPT).filter("wallet_id is not null"), ["wallet_id"], order, ties=True)
        .distinct()
        .withColumn(alias, F.lit(1))
    )


def store_days(scans: DataFrame, store_visits: DataFrame, store: str, start: date, as_of: date) -> DataFrame:
    """Store visits of identified wallets at ``store``, one row per visit, keyed by day."""
    receipts = scans.filter(
        (F.col("store_nbr") == store)
        & (F.col("chnl_nm") == "store")
        & ~F.col("trans_rcpt_nbr").rlike("|".join(OTHER_RECEIPTS))
        & (F.col("visit_dt") >= F.lit(start - timedelta(days=91)))
        & (F.col("visit_dt") < F.lit(as_of))
    ).select("wallet_id", *RECEIPT)
    return receipts.join(store_visits.select(*RECEIPT, "tot_visit_amt", "tot_scan_cnt"), list(RECEIPT)).select(
        "wallet_id",
        "visit_dt",
        F.lit(1).alias("sv"),
        F.col("tot_visit_amt").alias("sv_sales"),
        F.col("tot_scan_cnt").alias("sv_units"),
    )


def cross_shop_flags(fuel_days: DataFrame, store_visit_rows: DataFrame) -> DataFrame:
    """Per wallet and fuel day: nearest period with a store visit, and spend per visit.

    Store visits are summed per wallet and day and read through day frames
    before each fuel day, so visits are never paired with each other. Wallets
    without any earlier store visit have no flags.
    """
    points = fuel_days.filter("wallet_id is not null").select("wallet_id", "visit_dt")
    frames = {**CROSS_SHOP_FRAMES, "ever": (Window.unboundedPreceding, 0)}
    sums = window_sums(points, store_visit_rows, "wallet_id", "visit_dt", frames, ["sv", "sv_sales", "sv_units"])
    count = {f: F.coalesce(F.col(f"{f}_sv"), F.lit(0)) for f in CROSS_SHOP_FRAMES}
    flags, none_nearer = [], F.lit(True)
    for f in CROSS_SHOP_FRAMES:
        flags.append((none_nearer & (count[f] > 0)).cast("int").alias(f"sv_{f}_flag"))
        none_nearer = none_nearer & (count[f] == 0)
    per_visit = [
        column
        for f in CROSS_SHOP_FRAMES
        for column in (
            ratio(f"{f}_sv_sales", f"{f}_sv").alias(f"cs_spv_{f}"),
            ratio(f"{f}_sv_units", f"{f}_sv").alias(f"cs_upv_{f}"),
        )
    ]
    return sums.filter("ever_sv > 0").select("wallet_id", "visit_dt", *flags, *per_visit)


def fuel_cross_shop(
    fuel_lines: DataFrame,
    scans: DataFrame,
    store_visits: DataFrame,
    calendar_days: DataFrame,
    as_of: date,
    store: str,
    start: date,
    outage: tuple[date, date] | None = OUTAGE,
    store_scan_store: str | None = None,
    stage: Callable[[DataFrame, str], DataFrame] | None = None,
) -> FuelReports:
    """Customer, product and visit-day reports on fuel purchases and cross-shopping.

    With ``stage`` (``stampbook.sources.stage``) the visits that the three
    reports share are written once; without it each report computes its own.
    """
    stage = stage or (lambda df, name: df)
    visits = stage(fuel_visits(fuel_lines, calendar_days, store, start, as_of, outage), "fuel_visits")
    shop = store_days(scans, store_visits, store_scan_store or store, start, as_of)
    first_scan = _first_receipts(scans, "first_ar_visit")
    first_fuel = _first_receipts(visits, "first_fuel")
    keys = ["wallet_id", *RECEIPT]
    rows = (
        visits.join(first_scan, keys, "left")
        .join(first_fuel, keys, "left")
        .join(cross_shop_flags(forecourt_lines(fuel_lines, store, start, as_of, outage), shop), ["wallet_id", "visit_dt"], "left")
    )
    rows = stage(rows, "fuel_rows")
    return FuelReports(
        customers=_customer_level(rows, as_of),
        products=rows.groupBy("prod_type").agg(F.countDistinct("wallet_id").alias("eof_custs")),
        visits=_visit_level(rows, start),
    )


def _customer_level(rows: DataFrame, as_of: date) -> DataFrame:
    receipt = F.struct(*RECEIPT)
    # fixed values: activity windows that end yesterday
    active = {"active_1d": (1, 1), "active_7d": (8, 1), "active_30d": (31, 1), "active_13wk": (92, 1)}
    per_receipt = (
        rows.filter("wallet_id is not null")
        .groupBy("wallet_id", *RECEIPT)
        .agg(
            F.max("visit_week").alias("visit_week"),
            *[F.sum(c).alias(c) for c in ("total_sales", "total_units", "ar_sales", "ar_units", "ar_visit", "earn", "first_ar_visit")],
            *[F.max(f"sv_{f}_flag").alias(f"sv_{f}_flag") for f in CROSS_SHOP_FRAMES],
        )
    )
    per_wallet = per_receipt.groupBy("wallet_id").agg(
        F.countDistinct("visit_week").alias("shopped_weeks"),
        F.count(receipt).alias("total_visits"),
        *[F.sum(c).cast("double").alias(c) for c in ("total_sales", "total_units", "ar_sales", "ar_units")],
        F.sum("ar_visit").alias("ar_visits"),
        F.sum("earn").alias("earn"),
        F.sum("first_ar_visit").alias("first_ar_visit"),
        *[F.max(day_window("visit_dt", as_of, *span).cast("int")).alias(name) for name, span in active.items()],
        *[F.sum(f"sv_{f}_flag").alias(f"fv_cross_shop_{f}") for f in CROSS_SHOP_FRAMES],
    )
    flags, none_nearer = [], F.lit(True)
    for f in CROSS_SHOP_FRAMES:
        count = F.col(f"fv_cross_shop_{f}")
        flags.append(F.when(none_nearer & (count > 0), 1).otherwise(0).alias(f"cust_cross_shop_{f}"))
        none_nearer = none_nearer & (count == 0)
    return per_wallet.select("*", *flags)


def _visit_level(rows: DataFrame, start: date) -> DataFrame:
    keys = ["store_nbr", "visit_dt", "prod_type"]
    since = rows.filter(F.col("visit_dt") >= F.lit(start))
    ids = {
        "receipt": (F.struct(*RECEIPT), {"visits": None, "ar_visits": F.col("ar_visit") == 1, "non_ar_visits": F.col("ar_visit") == 0}),
        "wallet": (F.col("wallet_id"), {"eof_custs": None, "dist_eof_custs": F.col("first_fuel") == 1}),
    }
    doubles = [f"{kind}_{what}" for kind in ("total", "ar", "non_ar") for what in ("sales", "units")]
    sums = {c: F.col(c) for c in (*doubles, "earn")} | {"new_signup": F.col("first_ar_visit")}
    for f in CROSS_SHOP_FRAMES:
        sums |= {f"cross_shop_{f}": F.col(f"sv_{f}_flag"), f"cs_spv_{f}": F.col(f"cs_spv_{f}")}
    return distinct_by_fold(since, keys, ids, sums).withColumns({c: F.col(c).cast("double") for c in doubles})
