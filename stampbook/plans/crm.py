"""CRM measurement: sends before and after, control groups, test against control."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stampbook.functions import bands_from_edges, on_days, ratio
from stampbook.functions.bands import band_label
from stampbook.operators import window_sums

# fixed values: send day windows and the labels they are reported under
PRE_FRAME, PRE_DAYS = (-42, -1), 42
POST_FRAME, POST_DAYS = (0, 14), 15
JOURNEY_ID = 1234
# fixed values: service messages that are not measured
EXCLUDED_JOURNEYS = ("CashpotExpiry", "Abandoned", "Triggers")
# fixed values: first week of each period of the retail year, in the 4-4-5 pattern
PERIOD_EDGES = (1, 5, 9, 14, 18, 22, 27, 31, 35, 40, 44, 48)
PERIOD_LABELS = (
    "1-4", "5-8", "9-13", "14-17", "18-21", "22-26", "27-30", "31-34", "35-39", "40-43", "44-47", "48-52",
)


def journeys(sends: DataFrame, start: date, end: date, key: str) -> DataFrame:
    """Measured sends in ``[start, end]``: key, journey name, group and day."""
    measured = F.lit(True)
    for name in EXCLUDED_JOURNEYS:
        measured = measured & ~F.col("campaignname").contains(name)
    day = F.to_date("eventdate")
    return sends.filter(on_days("eventdate", start, end + timedelta(days=1)) & measured).select(
        F.col(key).alias("_key"),
        F.col("campaignname").alias("journey_name"),
        F.when(F.col("sendtype") == "Send", "Emailed").otherwise(F.col("sendtype")).alias("groups"),
        day.alias("journey_date"),
    )


def channel_orders(
    orders: DataFrame,
    order_id: str,
    customer: str,
    day: str,
    items: str,
    sales: str,
    sent: tuple[date, date] | None = None,
) -> DataFrame:
    """Orders in the common shape used by ``crm_send_level``, one row per customer, order and day.

    Repeated rows of an order count once; its different rows add up. ``sent`` gives the
    first and last send day: only orders within the frames around them are read.
    """
    if sent is not None:
        first, last = sent[0] + timedelta(days=PRE_FRAME[0]), sent[1] + timedelta(days=POST_FRAME[1] + 1)
        orders = orders.filter(on_days(day, first, last))
    rows = orders.select(
        F.col(customer).alias("_key"),
        F.to_date(day).alias("journey_date"),
        F.col(order_id).alias("_order"),
        F.col(items).alias("items"),
        F.col(sales).alias("sales"),
    ).distinct()
    folded = rows.groupBy("_key", "journey_date", "_order").agg(F.sum("items").alias("items"), F.sum("sales").alias("sales"))
    return folded.select("_key", "journey_date", F.lit(1).alias("orders"), "items", "sales")


def crm_send_level(sends: DataFrame, channels: dict[str, DataFrame]) -> DataFrame:
    """Orderers, orders, items and sales before and after each send, per channel.

    ``sends`` comes from ``journeys``, each channel from ``channel_orders``.
    A customer's orders are summed per day and read through native day frames
    around each send day, so no send is paired with single orders. A customer
    reached more than once by a journey on a day counts per send, as orders do.
    """
    keys = ["journey_name", "groups", "journey_date"]
    frames = {"Pre": PRE_FRAME, "Post": POST_FRAME}
    per_customer = sends.groupBy(*keys, "_key").agg(F.count(F.lit(1)).alias("sends"))
    measures = ("orders", "items", "sales")
    # all channels share one pass: each brings its own measure columns
    orders = None
    for name, rows in channels.items():
        named = rows.select("_key", "journey_date", *[F.col(m).alias(f"{name}_{m}") for m in measures])
        orders = named if orders is None else orders.unionByName(named, allowMissingColumns=True)
    columns = [f"{name}_{m}" for name in channels for m in measures]
    # only customers who were sent something
    orders = orders.join(per_customer.select("_key").distinct(), "_key", "left_semi")
    sums = window_sums(per_customer, orders, "_key", "journey_date", frames, columns)
    rows = per_customer.join(sums, ["_key", "journey_date"], "left")
    times = F.col("sends")
    aggregates = [F.count("_key").alias("customers")]
    for f in frames:
        for name in channels:
            aggregates.append(F.count(f"{f}_{name}_orders").alias(f"{f}_{name}_orderers"))
            for m in measures:
                aggregates.append(F.sum(F.col(f"{f}_{name}_{m}") * times).alias(f"{f}_{name}_{m}"))
    totals = rows.groupBy(*keys).agg(*aggregates)

    def half(frame: str, days: int) -> Column:
        columns = [F.lit(frame).alias("type"), F.lit(days).alias("days_analysed")]
        for name in channels:
            columns.append(F.col(f"{frame}_{name}_orderers").alias(f"{name}_orderers"))
            columns.append(F.coalesce(F.col(f"{frame}_{name}_orders"), F.lit(0)).alias(f"{name}_orders"))
            columns += [F.col(f"{frame}_{name}_{m}").cast("double").alias(f"{name}_{m}") for m in ("items", "sales")]
        return F.struct(*columns)

    long = totals.select(
        *keys, "customers", F.inline(F.array(half("Pre", PRE_DAYS), half("Post", POST_DAYS)))
    ).withColumn("journey_id", F.lit(JOURNEY_ID))
    for name in channels:
        long = (
            long.withColumn(f"{name}_orderers_mailed", ratio(f"{name}_orderers", "customers"))
            .withColumn(f"{name}_avg_order", ratio(f"{name}_sales", f"{name}_orders"))
            .withColumn(f"{name}_orders_orderers", ratio(f"{name}_orders", f"{name}_orderers"))
            .withColumn(f"{name}_sales_mailed", ratio(f"{name}_sales", "customers"))
            .withColumn(f"{name}_items_order", ratio(f"{name}_items", f"{name}_orders"))
        )
    return long


def prune_journeys(results: DataFrame, min_customers: int = 500, groups_needed: int = 2) -> DataFrame:
    """Drop small groups, then every journey name that lacks a group on any of its days."""
    large = results.filter(F.col("customers") >= min_customers)
    return large.join(incomplete_journeys(large, groups_needed), "journey_name", "left_anti")


def incomplete_journeys(results: DataFrame, groups_needed: int = 2) -> DataFrame:
    """The journey names that have another number of groups on any of their days."""
    return (
        results.groupBy("journey_date", "journey_name")
        .agg(F.countDistinct("groups").alias("n"))
        .filter(F.col("n") != groups_needed)
        .select("journey_name")
        .distinct()
    )


def period_of_week(week: str = "week_id") -> Column:
    number = F.col(week) % 100
    named = band_label(number, bands_from_edges(PERIOD_EDGES, PERIOD_LABELS))
    return F.when(number <= 52, F.coalesce(named, F.lit("0"))).otherwise("0")


def analysis_type(week: str, pre: tuple[int, int]) -> Column:
    return F.when(F.col(week).between(*pre), "Pre").when(F.col(week) > pre[1], "Post")


def crm_monthly(
    control: DataFrame,
    orders: DataFrame,
    calendar_days: DataFrame,
    channel: str,
    after_week: int,
    pre_weeks: tuple[int, int],
    order_day: str = "order_day",
) -> DataFrame:
    """Orderers, orders and sales of control-group segments per retail week.

    ``control`` has control_group, segment, spid; ``orders`` has order_id, spid,
    sales and ``order_day``.
    """
    weeks = calendar_days.filter(F.col("retail_week") > after_week).select(
        F.col("day_date").alias(order_day), F.col("retail_week").alias("week_id")
    )
    # orders fold to one row per customer and week before they meet the segments
    per_customer = (
        orders.select("order_id", "spid", "sales", order_day)
        .join(weeks, order_day)
        .drop(order_day)
        .distinct()
        .groupBy("spid", "week_id")
        .agg(F.count("order_id").alias("orders"), F.sum("sales").alias("sales"))
    )
    return (
        control.join(per_customer, "spid")
        .groupBy("control_group", "segment", "week_id")
        .agg(
            F.countDistinct("spid").alias("orderers"),
            F.sum("orders").alias("orders"),
            F.sum("sales").cast("double").alias("sales"),
        )
        .select(
            "control_group",
            "segment",
            "week_id",
            period_of_week().alias("periods"),
            F.lit(channel).alias("channel"),
            analysis_type("week_id", pre_weeks).alias("analysis_type"),
            "orderers",
            "orders",
            "sales",
        )
    )


def store_test_vs_control(
    control: DataFrame,
    accounts: DataFrame,
    spend: DataFrame,
    calendar_days: DataFrame,
    from_week: int,
    pre_weeks: tuple[int, int],
    weeks: Sequence[int] | None = None,
    sigmas: float = 3.0,
) -> DataFrame:
    """Segment spend per week with customers outside mean ± 3 sigma set to the week's mean.

    ``spend`` has wallet_id, chnl_nm, visit_dt, trans_nbr and sale_amt_inc_vat.
    The week's mean and deviation are taken over single transactions, and an
    outlying customer's sales become mean x visits.
    """
    days = calendar_days.filter(F.col("retail_week") > from_week - 1).select(
        F.col("day_date").alias("visit_dt"), F.col("retail_week").alias("week_id")
    )
    amount = F.col("sale_amt_inc_vat")
    dated = spend.filter("chnl_nm = 'store'").join(days, "visit_dt")
    per_wallet = dated.groupBy("wallet_id", "chnl_nm", "week_id").agg(
        F.count("trans_nbr").alias("visits"), F.round(F.sum(amount), 2).cast("double").alias("sales")
    )
    per_week = dated.groupBy("chnl_nm", "week_id").agg(
        F.round(F.avg(amount.cast("double")), 2).alias("week_mean"),
        F.round(F.stddev_samp(amount.cast("double")), 2).alias("week_sd"),
    )
    population = control.join(
        accounts.select("wallet_id", F.col("singl_profl_id").alias("spid")), "spid"
    ).select("control_group", "segment", "spid", "wallet_id")
    spread = F.lit(sigmas) * F.col("week_sd")
    outlying = (F.col("sales") < F.col("week_mean") - spread) | (F.col("sales") > F.col("week_mean") + spread)
    rows = (
        population.join(per_wallet, "wallet_id")
        .join(per_week, ["chnl_nm", "week_id"])
        .withColumn(
            "adjusted", F.when(outlying, F.col("week_mean") * F.col("visits")).otherwise(F.col("sales"))
        )
    )
    if weeks is not None:
        rows = rows.filter(F.col("week_id").isin(*weeks))
    return (
        rows.groupBy("control_group", "segment", "week_id", F.col("chnl_nm").alias("channel"))
        .agg(
            F.count("spid").alias("orderers"),
            F.sum("visits").alias("orders"),
            F.round(F.sum("adjusted"), 2).alias("new_sales"),
            F.round(F.sum("sales"), 2).alias("sales"),
        )
        .select(
            "control_group",
            "week_id",
            period_of_week().alias("periods"),
            analysis_type("week_id", pre_weeks).alias("analysis_type"),
            "segment",
            "channel",
            "orderers",
            "orders",
            "new_sales",
            "sales",
        )
    )


def previous_week(calendar_days: DataFrame, as_of: date) -> DataFrame:
    """Retail week before the one holding ``as_of``, read from the calendar (one row)."""
    this_week = calendar_days.filter(F.col("day_date") == F.lit(as_of)).agg(F.max("retail_week").alias("w")).scalar()
    return calendar_days.filter(F.col("retail_week") < this_week).agg(F.max("retail_week").alias("retail_week"))
