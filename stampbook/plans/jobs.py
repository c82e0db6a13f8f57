"""Remaining jobs: order participation, opt-in figures, KPI row, app usage, row counts."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stampbook.functions import on_days, profile_or_wallet, ratio
from stampbook.operators import distinct_by_fold
from stampbook.plans.bases import new_to_brand
from stampbook.scheme import Scheme
from stampbook.sources import catalog_tables


def order_participation(
    orders: DataFrame,
    scans: DataFrame,
    calendar_days: DataFrame,
    regions: Sequence[tuple[str, Sequence[str], date, date]],
    default_region: tuple[str, date, date],
    submitted_from: date,
    delivered_from: date,
    as_of: date,
) -> DataFrame:
    """Online orders with and without a scan, per delivery day, order day and store.

    ``regions`` lists (name, stores, ordered after, delivered after) in order of
    precedence; stores in none of them fall under ``default_region``.
    """
    matched = scans.select(F.col("trans_rcpt_nbr").alias("web_order_id"), "wallet_id").distinct().withColumn(
        "_scanned", F.lit(True)
    )
    store = F.col("store_id")
    region, allowed = F.lit(default_region[0]), _after(default_region[1], default_region[2])
    for name, stores, ordered, delivered in reversed(list(regions)):
        listed = store.isin(*stores)
        region = F.when(listed, F.lit(name)).otherwise(region)
        allowed = F.when(listed, _after(ordered, delivered)).otherwise(allowed)
    rows = (
        orders.filter(
            on_days("order_sbmtd_ts", submitted_from, None)
            & (F.col("dlvr_dt") >= F.lit(delivered_from))
            & (F.col("dlvr_dt") < F.lit(as_of))
        )
        .select(
            F.col("dlvr_dt").alias("delivery_dt"),
            F.to_date("order_sbmtd_ts").alias("order_dt"),
            F.col("outbase_store_id").alias("store_id"),
            "web_order_id",
            "singl_profl_id",
            "pos_tot_amt",
        )
        .filter(allowed)
        .join(matched, "web_order_id", "left")
    )
    amount = F.coalesce(F.col("pos_tot_amt"), F.lit(0))
    totals = distinct_by_fold(
        rows,
        ["delivery_dt", "order_dt", "store_id"],
        {
            "order": (F.col("web_order_id"), {"total_orders": None, "reward_orders": F.col("_scanned")}),
            "customer": (F.col("singl_profl_id"), {"total_customers": None}),
            "wallet": (F.col("wallet_id"), {"reward_customers": None}),
        },
        {"total_sales": amount, "reward_sales": F.when(F.col("_scanned"), amount).otherwise(0)},
    ).withColumns({c: F.col(c).cast("double") for c in ("total_sales", "reward_sales")})

    def weeks(day: str, alias: str) -> DataFrame:
        return calendar_days.select(F.col("day_date").alias(day), F.col("retail_week").alias(alias))

    return (
        totals.withColumn("region", region)
        .join(weeks("delivery_dt", "delivery_wk"), "delivery_dt")
        .join(weeks("order_dt", "order_wk"), "order_dt")
    )


def _after(ordered: date, delivered: date) -> Column:
    return (F.col("order_dt") > F.lit(ordered)) & (F.col("delivery_dt") > F.lit(delivered))


def opt_in_figures(
    accounts: DataFrame,
    consents: DataFrame,
    profiles: DataFrame,
    contactable: DataFrame,
    device_file: DataFrame,
    as_of: date,
) -> DataFrame:
    """Email and push opt-in of permanent accounts, for all and for new customers.

    Push consent comes from the device file where the profile is listed there,
    otherwise from the loyalty record.
    """
    people = (
        accounts.filter(on_days("regtn_ts", None, as_of) & (F.col("acct_status_id") == "DEFAULT"))
        .select(profile_or_wallet().alias("singl_profl_id"), "regtn_ts", "dt_cnvrt_to_full_acct_ts")
        .withColumn("guest_ind", F.col("dt_cnvrt_to_full_acct_ts").isNull() | (F.col("regtn_ts") != F.col("dt_cnvrt_to_full_acct_ts")))
        .select("singl_profl_id", "regtn_ts", "guest_ind")
        .distinct()
    )
    devices = (
        device_file.filter("notification_opt_in is not null")
        .groupBy(F.col("named_user").alias("singl_profl_id"))
        .agg(F.max((F.col("notification_opt_in") == "true").cast("int")).alias("file_push"))
    )
    merged = (
        people.join(consents.select("singl_profl_id", "push_notif_consent"), "singl_profl_id", "left")
        .join(
            profiles.select("singl_profl_id", "registration_channel", "registration_date", "tnc_accepted_at_loyalty"),
            "singl_profl_id",
            "left",
        )
        .join(
            contactable.select(F.col("single_profile_id").alias("singl_profl_id"), "is_email_contactable"),
            "singl_profl_id",
            "left",
        )
        .join(devices, "singl_profl_id", "left")
    )
    loyalty_push = F.when(F.col("push_notif_consent") == "Y", 1).otherwise(0)
    rows = merged.select(
        F.coalesce(F.col("is_email_contactable") == "Y", F.lit(False)).alias("email"),
        (F.coalesce("file_push", loyalty_push) == 1).alias("push"),
        F.coalesce(new_to_brand(), F.lit(False)).alias("is_new"),
    )
    groups = {"all spids": F.lit(True), "new spids": F.col("is_new")}
    cells = {"n": F.lit(True), "any": F.col("email") | F.col("push"), "email": F.col("email"), "push": F.col("push")}
    totals = rows.agg(
        *[
            F.count_if(inside & cell).alias(f"{c}{i}")
            for i, inside in enumerate(groups.values())
            for c, cell in cells.items()
        ]
    )
    lines = [
        F.struct(
            F.lit(name).alias("type"),
            F.col(f"n{i}").alias("total_spids"),
            F.col(f"any{i}").alias("num_opt_in"),
            ratio(f"any{i}", f"n{i}").alias("perc_opt_in"),
            F.col(f"email{i}").alias("num_email_opt_in"),
            ratio(f"email{i}", f"n{i}").alias("perc_email_opt_in"),
            F.col(f"push{i}").alias("num_push_opt_in"),
            ratio(f"push{i}", f"n{i}").alias("perc_push_opt_in"),
        )
        for i, name in enumerate(groups)
    ]
    return totals.select(F.inline(F.array(*lines)))


def kpi_row(
    scans: DataFrame,
    baskets: DataFrame,
    missions_by_day: DataFrame,
    ratings: DataFrame,
    as_of: date,
    invested_from: date,
    scheme: Scheme = Scheme(),
) -> DataFrame:
    """Key figures of one day, each an aggregate read as a scalar subquery."""
    window_start = as_of - timedelta(days=scheme.active_days)
    active = scans.filter(on_days("event_ts", window_start, as_of)).agg(
        F.countDistinct("wallet_id").alias("active_members")
    )
    connected = baskets.filter(
        on_days("timestamp", window_start, as_of + timedelta(days=1))
        & F.col("is_spid_connected")
        & F.col("is_active")
        & F.col("is_spid_connected_direct")
    ).agg(F.countDistinct("spid").alias("active_connected_cust"))
    invested = missions_by_day.filter(F.col("cmpgn_cmplt_dt") >= F.lit(invested_from)).agg(
        F.round(F.sum("earn_value_gbp"), 2).alias("invested_into_cashpot")
    )
    rating = ratings.agg(F.avg("rating").alias("app_rating"))
    return rating.select(
        F.lit(as_of).alias("date"),
        "app_rating",
        active.scalar().alias("active_members"),
        connected.scalar().alias("active_connected_cust"),
        invested.scalar().alias("invested_into_cashpot"),
    )


def app_usage_merge(opens: DataFrame, engagement: DataFrame, removes: DataFrame) -> DataFrame:
    """Daily app metrics of the three frames on the dates they share."""
    return opens.join(engagement, "date").join(removes, "date")


def counted_rows(
    spark: SparkSession,
    tables: Mapping[str, Callable[[], DataFrame]],
    checked_at: datetime,
    filters: Mapping[str, str] | None = None,
    catalog: str = "spark_catalog",
    schema: str = "default",
) -> DataFrame:
    """``row_count_monitor``, computed; if that job fails, each table is counted in a job of its own.

    A table whose count fails reports the error's first line and no count.
    """
    whole = row_count_monitor(spark, tables, checked_at, filters, catalog, schema)
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in whole.schema)
    try:
        return spark.createDataFrame(whole.collect(), columns)
    except Exception as e:  # noqa: BLE001 - any failure becomes the table's error text
        if len(tables) > 1:
            rows = []
            for name, load in tables.items():
                rows += counted_rows(spark, {name: load}, checked_at, filters, catalog, schema).collect()
            return spark.createDataFrame(rows, columns)
        (name,) = tables
        row = (catalog, schema, name, (filters or {}).get(name), None, checked_at, str(e).split("\n")[0])
        return spark.createDataFrame([row], columns)


def catalog_row_counts(
    spark: SparkSession,
    database: str,
    checked_at: datetime,
    filters: Mapping[str, str] | None = None,
    pattern: str | None = None,
    catalog: str = "spark_catalog",
) -> DataFrame:
    """``counted_rows`` of all tables and views that the catalog lists for a database.

    A count without a filter has no columns to read: of Parquet files Spark reads the row counts in their footers.
    """
    return counted_rows(spark, catalog_tables(spark, database, pattern), checked_at, filters, catalog, database)


def row_count_monitor(
    spark: SparkSession,
    tables: Mapping[str, Callable[[], DataFrame]],
    checked_at: datetime,
    filters: Mapping[str, str] | None = None,
    catalog: str = "spark_catalog",
    schema: str = "default",
) -> DataFrame:
    """Row count per table; a table that cannot be read or filtered reports its error.

    The counts are one plan, a union of one-row aggregates.
    """
    filters = filters or {}
    result = None
    for name, load in tables.items():
        try:
            df = load()
            if filters.get(name):
                df = df.filter(filters[name])
            count, error = df.agg(F.count(F.lit(1)).alias("row_count")), None
            count.schema  # resolves the plan, so errors surface here and not for the whole union
        except Exception as e:  # noqa: BLE001 - any failure becomes the table's error text
            count, error = spark.range(1).select(F.lit(None).cast("long").alias("row_count")), str(e).split("\n")[0]
        row = count.select(
            F.lit(catalog).alias("table_catalog"),
            F.lit(schema).alias("table_schema"),
            F.lit(name).alias("table_name"),
            F.lit(filters.get(name)).cast("string").alias("table_filter"),
            "row_count",
            F.lit(checked_at).alias("checked_at"),
            F.lit(error).cast("string").alias("error"),
        )
        result = row if result is None else result.unionByName(row)
    return result
