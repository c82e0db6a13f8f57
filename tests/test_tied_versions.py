"""Campaigns with many tied versions: facts meet the versions late, and only those that differ."""

from datetime import date, datetime, timedelta

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from __spark_entry__ import oracle_sql
from rolebook import roles
from rolebook.compare import connect, differences
from rolebook.registry import QUERIES, Bound
from stampbook.plans import campaigns, money, trading
from stampbook.scheme import Scheme

SCHEME = Scheme(launch=date(2000, 1, 1), trading_start=date(2000, 1, 1), star_value_change=date(2000, 6, 1), item_obsolete_floor=date(2000, 1, 1))
AS_OF = date(2001, 1, 1)
TIES = 40


@pytest.fixture
def rows_of_joins(spark):
    """The most rows that any join of a query made."""

    def walk(plan):
        metrics = plan.metrics()
        here = metrics.apply("numOutputRows").value() if "Join" in plan.nodeName() and metrics.contains("numOutputRows") else 0
        return max([here, *[walk(plan.children().apply(i)) for i in range(plan.children().size())]])

    def most(df):
        rows = df.collect()
        return rows, walk(df._jdf.queryExecution().executedPlan())

    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield most
    spark.conf.unset("spark.sql.adaptive.enabled")


def _star_products(spark, names, items=30):
    setup = spark.range(TIES).select(
        F.lit(1).alias("cmpgn_id"),
        F.concat(F.lit("star "), (F.col("id") % names).cast("string")).alias("cmpgn_nm"),
        F.lit(datetime(2000, 2, 1)).alias("cmpgn_start_ts"),
        F.lit(datetime(2000, 9, 1)).alias("cmpgn_end_ts"),
        F.lit(0.5).alias("pound_value"),
        F.lit(50).cast("long").alias("value_pence"),
        F.lit("Star Product").alias("activity_type"),
    )
    products = spark.range(items).select(
        F.lit(1).alias("cmpgn_id"),
        F.concat((F.col("id") + 1000000).cast("string"), F.lit("9")).alias("cmpgn_prod_id"),
        F.lit("upc_nbr").alias("cmpgn_prod_level_nm"),
        F.lit("ACTIVE").alias("cmpgn_status_desc"),
    )
    held = spark.range(items).select(
        F.col("id").alias("item_nbr"),
        F.col("id").alias("all_links_item_nbr"),
        (F.col("id") + 1000000).cast("string").alias("upc_nbr"),
        F.col("id").alias("cons_item_nbr"),
        F.col("id").alias("original_cin"),
        *[F.lit("X").alias(c) for c in ("dept_desc", "catg_desc", "vendor_nm")],
        F.lit(date(2099, 1, 1)).alias("obsolete_dt"),
    )
    return trading.star_product_list(products, held, setup, SCHEME)


def test_equal_versions_meet_products_once(spark, rows_of_joins):
    rows, most = rows_of_joins(_star_products(spark, names=1))
    assert len(rows) == 30 and most == 30


def test_lines_are_summed_before_they_meet_names(spark, rows_of_joins):
    lines = spark.range(600).select(
        (F.col("id") % 30).alias("cons_item_nbr"),
        F.lit(date(2000, 3, 1)).alias("visit_dt"),
        (F.col("id") % 100).alias("basket_id"),
        F.lit(2).alias("unmeasured_qty"),
        F.lit(10).cast("long").alias("sale_amt_inc_vat"),
        F.lit(1).alias("channel_src_id"),
    )
    star = spark.createDataFrame(_star_products(spark, TIES, items=3).collect(), _star_products(spark, TIES, items=3).schema)
    rows, most = rows_of_joins(trading.epos_items_daily(star, lines, AS_OF, SCHEME))
    assert {(r.customers_proxy, r["items"], r.spend) for r in rows} == {(30, 120, 600.0)}
    assert len(rows) == 2 * TIES and most < 600 * 2


def test_redemptions_are_summed_before_they_meet_names(spark, rows_of_joins):
    moments = [datetime(2000, 3, 1, 9, m) for m in range(60)]
    scans = spark.createDataFrame([(w, t, "store", "1") for w in range(5) for t in moments], "wallet_id long, event_ts timestamp, chnl_nm string, store_nbr string")
    missions = scans.select(
        "wallet_id", F.lit(1).alias("cmpgn_id"), "event_ts", F.col("event_ts").alias("cmpgn_cmplt_ts"), F.lit(2).alias("rdmpt_cnt"), F.lit(7).cast("long").alias("rdmpt_val"), F.lit("CURRENT").alias("rec_status_ind")
    )
    star = spark.createDataFrame(_star_products(spark, TIES, items=3).collect(), _star_products(spark, TIES, items=3).schema)
    rows, most = rows_of_joins(trading.star_products_daily(star, missions, scans, AS_OF, SCHEME))
    assert {(r.customers, r.first_swipe_customers, r["items"], r.cashpot) for r in rows} == {(5, 5, 600, 300.0)}
    assert len(rows) == 2 * TIES and most <= 300


def test_summed_values_equal_the_sum_of_values(spark):
    kinds = ["Star Product", "Super Star Product", SCHEME.status_label, "Clubs", "ACCA", "Mission", "other", None]
    rows = [
        (f"{kind} {value} {n}", kind, value, datetime(2000, month, 1), cnt, val)
        for kind in kinds
        for value in (50, None)
        for n, months in enumerate([(2,), (8,), (2, 8)])
        for month in months
        for cnt, val in [(1, 5), (None, 6), (2, None)]
    ]
    completed = spark.createDataFrame(rows, "g string, activity_type string, value_pence long, cmpgn_cmplt_ts timestamp, rdmpt_cnt long, rdmpt_val long")
    each = {r.g: r.s for r in completed.groupBy("g").agg(F.sum(campaigns.mission_value_pence(SCHEME)).alias("s")).collect()}
    sums = [c.alias(name) for name, c in
            ((name, F.sum(value)) for name, value in campaigns.mission_sums(SCHEME).items())]
    folded = completed.groupBy("g", "activity_type", "value_pence").agg(*sums)
    assert {r.g: r.s for r in folded.select("g", campaigns.summed_mission_value(SCHEME).alias("s")).collect()} == each


def test_completions_meet_each_type_and_value_once(spark, rows_of_joins):
    moments = [datetime(2000, 3, 1, 9, m) for m in range(20)]
    scans = spark.createDataFrame([(1, t, "store", "1") for t in moments], "wallet_id long, event_ts timestamp, chnl_nm string, store_nbr string")
    missions = scans.select(
        "wallet_id", F.lit(1).alias("cmpgn_id"), F.col("event_ts").alias("cmpgn_seen_ts"), F.col("event_ts").alias("cmpgn_cmplt_ts"), F.lit(2).alias("rdmpt_cnt"), F.lit(7).cast("long").alias("rdmpt_val"), F.lit("CURRENT").alias("rec_status_ind")
    )
    setup = spark.range(TIES).select(F.lit(1).alias("cmpgn_id"), F.lit("Mission").alias("activity_type"), (F.col("id") % 2).alias("value_pence"))
    calendar = spark.createDataFrame([(date(2000, 3, 1), 200009, 2000)], "day_date date, retail_week int, retail_year int")
    week = spark.createDataFrame([(date(2000, 3, 3),)], "end_date date")
    accounts = spark.createDataFrame([(1, "DEFAULT")], "wallet_id long, acct_status_id string")
    rows, most = rows_of_joins(campaigns.mission_completions(missions, scans, setup, calendar, week, accounts, AS_OF, SCHEME))
    assert len(rows) == 40 and most == 40


def test_coupon_attributes_come_from_the_sides(spark, rows_of_joins):
    start = datetime(2000, 2, 1)
    versions = spark.range(TIES).select(
        F.lit("Coupon").alias("cmpgn_tag_array"), F.lit(1).alias("cmpgn_id"), F.concat(F.lit("c"), F.col("id").cast("string")).alias("cmpgn_nm"),
        F.lit(start).alias("cmpgn_start_ts"), F.lit(datetime(2000, 9, 1)).alias("cmpgn_end_ts"), F.lit("ACTIVE").alias("cmpgn_status_desc"), F.col("id").alias("disc_amt"),
    )
    products = spark.range(30).select(
        F.lit(1).alias("cmpgn_id"), F.concat((F.col("id") + 1000000).cast("string"), F.lit("9")).alias("cmpgn_prod_id"), F.when(F.col("id") < 20, "upc_nbr").otherwise("dept").alias("cmpgn_prod_level_nm"),
        F.lit("ACTIVE").alias("cmpgn_status_desc"),
    )
    items = spark.range(10).select(
        F.col("id").alias("item_nbr"), F.lit(4).cast("long").alias("all_links_item_nbr"), (F.col("id") + 1000000).cast("string").alias("upc_nbr"), F.col("id").alias("cons_item_nbr"), F.col("id").alias("original_cin"),
        *[F.concat(F.lit(c), F.col("id").cast("string")).alias(c) for c in ("dept_desc", "catg_desc", "vendor_nm")], F.lit(date(2099, 1, 1)).alias("obsolete_dt"),
    )
    types = spark.createDataFrame([(2, "Game")], "cmpgn_id int, coupon_type string")
    scheme = Scheme(coupon_start=date(2000, 1, 1), coupon_item_obsolete_floor=date(2000, 1, 1))
    details = campaigns.coupon_details(versions, products, items, types, scheme)
    assert details.count() == details.distinct().count() == TIES * 21  # the products without a number are one
    sides = campaigns.coupon_sides(versions, products, items, types, scheme)
    for product in (None, F.col("win").isNotNull(), (F.col("prime_win") == F.col("win")) | F.col("win").isNull(), F.lit(False)):
        for version in (None, F.col("cmpgn_nm") < "c2"):
            plain = campaigns._per_coupon(details, version, product)
            rows, most = rows_of_joins(campaigns._per_coupon(sides, version, product))
            assert plain.columns == campaigns._per_coupon(sides, version, product).columns
            assert rows == plain.collect() and most <= 30


MONTHS = [datetime(1996, 1, 5), datetime(1996, 2, 5), datetime(1999, 3, 5), datetime(2000, 4, 5)]  # on both sides of the change of star values
#: Missions, two kinds of stars, the status group, clubs and none; each size is a campaign of brand 1.
SIZES = [5, 10, 20, 24, 32, 35, 48]


@pytest.fixture
def tied_tables(spark, tmp_path):
    """Tables whose campaigns have ``TIES`` latest versions each, of several values and kinds, some without a value."""
    parts = [
        (25 * n, "red", "Brand#1" if n % 8 else "Brand#2", "PROMO" if tie % 4 == 0 else "LARGE", size, 900.0 + 10 * (tie % 5) if tie % 7 else None)
        for n, (size, tie) in enumerate((size, tie) for size in SIZES for tie in range(TIES))
    ]
    # wallet 75 has no account; some orders of a wallet share a moment
    orders = [(n, (25, 50, 75)[n // 50 % 3], "FFOP"[n % 4], 100.0 + n, MONTHS[n // 3 % 4] + timedelta(minutes=n // 2), ("1-URGENT", "3-MEDIUM", "5-LOW")[n % 3]) for n in range(300)]
    lines = [
        (n % 300, 25 * (n * 11 % len(parts)), 1, n % 3 if n % 13 else None, 3.0, 500.0 * (n % 4) if n % 9 else None, 0.01, 0.01, "ANR"[n % 3], "F" if n % 5 else "O", MONTHS[n % 4])
        for n in range(1500)
    ]
    columns = {
        "region": ("r_regionkey int, r_name string", [(0, "EUROPE")]),
        "nation": ("n_nationkey int, n_name string, n_regionkey int", [(0, "NATION_0", 0)]),
        "customer": ("c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string", [(25, "a", 0, 9.0, "BUILDING"), (50, "b", 0, 9.0, "MACHINERY")]),
        "supplier": ("s_suppkey long, s_name string, s_nationkey int, s_acctbal double", [(1, "s", 0, 9.0)]),
        "part": ("p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double", parts),
        "orders": ("o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string", orders),
        "lineitem": (
            "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
            lines + lines[:100],
        ),
        "events": ("event_id long, user_id long, event_type string, value double, ts timestamp_ntz", [(1, 1, "view", 1.0, datetime(2024, 1, 1))]),
    }
    for table, (schema, rows) in columns.items():
        pq.write_table(spark.createDataFrame(rows, schema).toArrow(), tmp_path / f"{table}.parquet")
    return str(tmp_path), len(lines) + 100


def test_liability_sums_tied_versions_before_they_meet_vouchers(spark, rows_of_joins, tied_tables):
    folder, lines = tied_tables
    df = QUERIES["liability"](spark, folder)
    rows, most = rows_of_joins(df)
    # a completion meets each kind of its campaign once, a voucher its campaign once
    assert most <= 3 * lines
    assert {1, 8, 9, 10, 11} <= {r["index"] for r in rows if r.val}
    assert not differences(df, connect(folder), oracle_sql()["liability"])
    each = Bound(spark, folder)
    plain = money.liability(each.completions, each.credits, each.external_credits, each.pot_expiries, each.account_rows, each.voucher_rows, roles.AS_OF, roles.SCHEME)
    assert sorted(map(tuple, plain.collect()), key=str) == sorted(map(tuple, rows), key=str)


def test_totals_of_completions_equal_the_sum_over_values(spark):
    scheme = Scheme(launch=date(2000, 1, 1), star_value_change=date(2000, 6, 1))
    kinds = ["Star Product", "Super Star Product", scheme.status_label, "Clubs", "ACCA", "Mission", "other", None]
    # campaign n has the n-th kind with three values and one without, and every third the next kind as well
    versions = [(n, kind, value) for n, kind in enumerate(kinds) for value in (30, 50, 50, 70, None)]
    versions += [(n, kinds[(n + 1) % 8], value) for n in range(0, 8, 3) for value in (50, None)] + [(8, "Mission", None)]
    setup = spark.createDataFrame(versions, "cmpgn_id int, activity_type string, value_pence long")
    moments = [datetime(2000, 2, 1, 9), datetime(2000, 8, 1, 9)]
    scans = spark.createDataFrame(
        [(w, t, "store", s) for w in (1, 2, None) for t in moments for s in (("1", "1", "2") if w == 2 else ("1",))],
        "wallet_id long, event_ts timestamp, chnl_nm string, store_nbr string",
    )
    # equal rows, and rows that differ only in what a kind does not read; campaign 9 has no version
    missions = spark.createDataFrame(
        [(w, c, t, t, cnt, val, "CURRENT") for w in (1, 2, None) for c in [*range(10), None] for t in moments for cnt, val in [(1, 5), (1, 5), (1, 6), (0, 5), (0, 6), (2, 3), (3, 2), (None, 6), (2, None), (None, None)]],
        "wallet_id long, cmpgn_id int, cmpgn_seen_ts timestamp, cmpgn_cmplt_ts timestamp, rdmpt_cnt int, rdmpt_val long, rec_status_ind string",
    )
    calendar = spark.createDataFrame([(date(2000, 3, 1), 200009, 2000)], "day_date date, retail_week int, retail_year int")
    week = spark.createDataFrame([(date(2000, 3, 3),)], "end_date date")
    accounts = spark.createDataFrame([(1, "DEFAULT"), (2, "TEMP"), (2, "DEFAULT")], "wallet_id long, acct_status_id string")

    def sums(per_value):
        rows = campaigns.mission_completions(missions, scans, setup, calendar, week, accounts, AS_OF, scheme, per_value=per_value)
        total = rows.groupBy("cmpgn_id", "cmpgn_cmplt_ts", "activity_type", "wallet_id", "store_nbr", "acct_status_id").agg(F.sum("mission_value_pence"))
        return sorted(map(tuple, total.collect()), key=str)

    assert sums(False) == sums(True)
