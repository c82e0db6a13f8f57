"""Boundary rows of the reports that the test tables do not reach."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from stampbook.plans import activity, bases, crm, jobs, money
from stampbook.scheme import Scheme

AS_OF = date(2024, 6, 1)
SCHEME = Scheme(launch=date(2023, 1, 1), series_start=date(2023, 1, 1))


def ts(day, hour=0):
    return datetime(day.year, day.month, day.day, hour)


def ago(n):
    return AS_OF - timedelta(days=n)


def scans(spark, rows):
    data = [(w, str(s), ts(day, 10), "store") for w, day, s in rows]
    return spark.createDataFrame(data, "wallet_id long, store_nbr string, event_ts timestamp, chnl_nm string")


def accounts(spark, rows):
    data = [(w, None if st == "TEMP" else f"P{w}", ts(reg), st) for w, reg, st in rows]
    return spark.createDataFrame(data, "wallet_id long, singl_profl_id string, regtn_ts timestamp, acct_status_id string")


def test_funnel_gap_edges(spark):
    history = [
        (1, [ago(3)]),  # first scan within a week
        (2, [ago(50), ago(2)]),  # first scan older than a week, span under 92 days
        (3, [ago(200), ago(200 - 93)]),  # back after a gap of 93 days
        (4, [ago(200), ago(200 - 92)]),  # a gap of 92 days still counts as retained
        (5, [ago(300)]),  # lapsed, permanent
        (6, [ago(300)]),  # lapsed, expired guest: dropped
        (7, [ago(200), ago(100), ago(100)]),  # two scans on the day it comes back
    ]
    rows = [(w, day, 1) for w, days in history for day in days]
    people = [(w, ago(400), "TEMP" if w == 6 else "DEFAULT") for w, _ in history]
    got = activity.active_funnel(scans(spark, rows), accounts(spark, people), AS_OF, ago(44), SCHEME).collect()
    by_week = {r["week_cat"]: r for r in got}
    assert by_week["1"]["total"] == 2 and by_week["1"]["new_one_scanners"] == 1 and by_week["1"]["new_active"] == 1
    assert by_week["Lapsed"]["total"] == 4
    assert by_week["Lapsed"]["reactive_active"] == 2 and by_week["Lapsed"]["recycling_active"] == 1
    assert sum(r["total"] for r in got) == 6


def test_nursery_lapse_boundary(spark):
    day = ago(200)
    spine = spark.createDataFrame([(day + timedelta(days=n),) for n in range(200)], "full_date date")
    rows = activity.nursery_time_series(scans(spark, [(1, day, 1)]), spine, SCHEME).collect()
    lapsed = sorted(r["full_date"] for r in rows if r["lapsed"])
    nursery = sorted(r["full_date"] for r in rows if r["nursery"])
    # a row for D looks one day ahead: 93 days after the scan is D = scan + 92
    assert lapsed[0] == day + timedelta(days=92)
    assert nursery == [day + timedelta(days=n) for n in range(0, 30)]


def test_expired_guest_boundary(spark):
    people = accounts(spark, [(1, ago(37), "TEMP"), (2, ago(38), "TEMP"), (3, ago(38), "DEFAULT")])
    flags = people.select("wallet_id", bases.expired_guest(AS_OF, 37).alias("x")).collect()
    assert {r["wallet_id"]: r["x"] for r in flags} == {1: 0, 2: 1, 3: 0}


def test_scan_base_drops_test_stores(spark):
    rows = scans(spark, [(1, ago(1), "4582"), (1, ago(1), "TST1"), (1, ago(1), "-1")])
    assert bases.scan_base(rows, AS_OF, SCHEME).count() == 2


def test_saver_bands_have_no_gaps(spark):
    df = spark.createDataFrame([(i, 7, v) for i, v in enumerate([1999.5, 999.99, 7000.0, -5.0])],
                               "wallet_id int, scheme_id int, curr_cash_bnk_pnts_qty double")
    rows = money.saver_bands(df, Scheme(saver_scheme=7)).collect()
    assert {r["cashpot"] for r in rows} == {"£10-£19.99", "<£10", ">=£70"} and sum(r["customer_count"] for r in rows) == 4


@pytest.mark.parametrize("week, label", [(202401, "1-4"), (202404, "1-4"), (202405, "5-8"), (202452, "48-52"), (202453, "0")])
def test_period_of_week(spark, week, label):
    df = spark.createDataFrame([(week,)], "week_id int")
    assert df.select(crm.period_of_week().alias("p")).first()["p"] == label


def test_previous_week_after_a_53_week_year(spark):
    from stampbook.functions import retail_calendar

    calendar = retail_calendar(spark, date(2020, 12, 1), date(2022, 2, 28))
    weeks = {r["day_date"]: r["retail_week"] for r in calendar.collect()}
    first = min(day for day, w in weeks.items() if w == 202201)
    assert crm.previous_week(calendar, first).first()["retail_week"] == weeks[first - timedelta(days=1)] == 202153


def test_outlier_replacement(spark):
    rows = [(w, "store", ago(10), 1, 10.0) for w in range(30)] + [(99, "store", ago(10), 1, 1000.0)]
    spend = spark.createDataFrame(rows, "wallet_id long, chnl_nm string, visit_dt date, trans_nbr int, sale_amt_inc_vat double")
    people = spark.createDataFrame([(w, f"P{w}") for w in (1, 99)], "wallet_id long, singl_profl_id string")
    control = people.select(F.lit("m").alias("control_group"), F.lit("s").alias("segment"), F.col("singl_profl_id").alias("spid"))
    calendar = spark.createDataFrame([(ago(10), 202422)], "day_date date, retail_week int")
    row = crm.store_test_vs_control(control, people, spend, calendar, 202401, (202401, 202410)).first()
    mean = round((30 * 10 + 1000) / 31, 2)
    assert row["sales"] == 1010.0 and row["new_sales"] == pytest.approx(10 + mean) and row["analysis_type"] == "Post"


def test_channel_orders_count_repeated_rows_once(spark):
    rows = [(1, 10, ago(50), 2, 10), (1, 10, ago(50), 2, 10), (1, 10, ago(50), 1, 4), (1, 11, ago(200), 1, 5)]
    orders = spark.createDataFrame(rows, "wallet long, id long, day date, items int, sales int")
    found = crm.channel_orders(orders, "id", "wallet", "day", "items", "sales", (ago(60), ago(50)))
    assert [tuple(r) for r in found.collect()] == [(1, ago(50), 1, 3, 14)]


def test_crm_counts_orders_per_send_and_handles_no_orders(spark):
    sends = spark.createDataFrame(
        [(1, "J", "Emailed", ago(50)), (1, "J", "Emailed", ago(50)), (2, "J", "Control", ago(50))],
        "_key long, journey_name string, groups string, journey_date date")
    orders = spark.createDataFrame(
        [(1, ago(50), 1, 2, 10), (1, ago(36), 1, 2, 10), (1, ago(35), 1, 2, 10), (1, ago(92), 1, 1, 5), (1, ago(93), 1, 1, 5)],
        "_key long, journey_date date, orders int, items int, sales int")
    rows = {(r["type"], r["groups"]): r for r in crm.crm_send_level(sends, {"web": orders}).collect()}
    post, pre = rows["Post", "Emailed"], rows["Pre", "Emailed"]
    assert (post["customers"], post["web_orderers"], post["web_orders"], post["web_sales"]) == (1, 1, 4, 40.0)
    assert (pre["web_orders"], pre["web_sales"]) == (2, 10.0)
    none = rows["Post", "Control"]
    assert none["web_orders"] == 0 and none["web_avg_order"] is None and none["web_sales"] is None


def test_prune_drops_a_journey_missing_a_group_on_any_day(spark):
    rows = [("A", ago(1), "x", 600), ("A", ago(1), "y", 600), ("A", ago(2), "x", 600), ("B", ago(1), "x", 600), ("B", ago(1), "y", 499),
            ("C", ago(1), "x", 500), ("C", ago(1), "y", 500)]
    df = spark.createDataFrame(rows, "journey_name string, journey_date date, groups string, customers int")
    assert {r["journey_name"] for r in crm.prune_journeys(df).collect()} == {"C"}


def test_opt_in_falls_back_to_the_loyalty_record(spark):
    people = spark.createDataFrame([(i, f"P{i}", ts(ago(9)), "DEFAULT", None) for i in (1, 2, 3)],
                                   "wallet_id long, singl_profl_id string, regtn_ts timestamp, acct_status_id string, dt_cnvrt_to_full_acct_ts timestamp")
    consents = spark.createDataFrame([("P1", "Y"), ("P2", "Y"), ("P3", "N")], "singl_profl_id string, push_notif_consent string")
    empty = spark.createDataFrame([], "singl_profl_id string, registration_channel string, registration_date timestamp, tnc_accepted_at_loyalty timestamp")
    contact = spark.createDataFrame([], "single_profile_id string, is_email_contactable string")
    device = spark.createDataFrame([("P2", "false"), ("P3", "false"), ("P3", "true"), ("P1", None)],
                                   "named_user string, notification_opt_in string")
    rows = {r["type"]: r for r in jobs.opt_in_figures(people, consents, empty, contact, device, AS_OF).collect()}
    assert rows["all spids"]["num_push_opt_in"] == 2  # P1 by loyalty, P3 by file, P2 opted out by file
    assert rows["new spids"]["total_spids"] == 0 and rows["new spids"]["perc_opt_in"] is None


def test_saturday_after_last_friday():
    # Friday itself still reports the week that ended a week ago
    assert activity.saturday_after_last_friday(date(2024, 2, 9)) == date(2024, 2, 3)
    assert activity.saturday_after_last_friday(date(2024, 2, 10)) == date(2024, 2, 10)
    assert activity.saturday_after_last_friday(date(2024, 2, 8)) == date(2024, 2, 3)


def test_an_incremental_run_reads_the_window_only(spark):
    from stampbook.plans import activity, incremental

    as_of, start = date(2024, 6, 1), date(2024, 1, 1)
    days = [start + timedelta(days=n) for n in range(153)]
    calendar = spark.createDataFrame([(d,) for d in days], "day_date date")
    rows = [(i % 7, datetime(d.year, d.month, d.day, 9)) for i, d in enumerate(days)]
    history = spark.createDataFrame(rows, "wallet_id long, event_ts timestamp")
    spine = calendar.selectExpr("day_date as full_date")
    whole = {tuple(r) for r in activity.activity_time_series(history.filter("event_ts < '2024-06-01'"), spine).collect()}
    early = spark.createDataFrame(sorted(r for r in whole if r[0] < date(2024, 5, 20)), "full_date date, active_prev_d long, active_prev_7d long, active_prev_30d long, active_prev_91d long")
    # a scan that is too old for the window would fail the job if it were read
    recent = history.filter("event_ts >= '2024-01-30'")
    found = incremental.activity_time_series(early, recent, calendar, as_of, start)
    assert {tuple(r) for r in found.collect()} == whole
    gap = early.filter("full_date != date '2024-02-10'")
    assert {tuple(r) for r in incremental.activity_time_series(gap, history, calendar, as_of, start).collect()} == whole
