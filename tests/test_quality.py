"""Data-quality rules with the golden values of the check library."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from rolebook import queries_quality
from rolebook.registry import Bound
from stampbook.dq import checks, metrics, rollup
from stampbook.dq.registry import CHECKS, check
from stampbook.plans import jobs

# newest first, from 2024-02-05 back to 2024-01-17
COUNTS = [17, 2301, 1370, 1266, 1125, 1604, 1179, 1163, 1311, 1508, 1455, 1554, 878, 745, 577, 716, 792, 787, 826, 826]
DAYS = [date.fromordinal(date(2024, 2, 5).toordinal() - i) for i in range(20)]
AS_OF = date(2024, 2, 7)


def daily(spark, counts=COUNTS):
    return spark.createDataFrame(list(zip(DAYS, counts)), "dt date, row_count long")


@pytest.mark.parametrize("second, cutoff, failing", [(2301, 286.0, {17}), (10, 250.375, {17, 10})])
def test_percentage_of_median(spark, second, cutoff, failing):
    rows = metrics.PercentageOfMedian(0.25).flag(daily(spark, [17, second, *COUNTS[2:]])).collect()
    assert {r["low_count_cutoff"] for r in rows} == {cutoff}
    assert {r["row_count"] for r in rows if not r["pass_check"]} == failing


def test_empty_counts_raise(spark):
    with pytest.raises(ValueError):
        metrics.require_rows(daily(spark).limit(0))


def scans(spark, receipts=("a", "b", "c", "d", "e", "f", "g", "h")):
    days = ["02-02", "02-03", "02-03", "02-04", "02-05", "02-05", "02-05", "02-06"]
    rows = [(r, f"w{i}", datetime.fromisoformat(f"2024-{day} 10:00:00")) for i, (r, day) in enumerate(zip(receipts, days))]
    return spark.createDataFrame(rows, "trans_rcpt_nbr string, wallet_id string, event_ts timestamp")


def verdict(rule, tables, **context):
    return rule.evaluate(tables, checks.Context(as_of=AS_OF, **context)).first()


def test_daily_count_without_the_day_fails(spark):
    rule = checks.DailyCount("scans", "event_ts", 15, 0.25)
    assert verdict(rule, {"scans": scans(spark)})["passed"] is True
    assert verdict(checks.DailyCount("scans", "event_ts", 15, 0.25, lag=0), {"scans": scans(spark)})["passed"] is False


def test_duplicates(spark):
    rule = checks.Duplicates("scans", "event_ts", 365, 0.001, ("trans_rcpt_nbr",))
    assert verdict(rule, {"scans": scans(spark)})["passed"] is True
    doubled = scans(spark, ("a", "b", "b", "d", "e", "f", "g", "h"))
    assert verdict(rule, {"scans": doubled})["passed"] is False
    assert verdict(rule, {"scans": doubled.limit(0)})["passed"] is True


def test_history_statistics(spark):
    rule = checks.History("scans", "event_ts", 0.01)
    stats = checks.history_statistics(rule.daily({"scans": scans(spark)}, F.lit(date(2024, 2, 4))))
    got = {r["history_type"]: r["value"] for r in stats.collect()}
    assert got["mean_daily_row_count"] == pytest.approx(1.3333333333333333)
    assert (got["max_daily_row_count"], got["min_daily_row_count"], got["total_row_count"]) == (2, 1, 4)
    assert got["stddev_daily_row_count"] == pytest.approx(0.5773502691896257)


@pytest.mark.parametrize("x, t, tol, inside", [(9, 10, 0.2, True), (9.5, 10, 0.05, False)])
def test_within_tolerance_is_strict(spark, x, t, tol, inside):
    assert spark.range(1).select(checks.within_tolerance(F.lit(x), F.lit(t), tol).alias("r")).first()["r"] is inside


def history(spark, mean="1.3333333", keys=checks.HISTORY_TYPES, check_id=3):
    values = dict(zip(checks.HISTORY_TYPES, [mean, "2", "1", "0.57735", "4"]))
    rows = [(check_id, k, "0", datetime(2024, 2, 1)) for k in keys]
    rows += [(check_id, k, values.get(k, "1"), datetime(2024, 2, 5, 11)) for k in keys]
    return spark.createDataFrame(rows, "check_id int, history_type string, historical_value string, dts timestamp")


def test_history_passes_when_near_and_fails_when_far(spark):
    rule = checks.History("scans", "event_ts", 0.01, check_id=3)
    tables = {"scans": scans(spark)}
    assert verdict(rule, tables, history=history(spark))["passed"] is True
    assert verdict(rule, tables, history=history(spark, mean="2"))["passed"] is False


def test_history_with_other_types_fails_with_a_message(spark):
    rule = checks.History("scans", "event_ts", 0.01, check_id=3)
    row = verdict(rule, {"scans": scans(spark)}, history=history(spark, keys=checks.HISTORY_TYPES[:4]))
    assert row["passed"] is False and row["message"] == "history types do not match"


def test_a_check_that_fails_at_run_time_leaves_the_others_standing(spark):
    bad = spark.range(3).select(F.expr("raise_error('broken file')").cast("date").alias("dt"))
    specs = [
        checks.CheckSpec(1, "good", (checks.HasRows("good"),)),
        checks.CheckSpec(2, "bad", (checks.Newest("bad", "dt"),)),
        checks.CheckSpec(3, "missing", (checks.HasRows("nowhere"),)),
    ]
    tables, context = {"good": spark.range(1), "bad": bad}, checks.Context(as_of=date(2024, 2, 7))
    found = {r["check_id"]: r for r in checks.collected_checks(spark, specs, tables, context)}
    assert {i: r["status"] for i, r in found.items()} == {1: True, 2: False, 3: False}
    assert "broken file" in found[2]["error_message"] and found[3]["error_message"]


def test_a_table_that_cannot_be_counted_reports_its_error(spark):
    bad = spark.range(3).select(F.expr("raise_error('broken file')").alias("x")).filter("x is not null")
    rows = jobs.counted_rows(spark, {"good": lambda: spark.range(4), "bad": lambda: bad}, datetime(2024, 2, 7)).collect()
    found = {r["table_name"]: r for r in rows}
    assert found["good"]["row_count"] == 4 and found["good"]["error"] is None
    assert found["bad"]["row_count"] is None and "broken file" in found["bad"]["error"]


def test_unknown_schedules_are_errors(spark):
    def due(schedule):
        row = spark.range(1).select(rollup.run_required(F.lit(schedule), F.lit(datetime(2024, 2, 7, 5)), F.lit(True), datetime(2024, 2, 7, 6)).alias("x"))
        return row.first()["x"]

    assert due("") is True and due("Daily") is False
    with pytest.raises(Exception, match="unexpected schedule type"):
        due("Hourly")


def test_no_history_passes_with_a_message(spark):
    rule = checks.History("scans", "event_ts", 0.01, check_id=4)
    for known in (None, history(spark)):
        row = verdict(rule, {"scans": scans(spark)}, history=known)
        assert row["passed"] is True and row["message"] == checks.NO_HISTORY


def test_snapshot_is_parsed_to_the_day_before(spark):
    rows = checks.latest_snapshot(history(spark), 3).collect()
    assert {r["snapshot_day"] for r in rows} == {date(2024, 2, 4)} and len(rows) == 5


@pytest.mark.parametrize("as_of, lags, passed", [(date(2024, 2, 7), (1,), True), (date(2024, 2, 7), (2,), False),
                                                 (date(2024, 2, 8), (1, 2), True), (date(2024, 4, 4), (1, 2), False)])
def test_newest(spark, as_of, lags, passed):
    rule = checks.Newest("scans", "event_ts", lags)
    assert rule.evaluate({"scans": scans(spark)}, checks.Context(as_of=as_of)).first()["passed"] is passed


def test_missing_table_or_column_is_a_failed_row(spark):
    rows = checks.run_checks(spark, [check(3), check(5), check(67)], {"visits": scans(spark)}, checks.Context(AS_OF)).collect()
    assert [r["status"] for r in rows] == [False] * 3 and all(r["error_message"] for r in rows)


def test_record_checks_replaces_the_pessimistic_rows(spark, tmp_path):
    from stampbook.sources import VersionedTable

    log, kept = VersionedTable(spark, str(tmp_path / "log")), VersionedTable(spark, str(tmp_path / "history"))
    specs = [check(3), check(5), check(67)]
    tables = {"scans": scans(spark), "visits": scans(spark).withColumnRenamed("event_ts", "visit_dt")}
    checks.record_checks(spark, specs, tables, checks.Context(AS_OF), log, "url", kept)
    rows = {r["check_id"]: r for r in log.read().collect()}
    assert {i: r["status"] for i, r in rows.items()} == {3: True, 5: False, 67: True}
    assert rows[3]["run_duration_seconds"] > 0 and "table not found" in rows[5]["error_message"]
    assert {r["error_message"] for r in log.read(1).collect()} == {checks.NOT_COMPLETED}
    assert {r["history_type"] for r in kept.read().collect()} == set(checks.HISTORY_TYPES)
    later = checks.Context(AS_OF, datetime(2024, 2, 7, 18), history=kept.read())
    checks.record_checks(spark, specs, tables, later, log, "url", kept)
    assert log.read().count() == 6 and kept.read().count() == 10


def test_shared_daily_counts_equal_single_ones(spark):
    table = {"scans": scans(spark)}
    rules = [checks.DailyCount("scans", "event_ts", w, t, lag, where) for w, t, lag, where in (
        (15, 0.25, 1, None), (4, 1.5, 1, None), (15, 0.5, 2, "trans_rcpt_nbr > 'c'"), (15, 0.9, 0, None), (2, 0.1, 1, "wallet_id = 'none'"))]
    context = checks.Context(AS_OF)
    specs = [checks.CheckSpec(i, "", (rule,)) for i, rule in enumerate(rules)]
    together = {r["check_id"]: r["status"] for r in checks.run_checks(spark, specs, table, context).collect()}
    assert together == {i: rule.evaluate(table, context).first()["passed"] for i, rule in enumerate(rules)}


def test_job_ran_today(spark):
    log = spark.createDataFrame(
        [("key_objectives", True, datetime(2024, 2, 7, 5)), ("app_usage", True, datetime(2024, 2, 6, 5)),
         ("crm_send_level", False, datetime(2024, 2, 7, 5))], "job_name string, succeeded boolean, start_ts timestamp")
    rows = checks.run_checks(spark, [check(27), check(43), check(26), check(25)], {}, checks.Context(AS_OF, run_log=log)).collect()
    assert {r["check_id"]: r["status"] for r in rows} == {27: True, 43: False, 26: False, 25: False}


def test_weekday_and_midday_lags():
    consent, bill = check(15).rules[0], check(34).rules[0]
    monday, tuesday, friday = date(2024, 2, 5), date(2024, 2, 6), date(2024, 2, 9)
    assert [consent.checked_day(checks.Context(x)) for x in (monday, tuesday, friday)] == [
        date(2024, 2, 2), date(2024, 2, 2), date(2024, 2, 7)]
    assert bill.checked_day(checks.Context(friday, datetime(2024, 2, 9, 9))) == date(2024, 2, 6)
    assert bill.checked_day(checks.Context(friday, datetime(2024, 2, 9, 14))) == date(2024, 2, 7)


def test_registry_is_complete():
    assert [c.check_id for c in CHECKS] == list(range(1, 70))


NOW = datetime(2024, 2, 7, 9)


@pytest.mark.parametrize(
    "schedule, last, ok, now, due",
    [
        ("Daily", datetime(2024, 2, 7, 1), False, NOW, True),
        ("Daily", None, None, NOW, True),
        ("Daily", datetime(2024, 2, 7, 1), True, NOW, False),
        ("Daily", datetime(2024, 2, 6, 23), True, NOW, True),
        (None, datetime(2024, 2, 7, 1), True, NOW, True),
        ("Twice Daily", datetime(2024, 2, 7, 8), True, NOW, False),
        ("Twice Daily", datetime(2024, 2, 7, 8), True, datetime(2024, 2, 7, 13), True),
        ("Twice Daily", datetime(2024, 2, 7, 13), True, datetime(2024, 2, 7, 20), False),
        ("Twice Daily", datetime(2024, 2, 6, 8), True, NOW, True),
        ("Twice Daily", datetime(2024, 2, 7, 8), False, NOW, True),
    ],
)
def test_run_required(spark, schedule, last, ok, now, due):
    df = spark.createDataFrame([(schedule, last, ok)], "s string, t timestamp, ok boolean")
    assert df.select(rollup.run_required(F.col("s"), F.col("t"), F.col("ok"), now).alias("r")).first()["r"] is due


@pytest.mark.parametrize(
    "status, schedule, start, flag",
    [
        ("Run Completed", "Daily", datetime(2024, 2, 7, 1), True),
        ("Run Completed", "Daily", datetime(2024, 2, 6, 1), False),
        ("Refresh Successful", "Weekly", datetime(2024, 2, 1, 1), True),
        ("Refresh Successful", "Weekly", datetime(2024, 1, 31, 1), False),
        ("Run Failed", "Daily", datetime(2024, 2, 7, 1), False),
        ("Run Completed", "Twice Daily", datetime(2024, 2, 7, 12), True),
        ("Run Completed", "Twice Daily", datetime(2024, 2, 7, 13), False),
        ("Run Completed", "Daily", None, False),
    ],
)
def test_run_status_flag(spark, status, schedule, start, flag):
    df = spark.createDataFrame([(status, schedule, start)], "s string, c string, t timestamp")
    flagged = df.select(rollup.run_succeeded_in_schedule(F.col("s"), F.col("c"), F.col("t"), NOW).alias("r"))
    assert flagged.first()["r"] is flag


def test_a_finished_run_of_an_unknown_schedule_is_an_error(spark):
    def flag(status, schedule):
        df = spark.createDataFrame([(status, schedule, NOW)], "s string, c string, t timestamp")
        return df.select(rollup.run_succeeded_in_schedule(F.col("s"), F.col("c"), F.col("t"), NOW).alias("r")).first()["r"]

    assert flag("Run Completed", "") is False and flag("Run Failed", "Hourly") is False
    for schedule in ("Hourly", None):
        with pytest.raises(Exception, match="unexpected schedule type"):
            flag("Run Completed", schedule)


def test_run_log_states(spark):
    info = spark.createDataFrame(
        [(1, '{"run_id": "7", "state": {"life_cycle_state": "RUNNING"}, "start_time": 1707264000000, "end_time": 0}', NOW),
         (2, '{"run_id": null, "state": null}', NOW), (3, '{"refresh_status": "Unknown"}', NOW)],
        "dependency_id int, info string, dts timestamp")
    definitions = spark.createDataFrame(
        [(1, "Workflow", "a", "{}"), (2, "Workflow", "b", "{}"), (3, "Report", "c", '{"schedule type": "Daily"}')],
        "dependency_id int, type string, name string, parameter string")
    rows = {r["dependency_id"]: r for r in rollup.run_log(info, definitions, NOW).collect()}
    assert [rows[i]["status"] for i in (1, 2, 3)] == ["Running", "Never Run", "Refreshing"]
    assert rows[1]["duration_in_seconds"] is None and rows[1]["end_time"] is None
    assert rows[3]["schedule"] == "Daily" and not any(r["run_status_flag"] for r in rows.values())


def test_rolling_cutoffs_window_of_four(spark):
    import numpy as np

    rows = {r["dt"]: r for r in metrics.rolling_cutoffs(daily(spark), 4).collect()}
    assert len(rows) == 17
    window = np.array(COUNTS[:4], dtype=float)
    row = rows[DAYS[3]]
    assert row["pct_of_median"] == pytest.approx(np.median(window) * 0.4)
    assert row["pct_of_lower_quartile"] == pytest.approx(np.quantile(window, 0.25) * 0.4)
    assert row["deviations_from_mean"] == pytest.approx(window.mean() - 3 * window.std(ddof=1))
    mad = np.median(np.abs(window - np.median(window)))
    assert row["median_absolute_deviation"] == pytest.approx(np.median(window) - 3 * mad)


def test_check_results_make_their_history_once(spark, monkeypatch):
    taken = []
    monkeypatch.setattr(queries_quality.checks, "run_checks", lambda spark, specs, tables, context: taken.append(context) or spark.createDataFrame([(1, True)], "check_id int, status boolean"))
    queries_quality.dq_check_results(Bound(spark, "/root/testdata/sf0.001"))
    history = taken[0].history
    assert history.inputFiles() == []  # no table is read again wherever a rule looks into the history
    assert history.count() == 3 * history.select("check_id", "history_type").where("historical_value = '-1'").count() > 0
