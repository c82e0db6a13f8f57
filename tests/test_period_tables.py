"""Stored tables in period folders: touched folders change, all others keep their files; jobs and streams on them."""

import os
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from stampbook.dq import checks
from stampbook.dq.registry import check
from stampbook.plans import incremental
from stampbook.sources import PeriodTable, shared_folder
from stampbook.streaming import day_counts, recounted_days, stream_into

SCHEMA = "k int, day date, v int"
D = [date(2024, 1, 30) + timedelta(days=n) for n in range(6)]


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def files(path):
    """Each data file with its time of writing."""
    found = {}
    for folder, _, names in os.walk(path):
        for n in names:
            if n.endswith(".parquet"):
                full = os.path.join(folder, n)
                found[os.path.relpath(full, path)] = os.stat(full).st_mtime_ns
    return found


def folder_of(name):
    return name.split("/")[0]


@pytest.fixture
def table(spark, tmp_path):
    t = PeriodTable(spark, str(tmp_path / "t"), "day")
    t.write(frame(spark, [(i, d, i) for i, d in enumerate(D)] + [(9, D[0], 9), (8, None, 8)]))
    return t


def test_merge_rewrites_only_the_days_it_touches(spark, table):
    before = files(table.path)
    touched = table.merge(frame(spark, [(1, D[1], 10), (7, D[3], 70)]), ["k", "day"])
    assert touched == [f"p{D[1]}", f"p{D[3]}"]
    after = files(table.path)
    kept = {n: t for n, t in before.items() if folder_of(n)[len("in_period=") :] not in touched}
    assert len(kept) == len(before) - 2 and kept.items() <= after.items()
    assert rows(table.read()) == sorted([(0, D[0], 0), (9, D[0], 9), (1, D[1], 10), (2, D[2], 2), (3, D[3], 3), (7, D[3], 70), (4, D[4], 4), (5, D[5], 5), (8, None, 8)], key=str)
    # the same change again, as after a loss, leaves the same rows
    table.merge(frame(spark, [(1, D[1], 10), (7, D[3], 70)]), ["k", "day"])
    assert table.read().count() == 9


def test_a_row_that_moves_leaves_its_old_day_and_an_empty_day_goes(spark, table):
    touched = table.merge(frame(spark, [(4, D[0], 44), (8, D[0], 88)]), ["k"])
    assert touched == [f"p{D[0]}", f"p{D[4]}", "pnone"]
    assert not os.path.exists(f"{table.path}/in_period=p{D[4]}") and not os.path.exists(f"{table.path}/in_period=pnone")
    assert [r for r in rows(table.read()) if r[0] in (4, 8)] == [(4, D[0], 44), (8, D[0], 88)]


def test_the_merge_reads_the_touched_folders_only(spark, table):
    plan = table.of([f"p{D[1]}"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and f"p{D[1]}" in plan


def test_delete_by_condition_and_by_rows(spark, table):
    before = files(table.path)
    assert table.delete(F.col("v") > 8) == [f"p{D[0]}"]
    assert table.delete(frame(spark, [(2, D[2], 0), (99, D[2], 0)]).select("k")) == [f"p{D[2]}"]
    assert {r[0] for r in rows(table.read())} == {0, 1, 3, 4, 5, 8}
    after = files(table.path)
    assert {n for n in before if before[n] != after.get(n)} == {n for n in before if folder_of(n) in (f"in_period=p{D[0]}", f"in_period=p{D[2]}")}
    assert table.delete(F.lit(False)) == []


def test_a_table_that_lost_all_rows_keeps_its_columns(spark, table):
    table.delete(F.lit(True))
    assert not table.exists() and table.read().columns == ["k", "day", "v"] and rows(table.read()) == []
    assert table.merge(frame(spark, [(1, D[0], 1)]), ["k"]) == [f"p{D[0]}"]
    assert rows(table.read()) == [(1, D[0], 1)]


def test_rows_outside_the_replaced_periods_are_refused(spark, table):
    with pytest.raises(ValueError, match="outside"):
        table.replace([f"p{D[0]}"], frame(spark, [(1, D[1], 1)]))
    table.replace([f"p{D[0]}"], frame(spark, [(1, D[0], 5)]))
    assert (1, D[0], 5) in rows(table.read()) and (0, D[0], 0) not in rows(table.read())


@pytest.mark.parametrize(("grain", "periods"), [("month", ["p2024-01", "p2024-02", "pnone"]), ("year", ["p2024", "pnone"])])
def test_other_grains(spark, tmp_path, grain, periods):
    t = PeriodTable(spark, str(tmp_path / "g"), "day", grain)
    assert t.merge(frame(spark, [(i, d, i) for i, d in enumerate(D)] + [(8, None, 8)]), ["k"]) == periods
    assert t.read().count() == 7 and dict(t.read().dtypes)["day"] == "date"


def test_folders_by_value_keep_their_type(spark, tmp_path):
    t = PeriodTable(spark, str(tmp_path / "w"), "k", "value")
    t.write(frame(spark, [(202401, D[0], 1), (202402, D[0], 2)]))
    assert t.merge(frame(spark, [(202402, D[1], 3)]), ["k"]) == ["p202402"]
    assert rows(t.read()) == [(202401, D[0], 1), (202402, D[1], 3)]


def test_shared_folder_needs_the_setting_on_a_cluster(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")

    class Conf:
        get = staticmethod(lambda *_: None)

    class Context:
        isLocal = False

    class Cluster:
        conf, sparkContext = Conf, Context

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Cluster)
    Context.isLocal = True
    assert os.path.isdir(shared_folder(Cluster))


# --- jobs ---


def test_order_participation_reads_from_its_cutoff(spark, tmp_path):
    as_of = date(2024, 3, 1)
    orders = spark.createDataFrame(
        [(str(i), f"P{i % 5}", as_of - timedelta(days=i), datetime(2024, 1, 1) + timedelta(days=59 - i), "7", 10.0) for i in range(1, 40)],
        "web_order_id string, singl_profl_id string, dlvr_dt date, order_sbmtd_ts timestamp, outbase_store_id string, pos_tot_amt double",
    )
    orders.write.parquet(str(tmp_path / "orders"))
    stored = spark.read.parquet(str(tmp_path / "orders"))
    scans = spark.createDataFrame([("3", 3)], "trans_rcpt_nbr string, wallet_id int")
    calendar = spark.range(0, 200).select(F.date_add(F.lit(date(2023, 12, 1)), F.col("id").cast("int")).alias("day_date"), F.lit(202401).alias("retail_week"))
    table = PeriodTable(spark, str(tmp_path / "participation"), "delivery_dt")
    run = (scans, calendar, [], ("all", date(2000, 1, 1), date(2000, 1, 1)), date(2000, 1, 1), date(2024, 1, 1), as_of)
    first = incremental.order_participation(table, stored.filter("web_order_id <> '2'"), *run)
    assert len(first) == 38
    before = files(table.path)
    changed = stored.withColumn("pos_tot_amt", F.lit(99.0))
    second = incremental.order_participation(table, changed, *run)
    assert second == [f"p{as_of - timedelta(days=i)}" for i in range(7, 0, -1)]
    after = files(table.path)
    assert sum(1 for n in before if before[n] == after.get(n)) == 38 - 6
    found = {r.delivery_dt: r.total_sales for r in table.read().collect()}
    assert len(found) == 39 and {d for d, v in found.items() if v == 99.0} == {as_of - timedelta(days=i) for i in range(1, 8)}


def test_sends_are_merged_then_pruned(spark, tmp_path):
    """A journey that lacks a group on one day goes with all its days; so do small groups."""
    as_of = date(2024, 3, 1)

    def sends(day, name, groups):
        return [(datetime.combine(day, datetime.min.time()), name, g, f"{name}{g}{i}") for g, n in groups.items() for i in range(n)]

    old, new = as_of - timedelta(days=40), as_of - timedelta(days=18)
    data = sends(old, "a", {"Send": 3, "Control": 3}) + sends(old, "b", {"Send": 3, "Control": 3}) + sends(old, "c", {"Send": 3, "Control": 1})
    later = sends(new, "a", {"Send": 3, "Control": 2}) + sends(new, "b", {"Send": 3}) + sends(new, "d", {"Send": 2, "Control": 2})
    schema = "eventdate timestamp, campaignname string, sendtype string, id string"
    orders = spark.createDataFrame([("aSend0", "o1", datetime(2024, 2, 13), 1, 5)], "id string, o string, ts timestamp, items int, sales int")

    def channels(sent):
        from stampbook.plans import crm

        return {"x": crm.channel_orders(orders, "o", "id", "ts", "items", "sales", sent)}

    table = PeriodTable(spark, str(tmp_path / "sends"), "journey_date")
    run = ("id", channels, date(2024, 1, 1))
    incremental.crm_send_level(table, spark.createDataFrame(data, schema), *run, as_of - timedelta(days=10), min_customers=2)
    assert {(r.journey_name, r.journey_date) for r in table.read().collect()} == {("a", old), ("b", old)}
    incremental.crm_send_level(table, spark.createDataFrame(data + later, schema), *run, as_of, min_customers=2)
    found = table.read().collect()
    assert {(r.journey_name, r.journey_date) for r in found} == {("a", old), ("a", new), ("d", new)}
    assert [r.x_sales for r in found if (r.journey_name, r.groups, r.journey_date, r.type) == ("a", "Emailed", new, "Post")] == [5.0]


def test_weeks_are_read_from_two_back(spark, tmp_path):
    as_of = date(2024, 3, 1)
    calendar = spark.range(0, 140).select(F.date_add(F.lit(date(2024, 1, 1)), F.col("id").cast("int")).alias("day_date"), (F.lit(202401) + F.floor(F.col("id") / 7)).cast("int").alias("retail_week"))
    control = spark.createDataFrame([("g", "s", "P1")], "control_group string, segment string, spid string")

    def orders(price):
        return spark.createDataFrame([(str(i), "P1", price, date(2024, 1, 3) + timedelta(days=7 * i)) for i in range(10)], "order_id string, spid string, sales int, order_day date")

    table = PeriodTable(spark, str(tmp_path / "weeks"), "week_id", "value")
    run = (calendar, "online", 202400, (202401, 202402))
    incremental.crm_monthly(table, control, orders(1), *run, as_of)
    touched = incremental.crm_monthly(table, control, orders(5), *run, as_of)
    assert touched == ["p202408", "p202409", "p202410"]  # as_of lies in week 9
    assert {r.week_id: r.sales for r in table.read().collect()} == {202400 + w: 5.0 if w > 7 else 1.0 for w in range(1, 11)}


# --- streams ---


def test_late_rows_count_and_repeated_ones_do_not(spark, tmp_path):
    source = str(tmp_path / "in")
    schema = "id long, event_ts timestamp, chnl_nm string, sale_amt_inc_vat long"
    archive, counts = (PeriodTable(spark, str(tmp_path / n), "full_date") for n in ("archive", "counts"))

    def drop(data):
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        recounted_days(stream, archive, counts, ["id", "full_date"], str(tmp_path / "checkpoint")).awaitTermination(120)

    drop([(i, datetime(2024, 5, 1 + i % 3, 9), "store", i) for i in range(9)])
    before = files(counts.path)
    # a year late, one row again, one corrected
    drop([(50, datetime(2023, 5, 1, 9), "store", 7), (3, datetime(2024, 5, 1, 9), "store", 3), (6, datetime(2024, 5, 1, 9), "store", 60)])
    after = files(counts.path)
    assert sum(1 for n in before if before[n] == after.get(n)) == 2  # days that no row came for
    assert {r.full_date: (r.num_transactions, r.sales) for r in counts.read().collect()} == {
        date(2023, 5, 1): (1, 7), date(2024, 5, 1): (3, 63), date(2024, 5, 2): (3, 12), date(2024, 5, 3): (3, 15)}
    assert rows(counts.read()) == rows(day_counts(archive.read()).select(*counts.read().columns))


def test_stream_counts_are_merged_into_period_tables(spark, tmp_path):
    from stampbook.streaming import daily_activity

    schema = "event_ts timestamp, chnl_nm string, sale_amt_inc_vat long"
    source, out = str(tmp_path / "in"), PeriodTable(spark, str(tmp_path / "out"), "full_date")
    for n in (1, 2):
        spark.createDataFrame([(datetime(2024, 1, n, 5), "store", 10), (datetime(2024, 1, 1, 6), "store", 1)], schema).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        stream_into(daily_activity(stream), out, ("full_date", "chnl_nm"), str(tmp_path / "checkpoint")).awaitTermination(120)
    assert {r.full_date: r.num_transactions for r in out.read().collect()} == {date(2024, 1, 1): 3, date(2024, 1, 2): 1}


# --- check and history logs ---


def test_logs_of_checks_are_period_tables(spark, tmp_path):
    as_of = date(2024, 2, 7)
    credits = spark.createDataFrame([(i, datetime(2024, 1, 1) + timedelta(hours=5 * i)) for i in range(200)], "wallet_id int, event_ts timestamp")
    log, history = PeriodTable(spark, str(tmp_path / "log"), "dts"), PeriodTable(spark, str(tmp_path / "history"), "dts")
    recent = credits.filter(F.col("event_ts") < F.lit(as_of))
    checks.record_checks(spark, [check(5), check(14)], {"credits": recent, "account_archive": recent}, checks.Context(as_of), log, "url", history)
    assert {(r.check_id, r.status) for r in log.read().collect()} == {(5, True), (14, False)}
    assert history.read().count() == 5
    later = checks.Context(as_of, datetime(2024, 2, 8, 6), history=history.read())
    checks.record_checks(spark, [check(5)], {"credits": recent.filter("wallet_id % 9 > 0")}, later, log, "url", history)
    assert sorted((str(r.dts), r.check_id, r.status) for r in log.read().collect())[-1][1:] == (5, False)
    assert checks.clear_history(history, 5) == ["p2024-02-07"] and not history.exists()


def test_snapshots_are_looked_up_as_of_a_day(spark):
    history = spark.createDataFrame(
        [(5, "total_row_count", v, datetime(2024, 2, d, 6)) for d, v in ((3, "1"), (7, "2"), (9, "3"))], "check_id int, history_type string, historical_value string, dts timestamp"
    )
    found = {d: checks.read_snapshots(history, date(2024, 2, d)) for d in (2, 3, 8, 9)}
    assert found[2] == {} and found[3][5].values == {"total_row_count": 1.0}
    assert found[8][5] == checks.Snapshot(date(2024, 2, 6), {"total_row_count": 2.0})
    assert found[9][5].values == {"total_row_count": 3.0} and checks.read_snapshots(None) == {}


def test_shared_folds_agree_with_each_rule_alone(spark):
    """Counts, copies and history of several checks on one table, against each rule's own evaluation."""
    as_of = date(2024, 2, 7)
    data = [(i % 41, 508017 if i % 3 else 1, datetime(2023, 11, 1) + timedelta(hours=4 * (i % 580)), datetime(2023, 11, 2) + timedelta(hours=4 * (i % 570))) for i in range(1500)]
    missions = spark.createDataFrame(data + data[:40], "wallet_id int, cmpgn_id int, event_ts timestamp, upd_ts timestamp")
    tables = {"missions": missions}
    specs = [check(i) for i in (1, 2, 24)]
    early = checks.Context(as_of - timedelta(days=10))
    taken = checks.snapshots([s.rules[2] for s in specs[:2]], tables, early)
    alone = specs[0].rules[2].snapshot(tables, early).unionByName(specs[1].rules[2].snapshot(tables, early))
    digits = [(r.check_id, r.history_type, round(float(r.historical_value), 9), r.dts) for r in taken.collect()]
    assert sorted(digits) == sorted((r.check_id, r.history_type, round(float(r.historical_value), 9), r.dts) for r in alone.collect())
    for changed in (taken, taken.filter("history_type <> 'total_row_count'"), taken.withColumn("historical_value", (F.col("historical_value").cast("double") * 1.5).cast("string")), None):
        context = checks.Context(as_of, history=changed)
        together = {r.check_id: r.status for r in checks.run_checks(spark, specs, tables, context).collect()}
        single = {s.check_id: all(rule.evaluate(tables, context).first()["passed"] for rule in s.rules) for s in specs}
        assert together == single
        if changed is not None:
            values = checks.history_values(specs, tables, context).collect()
            assert {r.check_id for r in values} == {1, 2} and all((r.reference is None) == (changed.filter(F.col("history_type") == r.history_type).isEmpty()) for r in values)
