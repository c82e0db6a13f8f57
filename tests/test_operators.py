"""Generic operators against brute force, with boundary and skewed rows."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from stampbook.functions import band_label, band_order, bands_from_edges, ratio, retail_calendar, strip_check_digit
from stampbook.operators import (
    exact_median,
    first_per_key,
    latest_per_key,
    metric_grid,
    next_event_day,
    reach_in_windows,
    rolling_distinct,
    running_totals,
    salted_join,
    window_sums,
    with_total_row,
)

D0 = date(2024, 1, 1)


def d(n):
    return D0 + timedelta(days=n)


@pytest.fixture(scope="module")
def events():
    """Random (wallet, day); wallet 0 holds a third of all rows, wallet None is unknown."""
    rng = random.Random(7)
    rows = [(rng.randrange(1, 40), d(rng.randrange(120)), rng.randrange(1, 9)) for _ in range(600)]
    rows += [(0, d(rng.randrange(120)), 1) for _ in range(300)]
    return rows


@pytest.fixture(scope="module")
def events_df(spark, events):
    return spark.createDataFrame(events, "wallet_id long, day date, amount long")


def test_rolling_distinct(spark, events, events_df):
    spine = spark.createDataFrame([(d(n),) for n in range(-3, 130)], "full_date date")
    windows = {"w1": (1, 1), "w7": (6, 0), "w30": (30, 1), "w91": (91, 1)}
    got = {r["full_date"]: r for r in rolling_distinct(events_df, "wallet_id", "day", windows, spine, "full_date").collect()}
    assert len(got) == 133
    for n in range(-3, 130):
        for name, (first, last) in windows.items():
            expected = {w for w, day, _ in events if d(n - first) <= day <= d(n - last)}
            assert got[d(n)][name] == len(expected), (n, name)


def test_rolling_distinct_single_event_edges(spark):
    one = spark.createDataFrame([(1, d(0))], "k long, day date")
    spine = spark.createDataFrame([(d(n),) for n in range(95)], "full_date date")
    rows = rolling_distinct(one, "k", "day", {"w7": (7, 1), "w91": (91, 1)}, spine, "full_date").collect()
    assert sorted(r["full_date"] for r in rows if r["w7"]) == [d(n) for n in range(1, 8)]
    assert sum(r["w91"] for r in rows) == 91


def test_running_totals_without_spine(spark):
    steps = spark.createDataFrame([(d(0), 2), (d(3), -1), (d(3), 4)], "day date, n int")
    rows = {r["day"]: r["n"] for r in running_totals(steps, "day", ["n"]).collect()}
    assert rows == {d(0): 2, d(3): 5}


def test_window_sums(spark, events, events_df):
    rng = random.Random(3)
    points = [(rng.randrange(0, 45), d(rng.randrange(-5, 125))) for _ in range(200)] + [(0, d(n)) for n in range(50)]
    points_df = spark.createDataFrame(points, "wallet_id long, day date")
    frames = {"pre": (-42, -1), "post": (0, 14)}
    got = window_sums(points_df, events_df, "wallet_id", "day", frames, ["amount"]).collect()
    assert {(r["wallet_id"], r["day"]) for r in got} == set(points) and len(got) == len(set(points))
    for r in got:
        for name, (low, high) in frames.items():
            expected = [
                a
                for w, day, a in events
                if w == r["wallet_id"] and r["day"] + timedelta(days=low) <= day <= r["day"] + timedelta(days=high)
            ]
            assert r[f"{name}_amount"] == (sum(expected) if expected else None)


def test_next_event_day(spark, events, events_df):
    points = [(w, d(n)) for w in (0, 1, 2, 99) for n in range(0, 125, 7)]
    got = next_event_day(spark.createDataFrame(points, "wallet_id long, day date"), events_df, "wallet_id", "day").collect()
    assert len(got) == len(points)
    for r in got:
        later = [day for w, day, _ in events if w == r["wallet_id"] and day >= r["day"]]
        assert r["next_day"] == (min(later) if later else None)


def test_reach_in_windows(spark, events, events_df):
    spans = [(i, d(3 * (i % 40) - 10), d(3 * (i % 40) - 10 + (i * 7) % 40)) for i in range(90)]
    spans += [(200, d(5), d(4)), (201, d(900), d(950)), (202, d(-50), d(500))]
    spans_df = spark.createDataFrame(spans, "id long, s date, e date")
    got = reach_in_windows(events_df, "wallet_id", "day", spans_df, "id", "s", "e").collect()
    expected = {i: len({w for w, day, _ in events if s <= day <= e}) for i, s, e in spans}
    assert {r["id"]: r["reach"] for r in got} == {i: n for i, n in expected.items() if n}


@pytest.mark.parametrize("values", [[5], [1, 2], [7, 7, 7, 1000000], list(range(0, 100000, 37)), [0, 3599, 3600, 7200]])
def test_exact_median(spark, values):
    import statistics

    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v long")
    assert exact_median(df, "v").first()["median"] == statistics.median(values)


def test_latest_keeps_ties_on_request(spark):
    df = spark.createDataFrame([(1, 10, "a"), (1, 10, "b"), (1, 9, "c"), (2, 1, "d")], "k int, v int, x string")
    assert latest_per_key(df, ["k"], "v").count() == 2
    assert {r["x"] for r in latest_per_key(df, ["k"], "v", ties=True).collect()} == {"a", "b", "d"}
    assert {r["x"] for r in first_per_key(df, ["k"], [F.col("v")]).collect()} == {"c", "d"}


def test_group_limit_is_planned_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 as k", "id as v")
    plan = latest_per_key(df, ["k"], "v")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_total_row_counts_afresh(spark):
    df = spark.createDataFrame([(1, "a", 7), (1, "b", 7), (1, None, 8)], "k int, ch string, w int")
    rows = {(r["k"], r["ch"]): r["n"] for r in with_total_row(df, ["k"], "ch", [F.countDistinct("w").alias("n")]).collect()}
    assert rows == {(1, "a"): 1, (1, "b"): 1, (1, None): 1, (1, "All"): 2}


def test_metric_grid(spark):
    df = spark.createDataFrame([(1,), (5,), (None,)], "x int")
    grid = metric_grid(df, [("small", {"a": F.col("x") < 3, "b": None}), ("any", {"a": F.lit(True), "b": F.col("x") > 1})])
    assert [tuple(r) for r in grid.orderBy("index").collect()] == [("small", 1, 1, 0), ("any", 2, 3, 1)]


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_salted_join_equals_plain_join(spark, how):
    fact = spark.range(500).selectExpr("case when id % 3 = 0 then 1 else id % 50 end as k", "id")
    side = spark.range(40).selectExpr("id as k", "id * 2 as v")
    plain = sorted(map(tuple, fact.join(side, ["k"], how).select("k", "id").collect()))
    assert sorted(map(tuple, salted_join(fact, side, ["k"], ["id"], how).select("k", "id").collect())) == plain


def test_salted_join_rejects_outer(spark):
    with pytest.raises(ValueError):
        salted_join(spark.range(1), spark.range(1), ["id"], ["id"], "full")


def test_bands_are_half_open(spark):
    bands = bands_from_edges([0, 100, 2000], ["low", "mid", "top"])
    df = spark.createDataFrame([(-1.0,), (0.0,), (99.9,), (100.0,), (1999.5,), (2000.0,), (None,)], "v double")
    rows = df.select(band_label(F.col("v"), bands).alias("l"), band_order(F.col("v"), bands).alias("o")).collect()
    assert [r["l"] for r in rows] == [None, "low", "low", "mid", "mid", "top", None]
    assert [r["o"] for r in rows] == [None, 1, 1, 2, 2, 3, None]


def test_ratio_of_zero_is_null(spark):
    assert spark.range(1).select(ratio(F.lit(1), F.lit(0)).alias("r")).first()["r"] is None


def test_strip_check_digit(spark):
    df = spark.createDataFrame([("12345678",), ("1234567890123",), ("123",), (None,)], "c string")
    assert [r[0] for r in df.select(strip_check_digit("c")).collect()] == ["1234567", "123456789012", "123", None]


def test_retail_calendar(spark):
    rows = retail_calendar(spark, date(2023, 12, 1), date(2024, 12, 31)).collect()
    by_day = {r["day_date"]: r for r in rows}
    # Saturday 30 December 2023 to Friday 5 January 2024 is the first week of 2024
    assert {by_day[date(2023, 12, 30) + timedelta(days=n)]["retail_week"] for n in range(7)} == {202401}
    assert by_day[date(2023, 12, 29)]["retail_week"] == 202352
    assert by_day[date(2024, 12, 31)]["retail_year"] == 2025


def test_midnight_bounds_reach_the_scan(spark, tmp_path):
    from stampbook.functions import on_days

    path = str(tmp_path / "t")
    spark.createDataFrame([(datetime(2024, 1, 2, 3),)], "ts timestamp").write.parquet(path)
    plan = spark.read.parquet(path).filter(on_days("ts", D0, d(5)))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan


@pytest.mark.parametrize("seed", range(4))
def test_reach_and_meeting_in_intervals_are_exact_to_the_timestamp(spark, seed):
    """Windows within a day, across days, of several overlapping or disjoint intervals, beyond the events; hot key."""
    from stampbook.operators import merged_intervals, met_in_intervals, reach_in_intervals

    rng = random.Random(seed)
    start = datetime(2024, 1, 1)

    def moment(days):
        return start + timedelta(hours=rng.randint(0, 24 * days), minutes=rng.choice((0, 0, 30)))

    events = [(rng.choice((0, 0, rng.randint(1, 25))), moment(20)) for _ in range(150)]
    windows = []
    for w in range(60):
        for _ in range(rng.choice((1, 1, 1, 2, 3))):
            s = moment(22)
            windows.append((w, s, s + timedelta(hours=rng.choice((0, 3, 10, 30, 60, 200)), minutes=rng.choice((0, 29)))))
    windows += [(99, moment(5), start - timedelta(days=1)), (98, start, start + timedelta(days=400))]
    before = date(2024, 1, 19)
    events = [e for e in events if e[1].date() < before]
    e = spark.createDataFrame(events, "k int, ts timestamp")
    w = spark.createDataFrame(windows, "w int, s timestamp, e timestamp")
    got = {r.w: r.reach for r in reach_in_intervals(e, "k", "ts", w, "w", "s", "e", before=before).collect()}
    want = {}
    for k, t in events:
        for i, s, end in windows:
            if s <= t <= end:
                want.setdefault(i, set()).add(k)
    assert got == {i: len(keys) for i, keys in want.items()}
    targets = [(k, i, s, end) for k in range(0, 27) for i, s, end in windows]
    t = spark.createDataFrame(targets, "k int, w int, s timestamp, e timestamp")
    met = sorted(tuple(r) for r in met_in_intervals(t, e, "k", "ts", "s", "e", before=before).collect())
    assert met == sorted(x for x in targets if any(k == x[0] and x[2] <= at <= x[3] for k, at in events))
    for r in merged_intervals(w, "w", "s", "e").collect():
        assert r.intervals >= 1 and r.s <= r.e
