"""Folded distinct counts, hot keys, row changes, kept state and catalog counts, against brute force and in their plans."""

import random
from collections import Counter, defaultdict
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from rolebook.registry import Bound
from rolebook.roles import AS_OF, SCHEME
from stampbook.operators import distinct_by_fold, hot_split_join, with_total_by_fold, with_total_row
from stampbook.plans import activity, incremental, jobs
from stampbook.sources import PeriodTable, applied, row_changes

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def facts(spark, seed):
    rng = random.Random(seed)
    rows = [(rng.choice(["a", "a", "b", None]), rng.choice([0, rng.randint(0, 9), None]), rng.choice([rng.randint(0, 30), None]), rng.choice(["x", "y", None]), rng.choice([rng.randint(0, 5), None])) for _ in range(rng.choice((0, 1, 400)))]
    return rows, spark.createDataFrame(rows, "g string, i int, j int, s string, v int").repartition(3)


@pytest.mark.parametrize("seed", range(4))
def test_distinct_by_fold_is_count_distinct(spark, seed):
    _, df = facts(spark, seed)
    ids = {"i": (F.col("i"), {"n_i": None, "big_i": F.col("v") > 2}), "j": (F.struct("j", "s"), {"n_j": None}), "k": (F.col("j"), {"low_j": F.col("i") < 5})}
    got = distinct_by_fold(df, ["g"], ids, {"total": F.col("v"), "many": F.when(F.col("i") > 3, F.col("v"))})
    want = df.groupBy("g").agg(
        F.countDistinct("i").alias("n_i"), F.countDistinct(F.when(F.col("v") > 2, F.col("i"))).alias("big_i"), F.countDistinct(F.struct("j", "s")).alias("n_j"),
        F.countDistinct(F.when(F.col("i") < 5, F.col("j"))).alias("low_j"), F.sum("v").alias("total"), F.sum(F.when(F.col("i") > 3, F.col("v"))).alias("many"),
    )
    assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))
    assert "Expand" not in plan(got) and "Expand" in plan(want)


@pytest.mark.parametrize("seed", range(4))
def test_with_total_by_fold_is_the_grouping_sets(spark, seed):
    _, df = facts(spark, seed)
    got = with_total_by_fold(df, ["g"], "s", "i", {"n": None, "big": F.col("v") > 2}, {"total": F.col("v")})
    want = with_total_row(df, ["g"], "s", [F.countDistinct("i").alias("n"), F.countDistinct(F.when(F.col("v") > 2, F.col("i"))).alias("big"), F.sum("v").alias("total")])
    assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))
    assert "Expand" not in plan(got)


@pytest.mark.parametrize("name", ["coupon_summary", "fuel_visit_days", "order_participation", "star_products_daily", "sp_redeemers", "epos_items_daily"])
def test_reports_repeat_no_row_for_distinct_counts(spark, name):
    assert "Expand" not in plan(queries()[name](spark, FOLDER))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_hot_split_join_is_the_join(spark, how):
    rng = random.Random(7)
    fact = [(rng.choice([1, 1, 1, rng.randint(2, 40), None]), n) for n in range(900)]
    side = [(k, f"side {k} {c}") for k in [*range(1, 30), None] for c in range(1 + (k == 1))]
    f, s = spark.createDataFrame(fact, "k int, n int"), spark.createDataFrame(side, "k int, t string")
    got = hot_split_join(f, s, ["k"], ["n"], how, parts=6)
    want = f.join(s, ["k"], how)
    assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))
    empty = hot_split_join(f.limit(0), s, ["k"], ["n"], how, parts=6)
    assert empty.collect() == []


def test_only_hot_keys_repeat_the_side(spark):
    """600 of 1,000 rows have key 0: it goes to six parts, and no other side row is repeated."""
    fact = spark.range(1000).select(F.when(F.col("id") < 600, 0).otherwise(F.col("id")).alias("k"), "id")
    side = spark.range(0, 1000).select(F.col("id").alias("k"), F.lit("t").alias("t"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = hot_split_join(fact, side, ["k"], ["id"], parts=10)
        assert joined.count() == 1000
        optimised = joined._jdf.queryExecution().optimizedPlan().toString()
        assert "explode" in optimised and "sequence" in optimised
        counts = fact.groupBy("k").agg(F.count("*").alias("n"))
        hot = counts.filter(F.col("n") > 1000 / 10).withColumn("salts", F.ceil(F.col("n") / 100)).collect()
        assert [(r.k, r.salts) for r in hot] == [(0, 6)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("seed", range(3))
def test_row_changes_lead_from_target_to_source(spark, seed):
    rng = random.Random(seed)

    def table():
        keys = rng.sample([(a, b) for a in (1, 2, 3, None) for b in ("x", "y", None)], rng.randint(0, 12))
        return [(a, b, rng.choice(["p", "q", None]), rng.choice([1.5, None])) for a, b in keys]

    old, new = table(), table()
    schema = "a int, b string, c string, d double"
    target, source = spark.createDataFrame(old, schema), spark.createDataFrame(new, schema).select("d", "c", "b", "a")
    changes = row_changes(target, source, ["a", "b"])
    before, after = {r[:2]: r for r in old}, {r[:2]: r for r in new}
    want = [(*after[k], "insert") for k in after if k not in before]
    want += [(*before[k], "delete") for k in before if k not in after]
    want += [(*after[k], "update") for k in after if k in before and before[k] != after[k]]
    assert sorted(map(str, (tuple(r) for r in changes.collect()))) == sorted(map(str, want))
    assert sorted(map(str, (tuple(r) for r in applied(target, changes, ["a", "b"]).collect()))) == sorted(map(str, new))
    kept = applied(target, row_changes(target, source, ["a", "b"], delete=False), ["a", "b"])
    assert {r[:2] for r in map(tuple, kept.collect())} == set(before) | set(after)


def test_a_key_that_occurs_twice_is_refused(spark):
    target = spark.createDataFrame([(1, "a")], "k int, v string")
    source = spark.createDataFrame([(1, "b"), (1, "c")], "k int, v string")
    with pytest.raises(Exception, match="more than once"):
        row_changes(target, source, ["k"]).collect()


def test_the_nursery_series_reads_no_scan_before_its_state(spark, tmp_path):
    r = Bound(spark, FOLDER)
    whole = activity.nursery_time_series(r.scans, r.calendar.filter(F.col("day_date").between(F.lit(SCHEME.series_start), F.lit(AS_OF))).select(F.col("day_date").alias("full_date")), SCHEME, AS_OF)
    series, state = (PeriodTable(spark, str(tmp_path / n), d, "month") for n, d in (("series", "full_date"), ("state", "state_day")))
    early = AS_OF - timedelta(days=8)
    incremental.nursery_with_state(series, state, r.scans, r.calendar, early, SCHEME.series_start, SCHEME)
    until = early - timedelta(days=31)
    seen = r.scans.filter((F.col("visit_dt") <= F.lit(until)) & (F.col("visit_dt") >= F.lit(SCHEME.launch)))
    assert {x.state_day for x in state.read().collect()} == {until} and state.read().count() == seen.select("wallet_id").distinct().count()
    # later runs get no scan that the state covers
    for run in (early, AS_OF, AS_OF):
        later = r.scans.filter(F.col("visit_dt") > F.lit(until))
        touched = incremental.nursery_with_state(series, state, later, r.calendar, run, SCHEME.series_start, SCHEME)
        until = run - timedelta(days=31)
        assert {x.state_day for x in state.read().collect()} == {until} and all(p >= f"p{until:%Y-%m}" for p in touched)
    assert {tuple(x) for x in series.read().select(*whole.columns).collect()} == {tuple(x) for x in whole.collect()}
    with pytest.raises(ValueError, match="state is of"):
        incremental.nursery_with_state(series, state, later, r.calendar, AS_OF - timedelta(days=5), SCHEME.series_start, SCHEME)


def test_catalog_counts_survive_a_table_that_fails_when_read(spark):
    spark.range(7).createOrReplaceTempView("probe_good")
    spark.sql("SELECT id FROM range(5) WHERE raise_error('unreadable') IS NULL").createOrReplaceTempView("probe_bad")
    try:
        found = {r.table_name: r for r in jobs.catalog_row_counts(spark, "default", datetime(2024, 1, 1), {"probe_good": "id > 2"}, "probe_*").collect()}
        assert set(found) == {"probe_good", "probe_bad"}
        assert (found["probe_good"].row_count, found["probe_good"].error) == (4, None)
        assert found["probe_bad"].row_count is None and "unreadable" in found["probe_bad"].error
    finally:
        for name in ("probe_good", "probe_bad"):
            spark.catalog.dropTempView(name)


def test_last_scans_move_on(spark):
    rng = random.Random(3)
    scans = [(rng.choice([1, 1, rng.randint(2, 9)]), datetime(2024, 1, 1) + timedelta(days=rng.randint(0, 20), hours=3)) for _ in range(120)]
    df = spark.createDataFrame(scans, "wallet_id int, event_ts timestamp")
    cut = date(2024, 1, 9)
    state = activity.last_scans(None, activity.scan_counts(df, None, cut))
    moved = activity.last_scans(state, activity.scan_counts(df, cut, None))
    want, last = Counter(), defaultdict(lambda: date.min)
    for w, t in scans:
        want[w] += 1
        last[w] = max(last[w], t.date())
    assert {r.wallet_id: (r.scan_day, r.n) for r in moved.collect()} == {w: (last[w], n) for w, n in want.items()}
