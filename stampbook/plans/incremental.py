"""Incremental runs of the daily series: decide the window, read only what it needs, upsert the result."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stampbook.functions import on_days
from stampbook.plans import activity, crm, jobs
from stampbook.scheme import Scheme
from stampbook.sources import PeriodTable, incremental_start, staged, upsert

TRAILING_DAYS = 31


def refreshed(
    target: DataFrame | PeriodTable,
    calendar_days: DataFrame,
    as_of: date,
    full_start: date,
    build: Callable[[date, DataFrame], DataFrame],
    keys: tuple[str, ...] = ("full_date",),
    trailing_days: int = TRAILING_DAYS,
    last: date | None = None,
) -> DataFrame:
    """``target`` after a run: the trailing days built again, or all of them if the target has gaps before.

    ``build`` gets the first day and the days to build (``full_date``), up to ``last`` (``as_of`` if not given). The first day
    is read from the target in a job of its own (one row), so that it reaches the
    scans as a literal and files before it are skipped. A stored table is changed in place, in the folders
    of those days alone.
    """
    stored = isinstance(target, PeriodTable)
    empty = calendar_days.sparkSession.createDataFrame([], "full_date date")
    held = target if not stored else target.read() if target.exists() else empty
    first = incremental_start(held.select("full_date"), calendar_days, as_of, full_start, trailing_days).first()["load_from"]
    first = max(first, full_start)
    days = calendar_days.filter(F.col("day_date").between(F.lit(first), F.lit(last or as_of))).select(
        F.col("day_date").alias("full_date")
    )
    rows = build(first, days)
    if stored:
        target.merge(rows, keys)
        return target.read()
    return upsert(target, rows.select(*target.columns), keys)


def activity_time_series(
    target: DataFrame | PeriodTable, scans: DataFrame, calendar_days: DataFrame, as_of: date, full_start: date
) -> DataFrame:
    """``activity.activity_time_series`` brought up to date; scans are read from 91 days before the window on."""

    def build(first: date, days: DataFrame) -> DataFrame:
        return activity.activity_time_series(scans.filter(on_days("event_ts", first - timedelta(days=91), as_of)), days)

    return refreshed(target, calendar_days, as_of, full_start, build)


def active_earners(
    target: DataFrame | PeriodTable,
    missions: DataFrame,
    games: DataFrame,
    scans: DataFrame,
    calendar_days: DataFrame,
    as_of: date,
    full_start: date,
    scheme: Scheme = Scheme(),
) -> DataFrame:
    """``activity.active_earners`` brought up to date; all inputs are read from six days before the window on."""

    def build(first: date, days: DataFrame) -> DataFrame:
        since = first - timedelta(days=6)
        return activity.active_earners(
            missions.filter(on_days("cmpgn_cmplt_ts", since, as_of)),
            games.filter(on_days("game_redm_ts", since, as_of)),
            scans.filter(on_days("event_ts", since, as_of)),
            days,
            as_of,
            scheme,
        )

    return refreshed(target, calendar_days, as_of, full_start, build, last=as_of - timedelta(days=1))


def nursery_time_series(
    target: DataFrame | PeriodTable, scans: DataFrame, calendar_days: DataFrame, as_of: date, full_start: date, scheme: Scheme = Scheme()
) -> DataFrame:
    """``activity.nursery_time_series`` brought up to date; lapsed wallets need the whole scan history."""

    def build(first: date, days: DataFrame) -> DataFrame:
        return activity.nursery_time_series(scans, days, scheme, as_of)

    return refreshed(target, calendar_days, as_of, full_start, build)


def nursery_with_state(
    series: PeriodTable,
    state: PeriodTable,
    scans: DataFrame,
    calendar_days: DataFrame,
    as_of: date,
    full_start: date,
    scheme: Scheme = Scheme(),
    trailing_days: int = TRAILING_DAYS,
) -> list[str]:
    """``activity.nursery_time_series`` brought up to date from a kept state of each wallet, without the scan history.

    ``state`` holds a row per wallet in one folder: its last scan and number of scans up to the column ``state_day``.
    A run moves it on by the scans before the series' trailing window, builds the window's days from
    the state and the scans since, and merges them. Only the first run, without a state, reads the history, and builds the
    whole series; a state that is already beyond the window (a run for an earlier day) raises.
    """
    fresh = not state.exists()
    window = as_of - timedelta(days=trailing_days - 1)
    until = window - timedelta(days=1)  # a row for a day looks at the scans of the next one
    since, before = scheme.launch, None
    if not fresh:
        held = state.read().agg(F.max("state_day").alias("day")).first()["day"]
        if held > until:
            raise ValueError(f"the state is of {held}, after {until}")
        before, since = state.read().drop("state_day"), held + timedelta(days=1)
    moved = activity.last_scans(before, activity.scan_counts(scans, since, until + timedelta(days=1)))
    with staged(moved.withColumn("state_day", F.lit(until)), "state") as now:
        if fresh:
            past, first = activity.scan_counts(scans, scheme.launch, as_of), full_start
        else:
            past, first = now.drop("state_day").unionByName(activity.scan_counts(scans, until + timedelta(days=1), as_of)), window
        days = calendar_days.filter(F.col("day_date").between(F.lit(first), F.lit(as_of))).select(F.col("day_date").alias("full_date"))
        touched = series.merge(activity.nursery_from_days(past, days, scheme), ("full_date",))
        # the next run moves on from here; the series does not depend on this write
        state.write(now)
    return touched


# --- jobs that take their lower bound from what the target holds, merge on several keys and prune ---

PARTICIPATION_KEYS = ("delivery_dt", "order_dt", "store_id")
PARTICIPATION_CUTOFF_DAYS = 7
SEND_KEYS = ("type", "journey_name", "groups", "journey_date")
SENDS_FULL_UNTIL, SENDS_FROM, SENDS_UNTIL = 16, 22, 15  # days before as_of
MONTHLY_KEYS = ("control_group", "week_id", "segment")
MONTHLY_WEEKS_BACK = 2


def order_participation(
    table: PeriodTable,
    orders: DataFrame,
    scans: DataFrame,
    calendar_days: DataFrame,
    regions: Sequence[tuple[str, Sequence[str], date, date]],
    default_region: tuple[str, date, date],
    submitted_from: date,
    full_from: date,
    as_of: date,
    cutoff_days: int = PARTICIPATION_CUTOFF_DAYS,
) -> list[str]:
    """``jobs.order_participation`` into a stored table (periods of ``delivery_dt``), by delivery day, order day and store.

    An empty table gets all deliveries from ``full_from`` on, any other those of the last ``cutoff_days`` days; the
    bound is a literal, so older orders are not read. Rows of days that are read again and have no orders left stay.
    """
    delivered_from = as_of - timedelta(days=cutoff_days) if table.exists() else full_from
    rows = jobs.order_participation(orders, scans, calendar_days, regions, default_region, submitted_from, delivered_from, as_of)
    return table.merge(rows, PARTICIPATION_KEYS)


def crm_send_level(
    table: PeriodTable,
    sends: DataFrame,
    key: str,
    channels: Callable[[tuple[date, date]], dict[str, DataFrame]],
    full_start: date,
    as_of: date,
    min_customers: int = 500,
    groups_needed: int = 2,
) -> list[str]:
    """``crm.crm_send_level`` into a stored table (periods of ``journey_date``), then small and one-sided groups go.

    An empty table gets the sends from ``full_start`` to 16 days back, any other those of 22 to 15 days back, whose
    following 14 days are complete by then. ``channels`` gets the first and last send day and returns
    ``crm.channel_orders`` within the frames around them. After the merge on type, journey, group and day, groups of
    fewer than ``min_customers`` are deleted, then every journey name that lacks a group on any of its days.
    Returns the periods that were rewritten.
    """
    if table.exists():
        sent = as_of - timedelta(days=SENDS_FROM), as_of - timedelta(days=SENDS_UNTIL)
    else:
        sent = full_start, as_of - timedelta(days=SENDS_FULL_UNTIL)
    touched = table.merge(crm.crm_send_level(crm.journeys(sends, *sent, key), channels(sent)), SEND_KEYS)
    touched += table.delete(F.col("customers") < min_customers)
    if table.exists():
        touched += table.delete(crm.incomplete_journeys(table.read(), groups_needed))
    return sorted(set(touched))


def crm_monthly(
    table: PeriodTable,
    control: DataFrame,
    orders: DataFrame,
    calendar_days: DataFrame,
    channel: str,
    full_after_week: int,
    pre_weeks: tuple[int, int],
    as_of: date,
    order_day: str = "order_day",
) -> list[str]:
    """``crm.crm_monthly`` into a stored table (one folder for each ``week_id``), by control group, week and segment.

    An empty table gets the weeks after ``full_after_week``, any other those after the number of the week of
    ``as_of`` less two. The first day of those weeks is looked up first, so that it reaches the orders as a literal.
    """
    after = full_after_week
    if table.exists():
        after = calendar_days.filter(F.col("day_date") == F.lit(as_of)).first()["retail_week"] - MONTHLY_WEEKS_BACK
    first = calendar_days.filter(F.col("retail_week") > after).agg(F.min("day_date").alias("d")).first()["d"]
    recent = orders.filter(on_days(order_day, first, None)) if first else orders.limit(0)
    return table.merge(crm.crm_monthly(control, recent, calendar_days, channel, after, pre_weeks, order_day), MONTHLY_KEYS)
