"""Check rules: each turns tables into a lazy one-row frame (passed, message)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date, datetime, time, timedelta
from time import monotonic

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from stampbook.dq.metrics import PercentageOfMedian, daily_counts
from stampbook.functions import on_days
from stampbook.operators import first_per_key, latest_per_key
from stampbook.sources import PeriodTable, VersionedTable, upsert

Tables = Mapping[str, DataFrame]
HISTORY_TYPES = (
    "mean_daily_row_count",
    "max_daily_row_count",
    "min_daily_row_count",
    "stddev_daily_row_count",
    "total_row_count",
)
NO_HISTORY = "There was no historical data recorded, so historical test has passed."


@dataclass(frozen=True)
class Context:
    """What a run of the checks knows beside the tables."""

    as_of: date
    now: datetime | None = None
    history: DataFrame | None = None
    run_log: DataFrame | None = None

    @property
    def clock(self) -> datetime:
        return self.now or datetime.combine(self.as_of, time(6))


def _day(column: str, fmt: str | None = None) -> Column:
    return F.to_date(column, fmt) if fmt else F.to_date(column)


def _rows(tables: Tables, table: str, where: str | None) -> DataFrame:
    if table not in tables:
        raise KeyError(f"table not found: {table}")
    df = tables[table]
    return df.filter(where) if where else df


def _verdict(df: DataFrame, passed: Column, message: Column | None = None) -> DataFrame:
    """Collapse ``df`` to its one verdict row; no row at all is a failure."""
    text = F.lit(None).cast("string") if message is None else F.max(message)
    return df.agg(F.coalesce(passed, F.lit(False)).alias("passed"), text.alias("message"))


@dataclass(frozen=True)
class DailyCount:
    """The checked day's count is at least ``tolerance`` x the median of the window."""

    table: str
    day: str
    window: int
    tolerance: float
    lag: int | Mapping[int, int] = 1
    where: str | None = None
    value: str | None = None
    day_format: str | None = None
    noon_lag: int | None = None

    def checked_day(self, context: Context) -> date:
        lag = self.lag
        if isinstance(lag, Mapping):
            lag = lag.get(context.as_of.weekday(), lag[-1])
        if self.noon_lag is not None and context.clock.hour < 12:
            lag = self.noon_lag
        return context.as_of - timedelta(days=lag)

    def daily(self, tables: Tables, context: Context) -> DataFrame:
        day = _day(self.day, self.day_format)
        first, after = context.as_of - timedelta(days=self.window - 1), context.as_of + timedelta(days=1)
        recent = (day >= F.lit(first)) & (day < F.lit(after)) if self.day_format else on_days(self.day, first, after)
        rows = _rows(tables, self.table, self.where).filter(recent)
        return daily_counts(rows, day, F.expr(self.value) if self.value else None)

    def evaluate(self, tables: Tables, context: Context) -> DataFrame:
        flagged = PercentageOfMedian(self.tolerance).flag(self.daily(tables, context))
        target = F.col("dt") == F.lit(self.checked_day(context))
        return _verdict(flagged, F.bool_or(target & F.col("pass_check")))


@dataclass(frozen=True)
class RatioAgainstMedian:
    """A daily ratio is at least ``tolerance`` x its median over the earlier days."""

    table: str
    day: str
    numerator: str
    denominator: str
    window: int
    tolerance: float
    where: str | None = None

    def evaluate(self, tables: Tables, context: Context) -> DataFrame:
        day = _day(self.day)
        target = F.lit(context.as_of - timedelta(days=1))
        value = F.try_divide(F.sum(self.numerator).cast("double") * 100, F.sum(self.denominator).cast("double"))
        daily = daily_counts(
            _rows(tables, self.table, self.where).filter(
                on_days(self.day, context.as_of - timedelta(days=self.window - 1), None)
            ),
            day,
            value,
        )
        cutoff = daily.filter(F.col("dt") < target).agg((F.median("row_count") * self.tolerance).alias("cutoff"))
        passed = (F.col("dt") == target) & (F.col("row_count") >= cutoff.scalar())
        return _verdict(daily, F.bool_or(F.coalesce(passed, F.lit(False))))


@dataclass(frozen=True)
class Duplicates:
    """Rows divided by distinct rows stays within 1 + tolerance on every day."""

    table: str
    day: str
    scope: int
    tolerance: float
    distinct_on: Sequence[str] | None = None
    where: str | None = None

    def ratios(self, tables: Tables, context: Context) -> DataFrame:
        rows = _rows(tables, self.table, self.where)
        day = _day(self.day)
        recent = rows.filter(
            on_days(self.day, context.as_of - timedelta(days=self.scope - 1), context.as_of)
        ).withColumn("dt", day)
        # one grouping gives both numbers: copies per distinct row, then rows per day
        columns = list(self.distinct_on or rows.columns)
        copies = recent.groupBy("dt", *columns).agg(F.count(F.lit(1)).alias("copies"))
        return (
            copies.groupBy("dt")
            .agg(F.sum("copies").alias("row_count"), F.count(F.lit(1)).alias("distinct_count"))
            .withColumn("pass_check", F.col("row_count") / F.col("distinct_count") <= 1 + self.tolerance)
        )

    def evaluate(self, tables: Tables, context: Context) -> DataFrame:
        return self.ratios(tables, context).agg(
            F.coalesce(F.bool_and("pass_check"), F.lit(True)).alias("passed"), F.lit(None).cast("string").alias("message")
        )


def within_tolerance(current: Column, reference: Column, tolerance: float) -> Column:
    """Strictly inside reference x (1 ± tolerance)."""
    return (current > reference * (1 - tolerance)) & (current < reference * (1 + tolerance))


def history_statistics(daily: DataFrame) -> DataFrame:
    """Mean, max, min, deviation and total of daily counts as (history_type, value) rows."""
    value = F.col("row_count")
    stats = daily.agg(
        F.avg(value).alias(HISTORY_TYPES[0]),
        F.max(value).cast("double").alias(HISTORY_TYPES[1]),
        F.min(value).cast("double").alias(HISTORY_TYPES[2]),
        F.stddev_samp(value).alias(HISTORY_TYPES[3]),
        F.sum(value).cast("double").alias(HISTORY_TYPES[4]),
    )
    rows = [F.struct(F.lit(t).alias("history_type"), F.col(t).alias("value")) for t in HISTORY_TYPES]
    return stats.select(F.inline(F.array(*rows)))


def snapshots_as_of(history: DataFrame, as_of: date | None = None) -> DataFrame:
    """Newest value per check and history type taken up to the end of ``as_of``, with the day it describes."""
    taken = history if as_of is None else history.filter(F.col("dts") < F.lit(as_of + timedelta(days=1)))
    return latest_per_key(taken, ["check_id", "history_type"], "dts").select(
        "check_id",
        "history_type",
        F.col("historical_value").cast("double").alias("reference"),
        F.date_sub(F.to_date("dts"), 1).alias("snapshot_day"),
    )


def latest_snapshot(history: DataFrame, check_id: int) -> DataFrame:
    """Newest value per history type of a check, with the day it describes."""
    newest = latest_per_key(history.filter(F.col("check_id") == check_id), ["history_type"], "dts")
    return newest.select(
        "history_type",
        F.col("historical_value").cast("double").alias("reference"),
        F.date_sub(F.to_date("dts"), 1).alias("snapshot_day"),
    )


def compare_history(current: DataFrame, snapshot: DataFrame, tolerance: float) -> DataFrame:
    """Verdict over all types; differing sets of types fail with a message."""
    both = current.join(snapshot, "history_type", "full")
    unmatched = F.count_if(F.col("value").isNull() != F.col("reference").isNull())
    inside = F.bool_and(F.coalesce(within_tolerance(F.col("value"), F.col("reference"), tolerance), F.lit(False)))
    return both.agg(unmatched.alias("_unmatched"), inside.alias("_inside")).select(
        ((F.col("_unmatched") == 0) & F.coalesce("_inside", F.lit(False))).alias("passed"),
        F.when(F.col("_unmatched") > 0, F.lit("history types do not match")).alias("message"),
    )


@dataclass(frozen=True)
class History:
    """Statistics of all daily counts up to the snapshot day still agree with the snapshot."""

    table: str
    by: str
    tolerance: float
    up_to: Sequence[str] = ()
    where: str | None = None
    first_per: Sequence[str] = ()
    check_id: int = 0

    def daily(self, tables: Tables, last_day: Column) -> DataFrame:
        rows = _rows(tables, self.table, self.where)
        if self.first_per:
            rows = first_per_key(rows, list(self.first_per), [F.col(self.by).asc()])
        for column in (self.by, *self.up_to):
            rows = rows.filter(F.col(column) < F.date_add(last_day, 1))
        return daily_counts(rows, _day(self.by))

    def snapshot(self, tables: Tables, context: Context) -> DataFrame:
        """Rows to append to the history after a pass."""
        target = F.lit(context.as_of - timedelta(days=1))
        return history_statistics(self.daily(tables, target)).filter("value is not null").select(
            F.lit(self.check_id).alias("check_id"),
            "history_type",
            F.col("value").cast("string").alias("historical_value"),
            F.lit(context.clock).alias("dts"),
        )

    def evaluate(self, tables: Tables, context: Context) -> DataFrame:
        spark = next(iter(tables.values())).sparkSession
        _rows(tables, self.table, self.where)
        if context.history is None:
            return spark.range(1).select(F.lit(True).alias("passed"), F.lit(NO_HISTORY).alias("message"))
        snapshot = latest_snapshot(context.history, self.check_id)
        day = snapshot.agg(F.max("snapshot_day").alias("d")).scalar()
        current = history_statistics(self.daily(tables, day))
        compared = compare_history(current.filter("value is not null"), snapshot, self.tolerance)
        return compared.select(
            F.when(day.isNull(), F.lit(True)).otherwise(F.col("passed")).alias("passed"),
            F.when(day.isNull(), F.lit(NO_HISTORY)).otherwise(F.col("message")).alias("message"),
        )


@dataclass(frozen=True)
class Newest:
    """The newest date equals, is one of, or is at least the expected day(s)."""

    table: str
    day: str
    lags: Sequence[int] = (1,)
    mode: str = "one_of"
    where: str | None = None

    def evaluate(self, tables: Tables, context: Context) -> DataFrame:
        newest = F.max(_day(self.day))
        if self.mode == "since_last_friday":
            back = (context.as_of.weekday() - 4) % 7 or 7
            passed = newest >= F.lit(context.as_of - timedelta(days=back))
        else:
            passed = newest.isin(*[F.lit(context.as_of - timedelta(days=lag)) for lag in self.lags])
        return _verdict(_rows(tables, self.table, self.where), passed)


@dataclass(frozen=True)
class RanToday:
    """The job's latest successful run started on the as-of day."""

    job: str

    def evaluate(self, tables: Tables, context: Context) -> DataFrame:
        if context.run_log is None:
            raise KeyError("no run log given")
        runs = context.run_log.filter((F.col("job_name") == self.job) & F.col("succeeded"))
        return _verdict(runs, F.max(F.to_date("start_ts")) == F.lit(context.as_of))


def shared_run_verdicts(rules: Sequence[tuple[int, RanToday]], spark: SparkSession, context: Context) -> DataFrame:
    """Verdicts of all job rules from one read of the run log."""
    if context.run_log is None:
        raise KeyError("no run log given")
    listed = spark.createDataFrame([(check_id, rule.job) for check_id, rule in rules], "check_id int, job_name string")
    runs = context.run_log.filter(F.col("succeeded") & F.col("job_name").isin(*{rule.job for _, rule in rules}))
    newest = runs.groupBy("job_name").agg(F.max(F.to_date("start_ts")).alias("day"))
    passed = F.coalesce(F.col("day") == F.lit(context.as_of), F.lit(False)).alias("passed")
    return listed.join(newest, "job_name", "left").select("check_id", passed, F.lit(None).cast("string").alias("message"))


@dataclass(frozen=True)
class HasRows:
    """The table holds at least ``minimum`` rows."""

    table: str
    minimum: int = 1
    where: str | None = None

    def evaluate(self, tables: Tables, context: Context) -> DataFrame:
        return _verdict(_rows(tables, self.table, self.where), F.count(F.lit(1)) >= self.minimum)


@dataclass(frozen=True)
class RecentIsoWeek:
    """The newest date lies in the current or the previous ISO week."""

    table: str
    day: str

    def evaluate(self, tables: Tables, context: Context) -> DataFrame:
        monday = F.date_trunc("week", F.max(_day(self.day))).cast("date")
        this_monday = context.as_of - timedelta(days=context.as_of.weekday())
        passed = monday.isin(F.lit(this_monday), F.lit(this_monday - timedelta(days=7)))
        return _verdict(_rows(tables, self.table, None), passed)


@dataclass(frozen=True)
class WeekLoaded:
    """The newest week is the one that holds the day seven days back."""

    table: str
    week: str
    finder: str = "week_finder"

    def evaluate(self, tables: Tables, context: Context) -> DataFrame:
        day = F.lit(context.as_of - timedelta(days=7))
        newest = _rows(tables, self.table, None).agg(F.max(self.week).alias("newest")).scalar()
        expected = (
            _rows(tables, self.finder, None)
            .filter((F.col("week_start_day") < day) & (F.col("week_end_day") > day))
            .agg(F.max("week").alias("expected"), F.count(F.lit(1)).alias("matches"))
        )
        return expected.select(
            F.coalesce((newest == F.col("expected")) & (F.col("matches") == 1), F.lit(False)).alias("passed"),
            F.when(F.col("matches") != 1, F.lit("Could not find the last complete week")).alias("message"),
        )


@dataclass(frozen=True)
class PerGroupCount:
    """Every group's count on the checked day is above tolerance x its own median before."""

    table: str
    day: str
    group: str
    window: int
    tolerance: float

    def groups(self, tables: Tables, context: Context) -> DataFrame:
        day = _day(self.day)
        target = context.as_of - timedelta(days=1)
        rows = _rows(tables, self.table, None).filter(
            on_days(self.day, context.as_of - timedelta(days=self.window - 1), context.as_of)
        )
        daily = rows.groupBy(self.group, day.alias("dt")).agg(F.count(F.lit(1)).alias("n"))
        before = F.when(F.col("dt") != F.lit(target), F.col("n"))
        return (
            daily.groupBy(self.group)
            .agg(
                (F.median(before) * self.tolerance).alias("low_count_cutoff"),
                F.max(F.when(F.col("dt") == F.lit(target), F.col("n"))).alias("checked_count"),
            )
            .filter("low_count_cutoff is not null")
            .withColumn("passed_check", F.col("checked_count") > F.col("low_count_cutoff"))
        )

    def by_day(self, tables: Tables, context: Context) -> DataFrame:
        """The same counts with one column per day of the window."""
        day = _day(self.day)
        days = [context.as_of - timedelta(days=n) for n in range(self.window - 1, 0, -1)]
        rows = _rows(tables, self.table, None).filter(
            on_days(self.day, context.as_of - timedelta(days=self.window - 1), context.as_of)
        )
        return (
            rows.select(self.group, day.cast("string").alias("dt"))
            .groupBy(self.group)
            .pivot("dt", [d.isoformat() for d in days])
            .agg(F.count(F.lit(1)))
        )

    def evaluate(self, tables: Tables, context: Context) -> DataFrame:
        # a store without rows on the checked day has no verdict and does not fail the check
        failed = F.count_if(~F.col("passed_check"))
        return _verdict(self.groups(tables, context), failed == 0)


@dataclass(frozen=True)
class CheckSpec:
    """A numbered check: its rules must all pass."""

    check_id: int
    definition: str
    rules: Sequence[object] = field(default_factory=tuple)


@dataclass(frozen=True)
class Snapshot:
    """The values a history rule compares with, and the day they describe."""

    day: date
    values: Mapping[str, float]


def read_snapshots(history: DataFrame | None, as_of: date | None = None) -> dict[int, Snapshot]:
    """The newest snapshot of each check: at most one row per check and history type reaches the driver."""
    found: dict[int, dict] = {}
    days: dict[int, date] = {}
    for row in [] if history is None else snapshots_as_of(history, as_of).collect():
        found.setdefault(row["check_id"], {})[row["history_type"]] = row["reference"]
        days[row["check_id"]] = max(days.get(row["check_id"], row["snapshot_day"]), row["snapshot_day"])
    return {check_id: Snapshot(days[check_id], values) for check_id, values in found.items()}


def _shareable(rule: object) -> bool:
    if isinstance(rule, DailyCount):
        return rule.value is None and rule.day_format is None
    return isinstance(rule, Duplicates) or (isinstance(rule, History) and not rule.first_per)


def _rule_day(rule) -> str:
    return rule.by if isinstance(rule, History) else rule.day


def _rows_of(rule, context: Context, snapshot: Snapshot | None) -> Column:
    """Which rows of its table a shared rule counts."""
    if isinstance(rule, DailyCount):
        wanted = on_days(rule.day, context.as_of - timedelta(days=rule.window - 1), context.as_of + timedelta(days=1))
    elif isinstance(rule, Duplicates):
        wanted = on_days(rule.day, context.as_of - timedelta(days=rule.scope - 1), context.as_of)
    else:
        wanted = on_days(rule.by, None, snapshot.day + timedelta(days=1))
        for column in rule.up_to:
            wanted = wanted & on_days(column, None, snapshot.day + timedelta(days=1))
    return wanted & F.expr(rule.where) if rule.where else wanted


def shared_daily_counts(
    rows: DataFrame, day: str, rules: Sequence[tuple[int, object]], context: Context, snapshots: Mapping[int, Snapshot]
) -> DataFrame:
    """rule (its place in ``rules``), dt, n, distinct: what all rules on a table and day column need, from one fold.

    Rows fold to one per day and distinct key, with a count per rule; rows that no duplicate rule asks about have no
    key and so fold to one per day and task. ``distinct`` is the number of keys a rule meets on a day. All duplicate
    rules among ``rules`` have the same key columns. A rule without rows has none here.
    """
    wanted = [_rows_of(rule, context, snapshots.get(check_id)) for check_id, rule in rules]
    keyed = [w for w, (_, rule) in zip(wanted, rules, strict=True) if isinstance(rule, Duplicates)]
    columns = next((list(rule.distinct_on or rows.columns) for _, rule in rules if isinstance(rule, Duplicates)), [])
    some = wanted[0]
    for w in wanted[1:]:
        some = some | w
    key = F.lit(0)
    if keyed:
        asked = keyed[0]
        for w in keyed[1:]:
            asked = asked | w
        key = F.when(asked, F.struct(*[F.col(f"`{c}`") for c in columns]))
    flags = [F.coalesce(w, F.lit(False)).alias(f"w{i}") for i, w in enumerate(wanted)]
    folded = (
        rows.filter(some)
        .select(_day(day).alias("dt"), key.alias("key"), *flags)
        .groupBy("dt", "key")
        .agg(*[F.count_if(f"w{i}").alias(f"n{i}") for i in range(len(rules))])
    )
    per_day = folded.groupBy("dt").agg(
        *[F.sum(f"n{i}").alias(f"n{i}") for i in range(len(rules))],
        *[F.count_if(F.col(f"n{i}") > 0).alias(f"d{i}") for i in range(len(rules))],
    )
    each = [F.struct(F.lit(i).alias("rule"), F.col(f"n{i}").alias("n"), F.col(f"d{i}").alias("distinct")) for i in range(len(rules))]
    return per_day.select("dt", F.inline(F.array(*each))).filter("n > 0")


def _statistics() -> list[Column]:
    n = F.col("n")
    values = (F.avg(n), F.max(n).cast("double"), F.min(n).cast("double"), F.stddev_samp(n), F.sum(n).cast("double"))
    return [value.alias(name) for name, value in zip(HISTORY_TYPES, values, strict=True)]


def shared_daily_verdicts(
    rows: DataFrame,
    day: str,
    rules: Sequence[tuple[int, object]],
    context: Context,
    snapshots: Mapping[int, Snapshot] | None = None,
) -> DataFrame:
    """Verdicts of the daily-count, duplicate and history rules on one table and day column, from one read of it."""
    snapshots = snapshots or {}
    spark = rows.sparkSession
    silent = [(c, True, NO_HISTORY) for c, rule in rules if isinstance(rule, History) and c not in snapshots]
    rules = [(c, rule) for c, rule in rules if not (isinstance(rule, History) and c not in snapshots)]
    without = spark.createDataFrame(silent, "check_id int, passed boolean, message string")
    if not rules:
        return without
    counts = shared_daily_counts(rows, day, rules, context, snapshots)
    tolerances = {i: rule.tolerance for i, (_, rule) in enumerate(rules)}
    checked = {i: rule.checked_day(context) for i, (_, rule) in enumerate(rules) if isinstance(rule, DailyCount)}

    def per_rule(values: Mapping[int, object]) -> Column:
        return F.coalesce(F.lit(None), *[F.when(F.col("rule") == i, F.lit(v)) for i, v in values.items()])

    tolerance = per_rule(tolerances)
    on_day = F.col("dt") == (per_rule(checked) if checked else F.lit(None).cast("date"))
    found = counts.groupBy("rule").agg(
        F.median("n").alias("median"),
        F.max(F.when(on_day, F.col("n"))).alias("checked"),
        F.bool_and(F.col("n") / F.col("distinct") <= 1 + tolerance).alias("no_copies"),
        *_statistics(),
    )
    listed = spark.createDataFrame([(i, c) for i, (c, _) in enumerate(rules)], "rule int, check_id int")
    passed, message = F.lit(None).cast("boolean"), F.lit(None).cast("string")
    for i, (check_id, rule) in enumerate(rules):
        mine = F.col("rule") == i
        if isinstance(rule, DailyCount):
            verdict = F.coalesce(F.col("checked") >= F.col("median") * rule.tolerance, F.lit(False))
        elif isinstance(rule, Duplicates):
            verdict = F.coalesce("no_copies", F.lit(True))
        else:
            verdict, unmatched = F.lit(True), F.lit(False)
            for name in HISTORY_TYPES:
                reference = snapshots[check_id].values.get(name)
                if reference is None:
                    unmatched = unmatched | F.col(name).isNotNull()
                else:
                    unmatched = unmatched | F.col(name).isNull()
                    verdict = verdict & F.coalesce(within_tolerance(F.col(name), F.lit(reference), rule.tolerance), F.lit(False))
            unmatched = unmatched | F.lit(bool(set(snapshots[check_id].values) - set(HISTORY_TYPES)))
            verdict = verdict & ~unmatched
            message = F.when(mine & unmatched, F.lit("history types do not match")).otherwise(message)
        passed = F.when(mine, verdict).otherwise(passed)
    joined = listed.join(found, "rule", "left")
    return joined.select("check_id", passed.alias("passed"), message.alias("message")).unionByName(without)


def _statistics_of(rules: Sequence[tuple[int, History]], tables: Tables, context: Context, snapshots: Mapping[int, Snapshot]) -> DataFrame:
    """check_id, history_type, value of history rules, each up to its snapshot's day; one read for a table and day column."""
    shared, parts = {}, []
    for check_id, rule in rules:
        if rule.first_per:
            found = history_statistics(rule.daily(tables, F.lit(snapshots[check_id].day)))
            parts.append(found.select(F.lit(check_id).alias("check_id"), "history_type", "value"))
        else:
            shared.setdefault((rule.table, rule.by), []).append((check_id, rule))
    for (table, day), of in shared.items():
        counts = shared_daily_counts(_rows(tables, table, None), day, of, context, snapshots)
        values = F.inline(F.array(*[F.struct(F.lit(t).alias("history_type"), F.col(t).alias("value")) for t in HISTORY_TYPES]))
        ids = F.get(F.array(*[F.lit(check_id) for check_id, _ in of]), F.col("rule")).alias("check_id")
        parts.append(counts.groupBy("rule").agg(*_statistics()).select(ids, values))
    spark = next(iter(tables.values())).sparkSession
    return _stacked([spark.createDataFrame([], "check_id int, history_type string, value double"), *parts]).filter("value is not null")


def snapshots(rules: Sequence[History], tables: Tables, context: Context) -> DataFrame:
    """The rows to append to the history for several rules at once, as ``History.snapshot`` has them for one."""
    until = {rule.check_id: Snapshot(context.as_of - timedelta(days=1), {}) for rule in rules}
    found = _statistics_of([(rule.check_id, rule) for rule in rules], tables, context, until)
    return found.select("check_id", "history_type", F.col("value").cast("string").alias("historical_value"), F.lit(context.clock).alias("dts"))


def history_values(
    specs: Sequence[CheckSpec], tables: Tables, context: Context
) -> DataFrame:
    """check_id, history_type, value, reference, tolerance of each type that a check's snapshot or its table has now.

    The checks on one table and day column share one read; a check without a snapshot has no rows.
    """
    known = read_snapshots(context.history, context.as_of)
    rules = [(spec.check_id, rule) for spec in specs for rule in spec.rules if isinstance(rule, History) and spec.check_id in known]
    now = _statistics_of(rules, tables, context, known)
    spark = now.sparkSession
    tolerances = spark.createDataFrame([(c, rule.tolerance) for c, rule in rules], "check_id int, tolerance double")
    then = [(c, t, v) for c, snapshot in known.items() for t, v in snapshot.values.items()]
    references = spark.createDataFrame(then, "check_id int, history_type string, reference double")
    return now.join(references, ["check_id", "history_type"], "full").join(tolerances, "check_id", "left")


def _folds(shared: Mapping[tuple, list]) -> dict[tuple, list]:
    """Rules by ((table, number), day): those without a key join the first fold of their table and day."""
    folds: dict[tuple, list] = {}
    for (table, day, key), rules in sorted(shared.items(), key=lambda item: -len(item[0][2])):
        if not key and ((table, 0), day) in folds:
            folds[(table, 0), day] += rules
            continue
        number = sum(1 for (t, _), d in folds if t == table and d == day)
        folds[(table, number), day] = list(rules)
    return folds


def _stacked(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of frames with the same columns, in one statement: the plan is analysed once, not once a frame."""
    names = {f"f{i}": df.select(*frames[0].columns) for i, df in enumerate(frames)}
    return frames[0].sparkSession.sql(" UNION ALL ".join(f"SELECT * FROM {{{name}}}" for name in names), **names)


def run_checks(spark: SparkSession, specs: Sequence[CheckSpec], tables: Tables, context: Context) -> DataFrame:
    """One status row per check, as a single lazy plan.

    Daily counts, duplicates and history on the same table and day column are
    read together, and so are all job rules. A rule whose table or columns are missing, or that yields no row at all,
    fails its check; the error text is kept. The history's newest snapshots are
    read in a job of their own, so that their days reach the tables as literals.
    """
    snapshots = read_snapshots(context.history, context.as_of)
    shared: dict[tuple, list[tuple[int, object]]] = {}
    verdicts, errors = [], []

    def attempt(check_ids: Sequence[int], build, alone: bool = True) -> bool:
        try:
            df = build()
            df.schema  # resolves the plan, so that one broken rule does not stop the others
            verdicts.append(df)
            return True
        except Exception as e:  # noqa: BLE001
            if alone:
                errors.extend((check_id, False, str(e).split("\n")[0]) for check_id in check_ids)
            return alone

    ran = [(spec.check_id, rule) for spec in specs for rule in spec.rules if isinstance(rule, RanToday)]
    if ran:
        attempt([check_id for check_id, _ in ran], lambda: shared_run_verdicts(ran, spark, context))
    for spec in specs:
        for rule in spec.rules:
            if isinstance(rule, RanToday):
                continue
            if _shareable(rule):
                key = tuple(rule.distinct_on or ("*",)) if isinstance(rule, Duplicates) else ()
                shared.setdefault((rule.table, _rule_day(rule), key), []).append((spec.check_id, rule))
            else:
                attempt(
                    [spec.check_id],
                    lambda rule=rule, spec=spec: rule.evaluate(tables, context).select(
                        F.lit(spec.check_id).alias("check_id"), "passed", "message"
                    ),
                )
    for (table, day), rules in _folds(shared).items():
        def together(rules, table=table[0], day=day) -> DataFrame:
            return shared_daily_verdicts(_rows(tables, table, None), day, rules, context, snapshots)

        if not attempt([check_id for check_id, _ in rules], lambda rules=rules: together(rules), alone=len(rules) == 1):
            for rule in rules:  # one bad rule leaves the others standing
                attempt([rule[0]], lambda rule=rule: together([rule]))
    schema = "check_id int, passed boolean, message string"
    combined = _stacked([spark.createDataFrame(errors, schema), *verdicts])
    listed = spark.createDataFrame(
        [(s.check_id, s.definition, len(s.rules)) for s in specs], "check_id int, definition string, rules int"
    )
    outcome = combined.groupBy("check_id").agg(
        F.bool_and("passed").alias("all_passed"), F.count(F.lit(1)).alias("seen"), F.max("message").alias("error_message")
    )
    return listed.join(outcome, "check_id", "left").select(
        "check_id",
        "definition",
        F.coalesce(F.col("all_passed") & (F.col("seen") == F.col("rules")), F.lit(False)).alias("status"),
        "error_message",
        F.lit(context.clock).alias("dts"),
    )


def collected_checks(
    spark: SparkSession, specs: Sequence[CheckSpec], tables: Tables, context: Context
) -> list[Row]:
    """The rows of ``run_checks``; if that job fails, each check runs in a job of its own.

    A check whose own job fails gets a failed row with the error's first line, so
    one bad value in one table leaves the verdicts of the other checks standing.
    """
    try:
        return run_checks(spark, specs, tables, context).collect()
    except Exception as e:  # noqa: BLE001
        if len(specs) > 1:
            return [row for spec in specs for row in collected_checks(spark, [spec], tables, context)]
        message = str(e).split("\n")[0]
        return [
            Row(check_id=s.check_id, definition=s.definition, status=False, error_message=message, dts=context.clock)
            for s in specs
        ]


NOT_COMPLETED = "Check did not complete."


def _merged(log: VersionedTable | PeriodTable, rows: DataFrame, keys: Sequence[str] = ("check_id", "dts")) -> None:
    if isinstance(log, PeriodTable):
        log.merge(rows, keys)
    else:
        log.write(upsert(log.read(), rows, keys) if log.exists() else rows)


def clear_history(history_log: PeriodTable, check_id: int) -> list[str]:
    """Forgets all snapshots of a check, whose next pass records a new one. Returns the periods rewritten."""
    return history_log.delete(F.col("check_id") == check_id)


def record_checks(
    spark: SparkSession,
    specs: Sequence[CheckSpec],
    tables: Tables,
    context: Context,
    log: VersionedTable | PeriodTable,
    run_url: str | None = None,
    history_log: VersionedTable | PeriodTable | None = None,
) -> DataFrame:
    """Run the checks and keep their results in ``log``.

    A failed row per check is written first and replaced by the result, so a
    run that dies leaves no older pass standing. Checks with a history rule that
    passed append a new snapshot to ``history_log``. Returns this run's rows.
    """
    began = monotonic()
    columns = ["check_id", "definition", "status", "error_message", "dts", "run_url", "run_duration_seconds"]

    def stamped(df: DataFrame, seconds: float | None) -> DataFrame:
        return df.select(
            *columns[:5],
            F.lit(run_url).cast("string").alias("run_url"),
            F.lit(seconds).cast("float").alias("run_duration_seconds"),
        )

    pessimistic = spark.createDataFrame(
        [(s.check_id, s.definition, False, NOT_COMPLETED) for s in specs],
        "check_id int, definition string, status boolean, error_message string",
    ).withColumn("dts", F.lit(context.clock))
    first = stamped(pessimistic, None)
    _merged(log, first)
    # one row per check: the statuses fit the driver
    found = collected_checks(spark, specs, tables, context)
    results = stamped(spark.createDataFrame(found, schema=pessimistic.schema), monotonic() - began)
    _merged(log, results)
    if history_log is not None:
        passed = {row["check_id"] for row in found if row["status"]}
        due = [rule for spec in specs for rule in spec.rules if isinstance(rule, History) and spec.check_id in passed]
        if due:
            _merged(history_log, snapshots(due, tables, context), ["check_id", "history_type", "dts"])
    return results
