"""From check results to dependency status, schedules and pass rates."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stampbook.functions import first_match, on_days, ratio
from stampbook.operators import first_per_key, latest_per_key


def latest_check_status(status_log: DataFrame, day=None) -> DataFrame:
    """Newest status per check, optionally of one day only."""
    rows = status_log if day is None else status_log.filter(on_days("dts", day, day + timedelta(days=1)))
    return latest_per_key(rows, ["check_id"], "dts")


def dependency_status(status_log: DataFrame, mapping: DataFrame, definitions: DataFrame) -> DataFrame:
    """Latest status of each mapped check, and whether its dependency is free of high-severity failures."""
    latest = latest_per_key(status_log, ["check_id"], "dts", ties=True)
    rows = latest.join(mapping.select("dependency_id", "check_id", "severity"), "check_id").join(
        definitions.select(
            "dependency_id", F.col("name").alias("dependency_name"), F.col("type").alias("dependency_type")
        ),
        "dependency_id",
    )
    failed = ~F.col("status") & (F.col("severity") == "High")
    # a dependency has one row per mapped check
    dependency = Window.partitionBy("dependency_name", "dependency_type")
    return rows.select(
        "check_id",
        F.col("definition").alias("check_definition"),
        "severity",
        "dependency_id",
        "dependency_type",
        "dependency_name",
        "dts",
        "status",
        (F.sum(F.coalesce(failed, F.lit(False)).cast("int")).over(dependency) == 0).alias("overall_status"),
    )


def dependency_status_log(statuses: DataFrame) -> DataFrame:
    """One row per dependency, to append to the log."""
    return first_per_key(statuses, ["dependency_id"], [F.col("check_id").asc()]).select(
        "dependency_id", "dependency_name", "dependency_type", "overall_status"
    )


def ready_dependencies(log: DataFrame, definitions: DataFrame, dependency_type: str, ready: bool = True) -> DataFrame:
    """Dependencies of a type whose latest overall status equals ``ready``."""
    return (
        latest_per_key(log, ["dependency_id"], "dts")
        .filter(F.col("overall_status") == F.lit(ready))
        .select("dependency_id", "overall_status", "dts")
        .join(
            definitions.filter(F.col("type") == dependency_type).select("dependency_id", "type", "name", "parameter"),
            "dependency_id",
        )
    )


def active_mapping(mapping: DataFrame, definitions: DataFrame) -> DataFrame:
    """Mapping rows of checks that are switched on."""
    inactive = definitions.filter(~F.col("is_active")).select("check_id")
    return mapping.join(inactive, "check_id", "left_anti")


def pass_rates(status_log: DataFrame, key: str, status: str, as_of: datetime, all_hours: bool = True) -> DataFrame:
    """Pass rate per id and hour of day over the last 7 and 30 days.

    With ``all_hours`` every id gets all 24 hours and missing rates become 0.
    """
    week, month = as_of - timedelta(days=7), as_of - timedelta(days=30)
    ts = F.col("dts")
    recent = on_days(ts, week.date(), None)
    passed = F.col(status)
    rates = (
        status_log.filter(on_days(ts, month.date(), None) & F.col(key).isNotNull())
        .groupBy(key, F.hour("dts").alias("hour_of_day"))
        .agg(
            ratio(F.count_if(recent & passed), F.count(F.when(recent, passed))).alias("pass_rate_last_7_days"),
            ratio(F.count_if(passed), F.count(passed)).alias("pass_rate_last_30_days"),
        )
    )
    if not all_hours:
        return rates
    hours = F.explode(F.sequence(F.lit(0), F.lit(23))).alias("hour_of_day")
    grid = rates.select(key).distinct().select(key, hours)
    return grid.join(rates, [key, "hour_of_day"], "left").fillna(
        0.0, ["pass_rate_last_7_days", "pass_rate_last_30_days"]
    )


# --- run log -----------------------------------------------------------------

REPORT, WORKFLOW = "Report", "Workflow"
# fixed values: refresh states and the text they are shown as
REPORT_STATES = {"Unknown": "Refreshing", "Completed": "Refresh Successful", "Failed": "Refresh Failed"}
WORKFLOW_SCHEMA = "run_id string, state string, start_time long, end_time long, error_message string"
REPORT_SCHEMA = (
    "refresh_id string, refresh_status string, refresh_start_time string, refresh_end_time string, "
    "error_message string, refresh_duration_in_seconds double"
)


def run_succeeded_in_schedule(status: Column, schedule: Column, start: Column, now: datetime) -> Column:
    """Whether the latest run finished and falls in the current schedule slot; a finished run of an unknown schedule raises."""
    finished = status.isin("Refresh Successful", "Run Completed")
    today = F.lit(now.date())
    same_half = (F.hour(start) <= 12) == F.lit(now.hour <= 12)
    in_slot = first_match(
        [
            (schedule == "Daily", F.to_date(start) == today),
            (schedule == "Weekly", F.datediff(today, F.to_date(start)) < 7),
            (schedule == "Twice Daily", same_half),
            (schedule == "", F.lit(False)),
        ],
        F.raise_error(F.concat(F.lit("unexpected schedule type: "), F.coalesce(schedule, F.lit("none")))).cast("boolean"),
    )
    return F.coalesce(F.when(finished & start.isNotNull(), in_slot), F.lit(False))


def run_log(info: DataFrame, definitions: DataFrame, now: datetime) -> DataFrame:
    """Latest info JSON per dependency, flattened, with status text, duration and schedule flag."""
    latest = latest_per_key(info, ["dependency_id"], "dts").join(
        definitions.select("dependency_id", "type", "name", "parameter"), "dependency_id"
    )
    report = F.from_json("info", REPORT_SCHEMA)
    workflow = F.from_json("info", WORKFLOW_SCHEMA)
    parsed = latest.withColumn("_r", report).withColumn("_w", workflow)
    is_report = F.col("type") == REPORT
    report_status = first_match(
        [(F.col("_r.refresh_status") == k, v) for k, v in REPORT_STATES.items()], F.col("_r.refresh_status")
    )
    result_state = F.get_json_object("_w.state", "$.result_state")
    life_state = F.get_json_object("_w.state", "$.life_cycle_state")
    workflow_status = first_match(
        [
            (F.col("_w.state").isNull(), "Never Run"),
            ((life_state == "TERMINATED") & (result_state == "SUCCESS"), "Run Completed"),
            (life_state == "TERMINATED", "Run Failed"),
        ],
        "Running",
    )

    def instant(ms: str) -> Column:
        return F.when(F.col(ms) > 0, F.timestamp_millis(F.col(ms)))

    seconds = F.when(F.col("_w.end_time") != 0, (F.col("_w.end_time") - F.col("_w.start_time")) / F.lit(1000.0))
    flat = parsed.select(
        "dependency_id",
        "dts",
        "type",
        "name",
        F.get_json_object("parameter", "$['schedule type']").alias("schedule"),
        F.when(is_report, F.col("_r.refresh_id")).otherwise(F.col("_w.run_id")).alias("workflow_id"),
        F.when(is_report, report_status).otherwise(workflow_status).alias("status"),
        F.when(is_report, F.col("_r.refresh_start_time").try_cast("timestamp"))
        .otherwise(instant("_w.start_time"))
        .alias("start_time"),
        F.when(is_report, F.col("_r.refresh_end_time").try_cast("timestamp"))
        .otherwise(instant("_w.end_time"))
        .alias("end_time"),
        F.when(is_report, F.col("_r.refresh_duration_in_seconds")).otherwise(seconds).alias("duration_in_seconds"),
        F.when(is_report, F.col("_r.error_message")).otherwise(F.col("_w.error_message")).alias("error_message"),
    )
    return flat.withColumn(
        "run_status_flag",
        run_succeeded_in_schedule(F.col("status"), F.col("schedule"), F.col("start_time"), now),
    )


RUN_LOG_KEYS = ("dependency_id", "type", "workflow_id", "status", "start_time")


# --- schedule decision -------------------------------------------------------

HALF_DAY_CUTOFF_HOUR = 13


def run_required(schedule: Column, last_run: Column, last_ok: Column, now: datetime) -> Column:
    """Whether a workflow is due: failed, never run, or not yet run in its slot.

    A schedule other than 'Daily', 'Twice Daily' and '' (none) is an error.
    """
    unexpected = F.raise_error(F.concat(F.lit("unexpected schedule type "), schedule)).cast("boolean")
    ran_today = F.to_date(last_run) == F.lit(now.date())
    same_half = (F.hour(last_run) < HALF_DAY_CUTOFF_HOUR) == F.lit(now.hour < HALF_DAY_CUTOFF_HOUR)
    due = first_match(
        [
            (schedule == "Daily", ~ran_today),
            (schedule == "Twice Daily", ~(ran_today & same_half)),
            (schedule.isNull() | (schedule == ""), True),
        ],
        unexpected,
    )
    return first_match([(~F.coalesce(last_ok, F.lit(True)), True), (last_run.isNull(), True)], due)
