"""Table maintenance and data-quality queries."""

from __future__ import annotations

import re
from datetime import date, datetime, timedelta
from uuid import uuid4

from pyspark.sql import functions as F

from rolebook.oracle import A, E, LAUNCH, day, oracle
from rolebook.queries_activity import active_earners, activity_time_series, nursery_time_series
from rolebook.registry import ORACLES, Bound, query
from rolebook.roles import AS_OF, EVENTS_AS_OF, SCHEME
from stampbook.dq import checks, metrics, rollup
from stampbook.dq.registry import CHECKS, check
from stampbook.plans import activity, crm, jobs
from stampbook.sources import PeriodTable, append_rows, applied, delete_where, incremental_start, row_changes, shared_folder, sync_replace, upsert
from stampbook.streaming import daily_activity

# --- table maintenance: a target as of an older load, and the newest slice ---

OLD = date(2001, 5, 1)
_DAILY_SQL = "SELECT visit_dt AS full_date, chnl_nm, COUNT(*) AS num, CAST(SUM(sale_amt_inc_vat) AS DOUBLE) AS sales FROM scans"


def _daily(rows):
    return rows.groupBy(F.col("visit_dt").alias("full_date"), "chnl_nm").agg(
        F.count(F.lit(1)).alias("num"), F.sum("sale_amt_inc_vat").cast("double").alias("sales")
    )


def _target(r: Bound):
    """Day x channel totals up to a little after OLD, whose last month was loaded half way."""
    partial = r.scans.filter((F.col("visit_dt") < F.lit(OLD)) | ((F.col("visit_dt") < F.lit(OLD + timedelta(days=30))) & (F.col("reg_nbr") < 4)))
    return _daily(partial)


_TARGET_SQL = f"{_DAILY_SQL} WHERE visit_dt < DATE '{OLD}' OR (visit_dt < DATE '{OLD}' + 30 AND reg_nbr < 4) GROUP BY 1, 2"


@query("upsert_daily", f"{_DAILY_SQL} GROUP BY 1, 2")
def upsert_daily(r: Bound):
    newest = _daily(r.scans.filter(F.col("visit_dt") >= F.lit(OLD)))
    return upsert(_target(r), newest, ["full_date", "chnl_nm"])


@query(
    "upsert_single_key",
    """, m AS (SELECT wallet_id, MAX(sale_amt_inc_vat) AS best, COUNT(*) AS n FROM scans GROUP BY 1)
    SELECT a.wallet_id, CASE WHEN n IS NULL THEN CAST(curr_cash_bnk_pnts_qty AS DOUBLE) ELSE CAST(best AS DOUBLE) END AS best
    FROM accounts a LEFT JOIN (SELECT * FROM m WHERE n > 9) m ON m.wallet_id = a.wallet_id""",
)
def upsert_single_key(r: Bound):
    target = r.accounts.select("wallet_id", F.col("curr_cash_bnk_pnts_qty").cast("double").alias("best"))
    busy = r.scans.groupBy("wallet_id").agg(
        F.max("sale_amt_inc_vat").cast("double").alias("best"), F.count(F.lit(1)).alias("n")
    )
    return upsert(target, busy.filter("n > 9"), ["wallet_id"])


@query("sync_replace", f"{_DAILY_SQL} WHERE visit_dt >= DATE '{OLD}' GROUP BY 1, 2")
def sync(r: Bound):
    return sync_replace(_target(r), _daily(r.scans.filter(F.col("visit_dt") >= F.lit(OLD))))


@query("delete_where", f"SELECT * FROM ({_TARGET_SQL}) WHERE NOT (num < 2)")
def delete_small(r: Bound):
    return delete_where(_target(r), F.col("num") < 2)


@query("append_rows", f"{_TARGET_SQL} UNION ALL {_DAILY_SQL} WHERE visit_dt >= DATE '{OLD}' GROUP BY 1, 2")
def append(r: Bound):
    return append_rows(_target(r), _daily(r.scans.filter(F.col("visit_dt") >= F.lit(OLD))))


@query("archive_load", "SELECT * FROM archive")
def archive_load(r: Bound):
    current = r.accounts.select("wallet_id", "status_id_last_upd_ts")
    return sync_replace(current, r.archive)


@query(
    "daily_activity",
    "SELECT visit_dt AS full_date, chnl_nm, COUNT(*) AS num_transactions, CAST(SUM(sale_amt_inc_vat) AS BIGINT) AS sales FROM scans GROUP BY 1, 2",
)
def daily_activity_batch(r: Bound):
    return daily_activity(r.scans.withColumn("event_ts", F.col("event_ts").cast("timestamp")))


@query("dedup_rewrite", "SELECT DISTINCT wallet_id, visit_dt AS full_date FROM scans")
def dedup(r: Bound):
    return r.scans.select("wallet_id", F.col("visit_dt").alias("full_date")).dropDuplicates(["wallet_id", "full_date"])


@query(
    "journey_prune",
    """, g AS (SELECT eventdate AS journey_date, campaignname AS journey_name, sendtype AS groups, COUNT(DISTINCT walletid) AS customers
      FROM sends GROUP BY 1, 2, 3), k AS (SELECT * FROM g WHERE customers >= 12)
    SELECT * FROM k WHERE journey_name NOT IN (SELECT journey_name FROM k GROUP BY journey_name, journey_date HAVING COUNT(DISTINCT groups) <> 2)""",
)
def journey_prune(r: Bound):
    groups = r.sends.groupBy(
        F.col("eventdate").alias("journey_date"),
        F.col("campaignname").alias("journey_name"),
        F.col("sendtype").alias("groups"),
    ).agg(F.countDistinct("walletid").alias("customers"))
    return crm.prune_journeys(groups, min_customers=12)


@query(
    "incremental_window",
    f""", t AS (SELECT DISTINCT full_date FROM ({_TARGET_SQL})),
    g AS (SELECT COUNT(*) AS n FROM calendar WHERE day_date BETWEEN {LAUNCH} AND {A} - 31 AND day_date NOT IN (SELECT full_date FROM t))
    SELECT CASE WHEN n > 0 THEN {LAUNCH} ELSE {A} - 30 END AS load_from, CASE WHEN n > 0 THEN 'full' ELSE 'incremental' END AS mode FROM g""",
)
def incremental_window(r: Bound):
    return incremental_start(_target(r), r.calendar, AS_OF, SCHEME.launch)


@query(
    "row_count_monitor",
    f"""SELECT 'spark_catalog' AS table_catalog, 'default' AS table_schema, 'orders' AS table_name, CAST(NULL AS VARCHAR) AS table_filter,
      COUNT(*) AS row_count, TIMESTAMP '2001-08-02 06:00:00' AS checked_at, FALSE AS failed FROM orders
    UNION ALL SELECT 'spark_catalog', 'default', 'lineitem', 'l_quantity > 10', COUNT(*), TIMESTAMP '2001-08-02 06:00:00', FALSE FROM lineitem WHERE l_quantity > 10
    UNION ALL SELECT 'spark_catalog', 'default', 'events', 'no_such_column = 1', NULL, TIMESTAMP '2001-08-02 06:00:00', TRUE FROM (SELECT 1)
    UNION ALL SELECT 'spark_catalog', 'default', 'missing', NULL, NULL, TIMESTAMP '2001-08-02 06:00:00', TRUE FROM (SELECT 1)""",
)
def row_count_monitor(r: Bound):
    names = ("orders", "lineitem", "events", "missing")
    counts = jobs.row_count_monitor(
        r.spark,
        {n: (lambda n=n: r.table(n)) for n in names},
        datetime(2001, 8, 2, 6),
        {"lineitem": "l_quantity > 10", "events": "no_such_column = 1"},
    )
    # the error text differs between engines and paths; the flag is compared
    return counts.withColumn("failed", F.col("error").isNotNull()).drop("error")


_MONITORED = {"orders": "SELECT * FROM {t}", "customer": "SELECT * FROM {t}", "part": "SELECT * FROM {t} WHERE p_size > 10", "lineitem": "SELECT * FROM {t} WHERE raise_error('cannot be read') IS NULL"}


@query(
    "row_count_catalog",
    """SELECT 'spark_catalog' AS table_catalog, 'default' AS table_schema, 'monitored_orders' AS table_name, CAST(NULL AS VARCHAR) AS table_filter,
      COUNT(*) AS row_count, TIMESTAMP '2001-08-02 06:00:00' AS checked_at, FALSE AS failed FROM orders
    UNION ALL SELECT 'spark_catalog', 'default', 'monitored_customer', 'c_acctbal > 100', COUNT(*), TIMESTAMP '2001-08-02 06:00:00', FALSE FROM customer WHERE c_acctbal > 100
    UNION ALL SELECT 'spark_catalog', 'default', 'monitored_part', NULL, COUNT(*), TIMESTAMP '2001-08-02 06:00:00', FALSE FROM part WHERE p_size > 10
    UNION ALL SELECT 'spark_catalog', 'default', 'monitored_lineitem', NULL, NULL, TIMESTAMP '2001-08-02 06:00:00', TRUE FROM (SELECT 1)""",
)
def row_count_catalog(r: Bound):
    """Of what the catalog lists, one view fails only when it is read."""
    for name, sql in _MONITORED.items():
        r.spark.sql(sql.format(t="{t}"), t=r.table(name)).createOrReplaceTempView(f"monitored_{name}")
    counts = jobs.catalog_row_counts(r.spark, "default", datetime(2001, 8, 2, 6), {"monitored_customer": "c_acctbal > 100"}, "monitored_*")
    return counts.withColumn("failed", F.col("error").isNotNull()).drop("error")


# --- definitions and mappings follow their source as row changes ---

_OLD_MAPPING = "SELECT check_id, dependency_id, CASE WHEN check_id % 5 = 0 THEN 'Old' ELSE severity END AS severity FROM check_mapping WHERE check_id % 7 <> 3"
_NEW_MAPPING = "SELECT check_id, dependency_id, severity FROM check_mapping WHERE check_id % 11 <> 4"
_CHANGES = f"""SELECT COALESCE(n.check_id, o.check_id) AS check_id, COALESCE(n.dependency_id, o.dependency_id) AS dependency_id,
    CASE WHEN n.check_id IS NULL THEN o.severity ELSE n.severity END AS severity,
    CASE WHEN o.check_id IS NULL THEN 'insert' WHEN n.check_id IS NULL THEN 'delete' ELSE 'update' END AS change
    FROM ({_NEW_MAPPING}) n FULL JOIN ({_OLD_MAPPING}) o ON n.check_id = o.check_id AND n.dependency_id = o.dependency_id
    WHERE o.check_id IS NULL OR n.check_id IS NULL OR n.severity <> o.severity"""


def _mapping_changes(r: Bound):
    return row_changes(r.select(_OLD_MAPPING), r.select(_NEW_MAPPING), ["check_id", "dependency_id"])


@query("dq_mapping_changes", _CHANGES)
def dq_mapping_changes(r: Bound):
    return _mapping_changes(r)


@query("dq_mapping_sync", _NEW_MAPPING)
def dq_mapping_sync(r: Bound):
    return applied(r.select(_OLD_MAPPING), _mapping_changes(r), ["check_id", "dependency_id"])


# --- the log of checks and their history, as a run leaves them ---

_LOGGED = (5, 14, 29, 67)


@query("dq_check_log")
def dq_check_log(r: Bound):
    """Two runs: the failed rows that each writes first are replaced by its results."""
    log = PeriodTable(r.spark, f"{shared_folder(r.spark)}/tables/check_log-{uuid4().hex}", "dts", "month")
    history = PeriodTable(r.spark, f"{shared_folder(r.spark)}/tables/history-{uuid4().hex}", "dts", "month")
    tables = {name: r.select(CHECK_TABLES[name]) for name in ("credits", "account_archive", "order_items", "visits")}
    for _ in range(2):
        context = checks.Context(as_of=AS_OF, history=history.read() if history.exists() else None)
        checks.record_checks(r.spark, [check(i) for i in _LOGGED], tables, context, log, "run", history)
    return log.read().drop("definition", "run_duration_seconds").withColumn("error_message", F.lit(None).cast("string"))


# --- daily counts, duplicates, history ---

CONTEXT = checks.Context(as_of=AS_OF)
DAILY = checks.DailyCount("scans", "event_ts", 40, 0.25)


@query(
    "dq_daily_counts",
    f""", d AS (SELECT visit_dt AS dt, COUNT(*) AS row_count FROM scans WHERE visit_dt > {A} - 40 GROUP BY 1)
    SELECT dt, row_count, (SELECT median(row_count) * 0.25 FROM d) AS low_count_cutoff,
      row_count >= (SELECT median(row_count) * 0.25 FROM d) AS pass_check FROM d""",
)
def dq_daily_counts(r: Bound):
    return metrics.PercentageOfMedian(0.25).flag(DAILY.daily({"scans": r.scans}, CONTEXT))


@query(
    "dq_duplicates",
    f""", x AS (SELECT wallet_id, visit_dt AS dt FROM scans WHERE visit_dt > {A} - 365 AND visit_dt < {A})
    SELECT a.dt, row_count, distinct_count, CAST(row_count AS DOUBLE) / distinct_count <= 1.001 AS pass_check
    FROM (SELECT dt, COUNT(*) AS row_count FROM x GROUP BY 1) a JOIN (SELECT dt, COUNT(*) AS distinct_count FROM (SELECT DISTINCT * FROM x) GROUP BY 1) b
      ON a.dt = b.dt""",
)
def dq_duplicates(r: Bound):
    rule = checks.Duplicates("scans", "event_ts", 365, 0.001, ("wallet_id",))
    return rule.ratios({"scans": r.scans}, CONTEXT)


_HISTORY_SQL = f""", d AS (SELECT {day('upd_ts')} AS dt, COUNT(*) AS n FROM missions WHERE {day('upd_ts')} <= {A} - 1 AND {day('event_ts')} <= {A} - 1 GROUP BY 1),
    s AS (SELECT 'mean_daily_row_count' AS history_type, AVG(n) AS value FROM d UNION ALL SELECT 'max_daily_row_count', MAX(n) FROM d
      UNION ALL SELECT 'min_daily_row_count', MIN(n) FROM d UNION ALL SELECT 'stddev_daily_row_count', stddev_samp(n) FROM d
      UNION ALL SELECT 'total_row_count', SUM(n) FROM d)"""


@query("dq_history_statistics", f"{_HISTORY_SQL} SELECT history_type, round(CAST(value AS DOUBLE), 6) AS value FROM s")
def dq_history_statistics(r: Bound):
    rule = checks.History("missions", "upd_ts", 0.01, ("event_ts",), check_id=1)
    daily = rule.daily({"missions": r.missions}, F.lit(AS_OF - timedelta(days=1)))
    return checks.history_statistics(daily).withColumn("value", F.round("value", 6))


@query(
    "dq_store_counts",
    f""", x AS (SELECT store_nbr, {day('event_ts')} AS dt, COUNT(*) AS n FROM store_days_role WHERE {day('event_ts')} > {A} - 60 AND {day('event_ts')} <= {A} - 1 GROUP BY 1, 2),
    m AS (SELECT store_nbr, median(n) * 0.5 AS c FROM x WHERE dt <> {A} - 1 GROUP BY 1)
    SELECT m.store_nbr, c AS low_count_cutoff, n AS checked_count, n > c AS passed_check FROM m LEFT JOIN x ON x.store_nbr = m.store_nbr AND x.dt = {A} - 1""",
)
def dq_store_counts(r: Bound):
    rule = checks.PerGroupCount("store_days", "event_ts", "store_nbr", 60, 0.5)
    return rule.groups({"store_days": r.store_days_role}, CONTEXT)


@query(
    "dq_store_pivot",
    f"""SELECT store_nbr, {', '.join(f"NULLIF(COUNT(*) FILTER (WHERE {day('event_ts')} = {A} - {n}), 0) AS " + '"' + str(AS_OF - timedelta(days=n)) + '"' for n in range(9, 0, -1))}
    FROM store_days_role WHERE {day('event_ts')} > {A} - 10 AND {day('event_ts')} < {A} GROUP BY store_nbr""",
)
def dq_store_pivot(r: Bound):
    rule = checks.PerGroupCount("store_days", "event_ts", "store_nbr", 10, 0.5)
    return rule.by_day({"store_days": r.store_days_role}, CONTEXT)


_ROLLING = 40
_ROLLING_SQL = f""", d AS (SELECT visit_dt AS dt, COUNT(*) AS row_count FROM scans GROUP BY 1),
    p AS (SELECT dt, row_count, row_number() OVER (ORDER BY dt DESC) AS i FROM d),
    w AS (SELECT a.dt, a.row_count, list(CAST(b.row_count AS DOUBLE)) AS v, median(b.row_count) AS med, quantile_cont(b.row_count, 0.25) AS q1,
        quantile_cont(b.row_count, 0.75) AS q3, AVG(b.row_count) AS mu, stddev_samp(b.row_count) AS sd
      FROM p a JOIN p b ON b.i BETWEEN a.i - {_ROLLING - 1} AND a.i WHERE a.i >= {_ROLLING} GROUP BY a.dt, a.row_count),
    r AS (SELECT dt, row_count, med * 0.4 AS pct_of_median, q1 * 0.4 AS pct_of_lower_quartile, mu * 0.4 AS pct_of_mean, q1 - 1.5 * (q3 - q1) AS interquartile_range,
      mu - 3 * sd AS deviations_from_mean,
      med - 3 * (SELECT median(abs(x - med)) FROM (SELECT unnest(v) AS x)) AS median_absolute_deviation FROM w)"""


@query(
    "dq_rolling_cutoffs",
    f"""{_ROLLING_SQL} SELECT dt, row_count, round(pct_of_median, 6) AS pct_of_median, round(pct_of_lower_quartile, 6) AS pct_of_lower_quartile,
    round(pct_of_mean, 6) AS pct_of_mean, round(interquartile_range, 6) AS interquartile_range, round(deviations_from_mean, 6) AS deviations_from_mean,
    round(median_absolute_deviation, 6) AS median_absolute_deviation FROM r""",
)
def dq_rolling_cutoffs(r: Bound):
    cutoffs = metrics.rolling_cutoffs(metrics.daily_counts(r.scans, F.col("visit_dt")), _ROLLING)
    return cutoffs.select("dt", "row_count", *[F.round(c, 6).alias(c) for c in metrics.CUTOFF_COLUMNS])


@query(
    "dq_rejected_share",
    f"""{_ROLLING_SQL} {' UNION ALL '.join(f"SELECT '{c}' AS metric, round(AVG(CASE WHEN row_count < {c} THEN 100.0 ELSE 0 END), 6) AS rejected_percent FROM r" for c in metrics.CUTOFF_COLUMNS)}""",
)
def dq_rejected_share(r: Bound):
    cutoffs = metrics.rolling_cutoffs(metrics.daily_counts(r.scans, F.col("visit_dt")), _ROLLING)
    return metrics.rejected_share(cutoffs).withColumn("rejected_percent", F.round("rejected_percent", 6))


# --- the numbered checks on the bound tables, in the SQL that both sides read ---

_JOBS = ("summary_activity", "crm_send_level", "key_objectives", "order_participation", "voucher_shortfall", "fuel_cross_shop",
         "opt_in_figures", "app_usage", "control_groups", "crm_monthly_online", "crm_monthly_fashion", "store_test_vs_control")
RUN_LOG = f"""SELECT CASE basket_id % {len(_JOBS)} {' '.join(f"WHEN {i} THEN '{name}'" for i, name in enumerate(_JOBS))} END AS job_name,
    CAST(visit_dt + CAST(basket_id % 2 AS INT) AS DATE) AS start_ts, reg_nbr <> 3 AS succeeded FROM scans"""
_WEEKLY = "SELECT retail_week AS week FROM scans JOIN calendar ON visit_dt + {} = day_date"
CHECK_TABLES: dict[str, str] = {
    "missions": "SELECT * FROM missions",
    "scans": "SELECT * FROM scans",
    "credits": "SELECT * FROM credits",
    "external_credits": "SELECT *, event_ts AS upd_ts FROM external_credits",
    "reward_wallets": "SELECT * FROM reward_wallets",
    "accounts": "SELECT wallet_id, src_modfd_ts AS event_ts FROM accounts",
    "campaign_versions": "SELECT * FROM campaign_versions",
    "games": "SELECT *, CAST(game_start_ts AS DATE) AS game_start_dt FROM order_games",
    "coupons": "SELECT *, event_ts AS load_ts, CASE WHEN coupn_redm_ts IS NULL THEN 'OPEN' ELSE 'USED' END AS coupn_status_desc FROM coupons",
    "account_archive": "SELECT * FROM archive",
    "consent_accounts": "SELECT * FROM accounts",
    "customers": "SELECT regtn_ts AS ingest_ts FROM accounts",
    "order_promos": "SELECT order_id, upd_ts AS src_modfd_ts FROM refunds",
    "refunds": "SELECT *, upd_ts AS src_create_ts FROM refunds",
    "app_usage": """SELECT CAST(year(visit_dt) * 10000 + month(visit_dt) * 100 + day(visit_dt) AS STRING) AS date, COUNT(DISTINCT wallet_id) AS activeUsers
        FROM scans GROUP BY visit_dt""",
    "orders": "SELECT * FROM online_orders",
    "fashion_orders": "SELECT *, CASE WHEN sum_order_quantity > 2 THEN 'Y' ELSE 'N' END AS order_complete FROM fashion_orders",
    "order_items": "SELECT * FROM order_promos",
    "fuel_lines": "SELECT visit_dt, '4582' AS store_nbr, upc_nbr, wallet_id FROM fuel_lines",
    "fuel_visit_level": "SELECT '4582' AS store_nbr, visit_dt, reg_nbr AS earn, sale_amt_inc_vat AS ar_sales FROM scans",
    "store_visits": "SELECT * FROM store_visits",
    "supplier_bill": "SELECT * FROM supplier_bill",
    "scans_domain": "SELECT * FROM scans WHERE chnl_nm <> 'pfs' OR reg_nbr > 1",
    "items": "SELECT CAST(visit_dt + 1 AS TIMESTAMP) AS load_ts FROM scans",
    "basket_items": "SELECT *, CAST(visit_dt AS TIMESTAMP) AS visit_ts FROM basket_items",
    "campaign_products": "SELECT event_ts AS load_ts FROM scans",
    "visits": "SELECT * FROM scans",
    "visit_history": "SELECT * FROM scans",
    "customer_summary": "SELECT visit_dt AS week_end_dt FROM scans",
    "rewards_burn": "SELECT visit_dt AS burn_dt FROM scans",
    "last_week_helper": "SELECT day_date FROM calendar",
    "week_finder": "SELECT retail_week AS week, MIN(day_date) AS week_start_day, MAX(day_date) AS week_end_day FROM calendar GROUP BY retail_week",
    "earning": "SELECT * FROM missions",
    "attributes": "SELECT region FROM store_regions WHERE region = 'nowhere'",
    "campaign_setup_copy": "SELECT load_ts FROM campaign_versions",
    "weekly_customer_summary": _WEEKLY.format(0),
    "weekly_segment_summary": _WEEKLY.format(-7),
    "weekly_reward_summary": _WEEKLY.format(-21),
    "weekly_channel_summary": _WEEKLY.format(7),
    "store_visit_flags": "SELECT * FROM store_visits",
    "tracker": "SELECT CAST(event_ts AS DATE) AS dt FROM missions",
    "date_hierarchy": "SELECT day_date FROM calendar",
    "store_sales": "SELECT * FROM scans",
    "earning_completions": "SELECT visit_dt - 1 AS cmplt_dt FROM scans",
    "accounts_domain": "SELECT wallet_id, src_modfd_ts AS event_ts FROM accounts",
}
_SERIES_TABLES = {"activity_time_series": activity_time_series, "nursery_time_series": nursery_time_series, "active_earners": active_earners}
HISTORY_DAY = AS_OF - timedelta(days=30)  # the snapshots describe the day before
# what was recorded: near the counts, far from them, or with another type; the other checks have no snapshot
_NEAR, _FAR, _OTHER = (1, 2, 5, 6, 9, 13, 35), (3, 4, 11, 19, 37), (12, 23)


def _sql_tables(r: Bound) -> dict:
    return {name: r.select(sql) for name, sql in CHECK_TABLES.items()} | {name: build(r) for name, build in _SERIES_TABLES.items()}


def _history_log(r: Bound, tables: dict):
    """Snapshots taken a month ago, some of them changed since, older ones that they replace, and later ones."""
    context = checks.Context(as_of=HISTORY_DAY)
    rules = [x for spec in CHECKS for x in spec.rules if isinstance(x, checks.History) and spec.check_id in (*_NEAR, *_FAR, *_OTHER)]
    taken = checks.snapshots(rules, tables, context).filter(~(F.col("check_id").isin(*_OTHER) & (F.col("history_type") == "max_daily_row_count")))
    factor = F.when(F.col("check_id").isin(*_FAR), 1.9).otherwise(1.0002)
    value = (F.col("historical_value").cast("double") * factor).cast("string")

    def row(dts, value):
        return F.struct(value.alias("historical_value"), dts.alias("dts"))

    older, later = F.col("dts") - F.expr("INTERVAL 9 DAYS"), F.lit(AS_OF + timedelta(days=3)).cast("timestamp")
    each = F.inline(F.array(row(F.col("dts"), value), row(older, F.lit("-1")), row(later, F.lit("-2"))))
    return taken.select("check_id", "history_type", each)


def _source(table: str) -> str:
    return f"({CHECK_TABLES[table]})" if table in CHECK_TABLES else f"({ORACLES[table]})"


def _count_sql(rule: checks.DailyCount) -> str:
    d = f"CAST({rule.day} AS DATE)" if not rule.day_format else f"CAST(strptime({rule.day}, '%Y%m%d') AS DATE)"
    value = re.sub("bigint", "BIGINT", rule.value or "COUNT(*)")
    return f"""COALESCE((SELECT bool_or(dt = DATE '{rule.checked_day(CONTEXT)}' AND n >= c) FROM (SELECT {d} AS dt, {value} AS n, median({value}) OVER () * {rule.tolerance} AS c
      FROM {_source(rule.table)} WHERE {d} > {A} - {rule.window} AND {d} <= {A} AND ({rule.where or 'TRUE'}) GROUP BY 1)), FALSE)"""


def _duplicates_sql(rule: checks.Duplicates) -> str:
    d = day(rule.day)
    rows = f"(SELECT *, {d} AS _d FROM {_source(rule.table)} WHERE {d} > {A} - {rule.scope} AND {d} < {A} AND ({rule.where or 'TRUE'}))"
    columns = ", ".join(rule.distinct_on) if rule.distinct_on else "*"
    return f"""COALESCE((SELECT bool_and(CAST(n AS DOUBLE) / u <= {1 + rule.tolerance}) FROM (SELECT _d, COUNT(*) AS n FROM {rows} GROUP BY 1) x
      JOIN (SELECT _d, COUNT(*) AS u FROM (SELECT DISTINCT _d, {columns} FROM {rows}) GROUP BY 1) y USING (_d)), TRUE)"""


def _now_sql(rule: checks.History) -> str:
    """The rule's five statistics, as they are now of the days that the snapshot describes, as history_type and value."""
    until = f"DATE '{HISTORY_DAY - timedelta(days=1)}'"
    rows = f"{_source(rule.table)} WHERE ({rule.where or 'TRUE'})"
    if rule.first_per:
        rows = f"(SELECT * FROM {rows} QUALIFY row_number() OVER (PARTITION BY {', '.join(rule.first_per)} ORDER BY {rule.by}) = 1) WHERE TRUE"
    limits = " ".join(f"AND {day(c)} <= {until}" for c in (rule.by, *rule.up_to))
    names = [("mean", "AVG(n)"), ("max", "MAX(n)"), ("min", "MIN(n)"), ("stddev", "stddev_samp(n)")]
    parts = [f"SELECT '{a}_daily_row_count' AS history_type, CAST({f} AS DOUBLE) AS value FROM d" for a, f in names]
    return f"""WITH d AS (SELECT {day(rule.by)} AS dt, COUNT(*) AS n FROM {rows} {limits} GROUP BY 1)
      SELECT * FROM ({' UNION ALL '.join(parts)} UNION ALL SELECT 'total_row_count', CAST(SUM(n) AS DOUBLE) FROM d) WHERE value IS NOT NULL"""


def _compared_sql(rule: checks.History) -> str:
    """history_type, value, reference: both sides of the comparison."""
    factor = 1.9 if rule.check_id in _FAR else 1.0002
    gone = "history_type <> 'max_daily_row_count'" if rule.check_id in _OTHER else "TRUE"
    return f"""WITH now_ AS ({_now_sql(rule)}), then_ AS (SELECT history_type, value * {factor} AS reference FROM now_ WHERE {gone})
      SELECT history_type, value, reference FROM now_ FULL JOIN then_ USING (history_type)"""


def _history_sql(rule: checks.History) -> str:
    if rule.check_id not in (*_NEAR, *_FAR, *_OTHER):
        return f"(SELECT COUNT(*) >= 0 FROM {_source(rule.table)})"  # no snapshot, so nothing to compare with
    low, high = f"reference * {1 - rule.tolerance}", f"reference * {1 + rule.tolerance}"
    return f"COALESCE((SELECT bool_and(COALESCE(value > {low} AND value < {high}, FALSE)) FROM ({_compared_sql(rule)})), TRUE)"  # no row at all: nothing was recorded


def _newest_sql(rule: checks.Newest) -> str:
    newest = f"(SELECT MAX({day(rule.day)}) FROM {_source(rule.table)} WHERE ({rule.where or 'TRUE'}))"
    if rule.mode == "since_last_friday":
        return f"COALESCE({newest} >= DATE '{activity.saturday_after_last_friday(AS_OF) - timedelta(days=1)}', FALSE)"
    return f"COALESCE({newest} IN ({', '.join(f'{A} - {lag}' for lag in rule.lags)}), FALSE)"


def _week_sql(rule: checks.WeekLoaded) -> str:
    expected = f"(SELECT MAX(week) FROM {_source(rule.finder)} WHERE week_start_day < {A} - 7 AND week_end_day > {A} - 7)"
    return f"COALESCE((SELECT MAX({rule.week}) FROM {_source(rule.table)}) = {expected}, FALSE)"


def _ratio_sql(rule: checks.RatioAgainstMedian) -> str:
    d = day(rule.day)
    return f"""COALESCE((SELECT MAX(q) FILTER (WHERE d = {A} - 1) >= {rule.tolerance} * median(q) FILTER (WHERE d < {A} - 1) FROM (SELECT {d} AS d,
        SUM({rule.numerator}) * 100.0 / NULLIF(SUM({rule.denominator}), 0) AS q FROM {_source(rule.table)} WHERE {d} > {A} - {rule.window} AND ({rule.where or 'TRUE'}) GROUP BY 1)), FALSE)"""


def _per_group_sql(rule: checks.PerGroupCount) -> str:
    d = day(rule.day)
    return f"""(SELECT COUNT(*) = 0 FROM (SELECT g, MAX(CASE WHEN d = {A} - 1 THEN n END) AS n1, median(CASE WHEN d <> {A} - 1 THEN n END) * {rule.tolerance} AS c
      FROM (SELECT {rule.group} AS g, {d} AS d, COUNT(*) AS n FROM {_source(rule.table)} WHERE {d} > {A} - {rule.window} AND {d} < {A} GROUP BY 1, 2) GROUP BY 1) WHERE NOT n1 > c)"""


def _iso_week_sql(rule: checks.RecentIsoWeek) -> str:
    newest = f"(SELECT date_trunc('week', MAX({rule.day})) FROM {_source(rule.table)})"
    return f"COALESCE({newest} IN (date_trunc('week', {A}), date_trunc('week', {A} - 7)), FALSE)"


_RULE_SQL = {
    checks.DailyCount: _count_sql,
    checks.Duplicates: _duplicates_sql,
    checks.History: _history_sql,
    checks.Newest: _newest_sql,
    checks.RanToday: lambda rule: f"COALESCE((SELECT MAX(start_ts) = {A} FROM ({RUN_LOG}) WHERE succeeded AND job_name = '{rule.job}'), FALSE)",
    checks.HasRows: lambda rule: f"(SELECT COUNT(*) >= {rule.minimum} FROM {_source(rule.table)} WHERE ({rule.where or 'TRUE'}))",
    checks.RecentIsoWeek: _iso_week_sql,
    checks.WeekLoaded: _week_sql,
    checks.PerGroupCount: _per_group_sql,
    checks.RatioAgainstMedian: _ratio_sql,
}


def _status_sql(spec: checks.CheckSpec) -> str:
    return f"SELECT {spec.check_id} AS check_id, {' AND '.join(_RULE_SQL[type(rule)](rule) for rule in spec.rules)} AS status"


ORACLES["dq_check_log"] = oracle(
    "\nUNION ALL ".join(
        f"""SELECT check_id, status, CAST(NULL AS VARCHAR) AS error_message, TIMESTAMP '{AS_OF} 06:00:00' AS dts, 'run' AS run_url
        FROM ({_status_sql(check(i))})"""
        for i in _LOGGED
    )
)


@query("dq_check_results", "\nUNION ALL ".join(map(_status_sql, CHECKS)))
def dq_check_results(r: Bound):
    """All 69 checks in one run."""
    tables = _sql_tables(r)
    # a history is a recorded table: it is made once, at most three rows a check and type, and not again by each rule that reads it
    log = _history_log(r, tables)
    history = r.spark.createDataFrame(log.collect(), log.schema)
    context = checks.Context(as_of=AS_OF, run_log=r.select(RUN_LOG), history=history)
    return checks.run_checks(r.spark, CHECKS, tables, context).select("check_id", "status")


_HISTORY_RULES = [x for spec in CHECKS for x in spec.rules if isinstance(x, checks.History) and spec.check_id in (*_NEAR, *_FAR, *_OTHER)]


@query(
    "dq_history_compare",
    "\nUNION ALL ".join(
        f"""SELECT {x.check_id} AS check_id, history_type, round(value, 6) AS value, round(reference, 4) AS reference,
        COALESCE(value > reference * {1 - x.tolerance} AND value < reference * {1 + x.tolerance}, FALSE) AS inside FROM ({_compared_sql(x)})"""
        for x in _HISTORY_RULES
    ),
)
def dq_history_compare(r: Bound):
    """Every type of every check with a snapshot, near it, far from it, or missing on one side."""
    tables = _sql_tables(r)
    context = checks.Context(as_of=AS_OF, history=_history_log(r, tables))
    found = checks.history_values(CHECKS, tables, context)
    inside = checks.within_tolerance(F.col("value"), F.col("reference"), F.col("tolerance"))
    return found.select(
        "check_id", "history_type", F.round("value", 6).alias("value"), F.round("reference", 4).alias("reference"), F.coalesce(inside, F.lit(False)).alias("inside")
    )


# --- roll-up, pass rates, run log, schedules ---

_LATEST = "SELECT * FROM (SELECT *, rank() OVER (PARTITION BY check_id ORDER BY dts DESC) AS k FROM check_log) WHERE k = 1"
_ROLLUP = f"""SELECT l.check_id, l.definition AS check_definition, severity, d.dependency_id, d.type AS dependency_type, d.name AS dependency_name, dts, status,
    d.dependency_id NOT IN (SELECT m2.dependency_id FROM ({_LATEST}) l2 JOIN check_mapping m2 ON m2.check_id = l2.check_id
      WHERE NOT l2.status AND m2.severity = 'High') AS overall_status
    FROM ({_LATEST}) l JOIN check_mapping m ON m.check_id = l.check_id JOIN dependency_definitions d ON d.dependency_id = m.dependency_id"""


def _statuses(r: Bound):
    return rollup.dependency_status(r.check_log, r.check_mapping, r.dependency_definitions)


@query("dq_dependency_status", _ROLLUP)
def dq_dependency_status(r: Bound):
    return _statuses(r)


@query(
    "dq_dependency_log",
    f"SELECT DISTINCT dependency_id, dependency_name, dependency_type, overall_status FROM ({_ROLLUP})",
)
def dq_dependency_log(r: Bound):
    return rollup.dependency_status_log(_statuses(r))


@query(
    "dq_ready_dependencies",
    f"""SELECT DISTINCT x.dependency_id, overall_status, dts, type, name, parameter FROM (SELECT dependency_id, bool_and(overall_status) AS overall_status,
      MAX(dts) AS dts FROM ({_ROLLUP}) GROUP BY 1) x JOIN dependency_definitions d ON d.dependency_id = x.dependency_id
    WHERE type = 'Workflow' AND NOT overall_status""",
)
def dq_ready_dependencies(r: Bound):
    log = _statuses(r).groupBy("dependency_id").agg(
        F.bool_and("overall_status").alias("overall_status"), F.max("dts").alias("dts")
    )
    return rollup.ready_dependencies(log, r.dependency_definitions, "Workflow", ready=False)


@query(
    "dq_latest_today",
    f"""SELECT check_id, definition, status, dts, event_id FROM (SELECT *, row_number() OVER (PARTITION BY check_id ORDER BY dts DESC) AS k FROM check_log
      WHERE {day('dts')} = {E} - 1) WHERE k = 1""",
)
def dq_latest_today(r: Bound):
    return rollup.latest_check_status(r.check_log, EVENTS_AS_OF - timedelta(days=1))


@query(
    "dq_active_mapping",
    "SELECT * FROM check_mapping WHERE check_id NOT IN (SELECT check_id FROM check_log GROUP BY check_id HAVING MIN(CASE WHEN status THEN 1 ELSE 0 END) = 0 AND COUNT(*) < 140)",
)
def dq_active_mapping(r: Bound):
    definitions = r.check_log.groupBy("check_id").agg(
        (F.bool_and("status") | (F.count(F.lit(1)) >= 140)).alias("is_active")
    )
    return rollup.active_mapping(r.check_mapping, definitions)


def _rates_sql(source: str, key: str, status: str, filled: bool) -> str:
    rates = f"""SELECT {key}, CAST(hour(dts) AS INT) AS hour_of_day,
      CAST(COUNT(*) FILTER (WHERE {status} AND {day('dts')} >= {E} - 7) AS DOUBLE) / NULLIF(COUNT({status}) FILTER (WHERE {day('dts')} >= {E} - 7), 0) AS w,
      CAST(COUNT(*) FILTER (WHERE {status}) AS DOUBLE) / COUNT({status}) AS m FROM {source} WHERE {day('dts')} >= {E} - 30 GROUP BY 1, 2"""
    if not filled:
        return f"SELECT {key}, hour_of_day, w AS pass_rate_last_7_days, m AS pass_rate_last_30_days FROM ({rates})"
    return f""", r AS ({rates}) SELECT g.{key}, g.hour_of_day, COALESCE(w, 0) AS pass_rate_last_7_days, COALESCE(m, 0) AS pass_rate_last_30_days
    FROM (SELECT {key}, CAST(h AS INT) AS hour_of_day FROM (SELECT DISTINCT {key} FROM r), range(24) AS t(h)) g
    LEFT JOIN r ON r.{key} = g.{key} AND r.hour_of_day = g.hour_of_day"""


_NOW = datetime(2024, 1, 31, 6)


@query("dq_pass_rates", _rates_sql("check_log", "check_id", "status", False))
def dq_pass_rates(r: Bound):
    return rollup.pass_rates(r.check_log, "check_id", "status", _NOW, all_hours=False)


@query("dq_pass_rates_filled", _rates_sql("check_log", "check_id", "status", True))
def dq_pass_rates_filled(r: Bound):
    return rollup.pass_rates(r.check_log, "check_id", "status", _NOW)


@query("dq_dependency_pass_rates", _rates_sql("(SELECT dependency_id, dts, status FROM check_log l JOIN check_mapping m ON m.check_id = l.check_id)", "dependency_id", "status", True))
def dq_dependency_pass_rates(r: Bound):
    log = r.check_log.join(r.check_mapping.select("check_id", "dependency_id"), "check_id")
    return rollup.pass_rates(log, "dependency_id", "status", _NOW)


_RUN_LOG_SQL = """, l AS (SELECT * FROM (SELECT i.*, d.type, d.name, d.parameter, row_number() OVER (PARTITION BY i.dependency_id ORDER BY dts DESC) AS k
      FROM dependency_info i JOIN dependency_definitions d ON d.dependency_id = i.dependency_id) WHERE k = 1),
    f AS (SELECT dependency_id, dts, type, name, json_extract_string(parameter, '$."schedule type"') AS schedule,
      CASE type WHEN 'Report' THEN json_extract_string(info, '$.refresh_id') ELSE json_extract_string(info, '$.run_id') END AS workflow_id,
      CASE WHEN type = 'Report' THEN CASE json_extract_string(info, '$.refresh_status') WHEN 'Completed' THEN 'Refresh Successful' WHEN 'Failed' THEN 'Refresh Failed'
          WHEN 'Unknown' THEN 'Refreshing' END
        WHEN json_extract_string(info, '$.state.result_state') = 'SUCCESS' THEN 'Run Completed' ELSE 'Run Failed' END AS status,
      CASE type WHEN 'Report' THEN CAST(json_extract_string(info, '$.refresh_start_time') AS TIMESTAMP)
        ELSE make_timestamp(CAST(json_extract_string(info, '$.start_time') AS BIGINT) * 1000) END AS start_time,
      CASE type WHEN 'Report' THEN CAST(json_extract_string(info, '$.refresh_end_time') AS TIMESTAMP)
        ELSE make_timestamp(CAST(json_extract_string(info, '$.end_time') AS BIGINT) * 1000) END AS end_time,
      CAST(CASE type WHEN 'Report' THEN 600.0 ELSE 60.5 END AS DOUBLE) AS duration_in_seconds, CAST(NULL AS VARCHAR) AS error_message FROM l)
    SELECT *, status IN ('Refresh Successful', 'Run Completed') AND CASE schedule WHEN 'Daily' THEN CAST(start_time AS DATE) = DATE '2024-01-31'
      ELSE DATE '2024-01-31' - CAST(start_time AS DATE) < 7 END AS run_status_flag FROM f"""


@query("dq_run_log", _RUN_LOG_SQL)
def dq_run_log(r: Bound):
    return rollup.run_log(r.dependency_info, r.dependency_definitions, _NOW)


@query(
    "dq_run_log_upsert",
    f"""{_RUN_LOG_SQL.replace('SELECT *, status IN', ', n AS (SELECT *, status IN', 1)})
    SELECT * FROM n UNION ALL SELECT dependency_id, dts, type, name, schedule, workflow_id || '-old', status, start_time, end_time, duration_in_seconds,
      error_message, run_status_flag FROM n""",
)
def dq_run_log_upsert(r: Bound):
    newest = rollup.run_log(r.dependency_info, r.dependency_definitions, _NOW)
    stale = newest.withColumn("error_message", F.lit("stale"))
    kept = newest.withColumn("workflow_id", F.concat("workflow_id", F.lit("-old")))
    return upsert(stale.unionByName(kept), newest, rollup.RUN_LOG_KEYS)


@query(
    "dq_schedule_decision",
    f""", x AS (SELECT user_id, MAX(ts) AS last_run, max_by(event_type <> 'error', ts) AS last_ok,
        CASE user_id % 3 WHEN 0 THEN 'Daily' WHEN 1 THEN 'Twice Daily' ELSE '' END AS schedule FROM events GROUP BY user_id)
    SELECT *, CASE WHEN NOT last_ok THEN TRUE WHEN schedule = 'Daily' THEN CAST(last_run AS DATE) <> DATE '2024-01-30'
      WHEN schedule = 'Twice Daily' THEN NOT (CAST(last_run AS DATE) = DATE '2024-01-30' AND hour(last_run) >= 13) ELSE TRUE END AS run_required FROM x""",
)
def dq_schedule_decision(r: Bound):
    runs = (
        r.table("events")
        .groupBy("user_id")
        .agg(F.max("ts").alias("last_run"), F.max_by(F.col("event_type") != "error", "ts").alias("last_ok"))
        .withColumn(
            "schedule",
            F.when(F.col("user_id") % 3 == 0, "Daily").when(F.col("user_id") % 3 == 1, "Twice Daily").otherwise(""),
        )
    )
    due = rollup.run_required(F.col("schedule"), F.col("last_run"), F.col("last_ok"), datetime(2024, 1, 30, 18))
    return runs.withColumn("run_required", due)
