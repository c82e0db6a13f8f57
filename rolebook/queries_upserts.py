"""Jobs that bring a stored table up to date: a first run on an older, incomplete source, then the run of the day."""

from __future__ import annotations

from datetime import date, timedelta
from uuid import uuid4

from pyspark.sql import functions as F

from rolebook import queries_activity as qa
from rolebook.oracle import A, day, oracle
from rolebook.queries_money import (
    DEFAULT_REGION,
    MIN_CUSTOMERS,
    PRE_WEEKS,
    REGIONS,
    SEND_START,
    crm_sql,
    monthly_sql,
    participation_sql,
)
from rolebook.registry import ORACLES, Bound, query
from rolebook.roles import AS_OF, SCHEME
from stampbook.plans import crm, incremental
from stampbook.sources import PeriodTable, shared_folder
from stampbook.streaming import recounted_days


def _table(r: Bound, name: str, by: str, grain: str = "month") -> PeriodTable:
    """A new table in the shared folder, for as long as the session's folder lasts."""
    return PeriodTable(r.spark, f"{shared_folder(r.spark)}/tables/{name}-{uuid4().hex}", by, grain)


# --- series: a target that ends early and is wrong in its trailing days becomes the whole series ---


def _stale(series, days: int = 20):
    """The series up to ``days`` before the end, with wrong counts in the window that a run builds again."""
    late = F.col("full_date") > F.lit(AS_OF - timedelta(days=incremental.TRAILING_DAYS))
    counts = [c for c, kind in series.dtypes if kind == "bigint"]
    early = series.filter(F.col("full_date") <= F.lit(AS_OF - timedelta(days=days)))
    return early.withColumns({c: F.when(late, F.lit(-1).cast("bigint")).otherwise(F.col(c)) for c in counts})


def _held(r: Bound, name: str, series) -> PeriodTable:
    table = _table(r, name, "full_date")
    table.write(_stale(series))
    return table


@query("activity_time_series_upsert")
def activity_time_series_upsert(r: Bound):
    table = _held(r, "activity_time_series", qa.activity_time_series(r))
    return incremental.activity_time_series(table, r.scans, r.calendar, AS_OF, SCHEME.series_start)


@query("active_earners_upsert")
def active_earners_upsert(r: Bound):
    table = _held(r, "active_earners", qa.active_earners(r))
    return incremental.active_earners(table, r.missions, r.order_games, r.scans, r.calendar, AS_OF, SCHEME.series_start, SCHEME)


@query("nursery_time_series_upsert")
def nursery_time_series_upsert(r: Bound):
    table = _held(r, "nursery_time_series", qa.nursery_time_series(r))
    return incremental.nursery_time_series(table, r.scans, r.calendar, AS_OF, SCHEME.series_start, SCHEME)


for _name in ("activity_time_series", "active_earners", "nursery_time_series"):
    ORACLES[f"{_name}_upsert"] = ORACLES[_name]


# --- the nursery series from a kept state of each wallet: a first run a while ago, then one that reads no older scan ---


@query("nursery_time_series_state")
def nursery_time_series_state(r: Bound):
    series, state = _table(r, "nursery", "full_date"), _table(r, "nursery_state", "state_day")
    for as_of in (AS_OF - timedelta(days=45), AS_OF - timedelta(days=20), AS_OF):
        incremental.nursery_with_state(series, state, r.scans.filter(F.col("visit_dt") < F.lit(as_of)), r.calendar, as_of, SCHEME.series_start, SCHEME)
    return series.read()


ORACLES["nursery_time_series_state"] = ORACLES["nursery_time_series"]


# --- order participation: the first run lacks every fifth order; the second reads the last seven days ---

FIRST_RUN = AS_OF - timedelta(days=3)


def _loaded_early(orders, order_id: str):
    return orders.filter(F.col(order_id).try_cast("long") % 5 != 0)


@query(
    "order_participation_upsert",
    f"""{participation_sql(f"(dlvr_dt >= {A} - 7 OR (dlvr_dt < {A} - 7 AND CAST(web_order_id AS BIGINT) % 5 <> 0))")}""",
)
def order_participation_upsert(r: Bound):
    table = _table(r, "order_participation", "delivery_dt")
    run = (r.order_scans, r.calendar, REGIONS, DEFAULT_REGION, date(1996, 1, 1), date(1996, 2, 1))
    incremental.order_participation(table, _loaded_early(r.online_orders, "web_order_id"), *run, FIRST_RUN)
    incremental.order_participation(table, r.online_orders, *run, AS_OF)
    return table.read()


# --- sends: the first run ends before the last quarter's sends; both runs prune ---

SENDS_FIRST, SENDS_SECOND = date(2001, 4, 20), date(2001, 7, 20)


def _two_runs(key: str, channels: dict[str, str]) -> str:
    """The first run's result, without the keys of the second's, and the second's; pruned after each run."""
    spans = {"a": (SEND_START, SENDS_FIRST - timedelta(days=16)), "b": (SENDS_SECOND - timedelta(days=22), SENDS_SECOND - timedelta(days=15))}
    whole = {x: crm_sql(key, channels, span).removeprefix(",") for x, span in spans.items()}
    keys = "(type, journey_name, groups, journey_date)"
    return f""", first_run AS (WITH {whole['a']}), second_run AS (WITH {whole['b']}),
    first_kept AS ({_pruned('first_run')}),
    merged AS (SELECT * FROM first_kept WHERE {keys} NOT IN (SELECT {keys} FROM second_run) UNION ALL SELECT * FROM second_run)
    {_pruned('merged')}"""


def _pruned(rows: str) -> str:
    large = f"SELECT * FROM {rows} WHERE customers >= {MIN_CUSTOMERS}"
    return f"""{large} AND journey_name NOT IN (SELECT journey_name FROM ({large}) GROUP BY journey_date, journey_name HAVING COUNT(DISTINCT groups) <> 2)"""


def _sends_upsert(name: str, key: str, bound, channels: dict[str, str]) -> None:
    @query(name)
    def build(r: Bound):
        table = _table(r, name, "journey_date")
        for as_of in (SENDS_FIRST, SENDS_SECOND):
            incremental.crm_send_level(table, r.sends, key, lambda sent: bound(r, sent), SEND_START, as_of, MIN_CUSTOMERS)
        return table.read()

    ORACLES[name] = oracle(_two_runs(key, channels))


def _fashion(r: Bound, key: str, sent):
    return crm.channel_orders(r.fashion_orders, "order_id", key, "creation_date", "sum_order_quantity", "total_order_value", sent)


def _grocery(r: Bound, sent):
    return crm.channel_orders(r.grocery_orders, "web_order_id", "spid", "order_sbmtd_ts", "item_qty", "pos_tot_amt", sent)


def _store(r: Bound, sent):
    scans = r.scans.filter("chnl_nm = 'store'")
    return crm.channel_orders(scans, "basket_id", "wallet_id", "event_ts", "reg_nbr", "sale_amt_inc_vat", sent)


_FASHION_SQL = f"SELECT {{}} AS k, {day('creation_date')} AS d, order_id AS id, sum_order_quantity AS items, total_order_value AS sales FROM (SELECT DISTINCT * FROM fashion_orders)"
_GROCERY_SQL = f"SELECT spid AS k, {day('order_sbmtd_ts')} AS d, web_order_id AS id, item_qty AS items, pos_tot_amt AS sales FROM grocery_orders"
_STORE_SQL = "SELECT wallet_id AS k, visit_dt AS d, basket_id AS id, reg_nbr AS items, sale_amt_inc_vat AS sales FROM scans WHERE chnl_nm = 'store'"

_sends_upsert("crm_send_level_upsert", "spid", lambda r, sent: {"fashion": _fashion(r, "spid", sent), "grocery": _grocery(r, sent)},
              {"fashion": _FASHION_SQL.format("spid"), "grocery": _GROCERY_SQL})
_sends_upsert("crm_send_level_store_upsert", "walletid", lambda r, sent: {"store": _store(r, sent)}, {"store": _STORE_SQL})
_sends_upsert("crm_send_level_fashion_upsert", "walletid", lambda r, sent: {"fashion": _fashion(r, "walletid", sent)},
              {"fashion": _FASHION_SQL.format("walletid")})


# --- weeks of control groups: the first run lacks every fifth order; the second reads from two weeks back ---

MONTHLY_SECOND = date(2001, 7, 20)
_SINCE = f"(SELECT retail_week - 2 FROM calendar WHERE day_date = DATE '{MONTHLY_SECOND}')"


def _monthly_upsert(name: str, channel: str, orders, sql: str) -> None:
    @query(f"{name}_upsert", monthly_sql(channel, sql, f"(retail_week > {_SINCE} OR CAST(id AS BIGINT) % 5 <> 0)"))
    def build(r: Bound):
        table = _table(r, name, "week_id", "value")
        run = (r.calendar, channel, PRE_WEEKS[0] - 1, PRE_WEEKS)
        incremental.crm_monthly(table, r.control_population, _loaded_early(orders(r), "order_id"), *run, date(2001, 7, 6))
        incremental.crm_monthly(table, r.control_population, orders(r), *run, MONTHLY_SECOND)
        return table.read()


_monthly_upsert("crm_monthly_online", "online", lambda r: r.week_orders, "SELECT order_id AS id, spid AS k, sales, order_day AS d FROM week_orders")
_monthly_upsert("crm_monthly_fashion", "fashion", lambda r: r.fashion_weeks, "SELECT order_id AS id, spid AS k, sales, order_day AS d FROM fashion_weeks")


# --- the stream: the second drop brings rows of days long counted, and some rows again ---


@query(
    "daily_activity_stream",
    "SELECT visit_dt AS full_date, chnl_nm, COUNT(*) AS num_transactions, CAST(SUM(sale_amt_inc_vat) AS BIGINT) AS sales FROM scans GROUP BY 1, 2",
)
def daily_activity_stream(r: Bound):
    """All scans in two drops: first those but every seventh; then these, years late, and every third of the others again."""
    drops = f"{shared_folder(r.spark)}/tables/drops-{uuid4().hex}"
    archive, counts = _table(r, "archive", "full_date", "year"), _table(r, "counts", "full_date", "year")
    scans = r.scans.select("trans_rcpt_nbr", F.col("event_ts").cast("timestamp").alias("event_ts"), "chnl_nm", "sale_amt_inc_vat")
    number = F.col("trans_rcpt_nbr").cast("long")
    for part in (number % 7 != 0, (number % 7 == 0) | (number % 3 == 0)):
        scans.filter(part).write.mode("append").parquet(drops)
        stream = r.spark.readStream.schema(scans.schema).parquet(drops)
        recounted_days(stream, archive, counts, ["trans_rcpt_nbr"], f"{drops}-checkpoint").awaitTermination()
    return counts.read()
