"""The 69 numbered checks as data.

Tables are role names; bind them to your own tables when running. Lags are
days before the as-of day. Fixed values: ids, windows, tolerances and filters.
"""

from __future__ import annotations

from stampbook.dq.checks import (
    CheckSpec,
    DailyCount,
    Duplicates,
    HasRows,
    History,
    Newest,
    PerGroupCount,
    RanToday,
    RatioAgainstMedian,
    RecentIsoWeek,
    WeekLoaded,
)

RECEIPTS = ("trans_rcpt_nbr",)
FUEL_STORE = "4582"
ORDER_DONE = "order_status_nm = 'NO_PENDING_ACTION'"
# days back to the last full load, by weekday (Monday is 0); -1 stands for the others
WEEKDAY_LAG = {0: 3, 1: 4, -1: 2}
VOUCHER_COLUMNS = ("wallet_id", "cmpgn_id", "reward_gained_ts", "reward_end_ts", "reward_redm_ts")


def _check(check_id: int, definition: str, *rules: object) -> CheckSpec:
    numbered = []
    for rule in rules:
        if isinstance(rule, History):
            rule = History(rule.table, rule.by, rule.tolerance, rule.up_to, rule.where, rule.first_per, check_id)
        numbered.append(rule)
    return CheckSpec(check_id, definition, tuple(numbered))


def _three(check_id, definition, table, day, window, tolerance, scope, dup, hist, *, where=None, lag=1, by=None,
           distinct_on=None):
    """Daily count, duplicates and history on one table."""
    return _check(
        check_id,
        definition,
        DailyCount(table, day, window, tolerance, lag, where),
        Duplicates(table, day, scope, dup, distinct_on, where),
        History(table, by or day, hist, (day,) if by else (), where),
    )


def _daily(check_id, definition, table, day, window, tolerance, **options):
    return _check(check_id, definition, DailyCount(table, day, window, tolerance, **options))


def _ran(check_id: int, job: str) -> CheckSpec:
    return _check(check_id, f"job {job} ran today", RanToday(job))


CHECKS: tuple[CheckSpec, ...] = (
    _three(1, "missions", "missions", "event_ts", 40, 0.25, 15, 0.005, 0.01, by="upd_ts"),
    _three(2, "missions of the status campaign", "missions", "event_ts", 30, 0.50, 90, 0.001, 0.01,
           where="cmpgn_id = 508017", by="upd_ts"),
    _three(3, "scans", "scans", "event_ts", 15, 0.55, 365, 0.001, 0.005, distinct_on=RECEIPTS),
    _three(4, "online scans", "scans", "event_ts", 20, 0.40, 365, 0.001, 0.01, where="chnl_nm = 'ecom'",
           distinct_on=RECEIPTS),
    _check(5, "goodwill credits", DailyCount("credits", "event_ts", 15, 0.25), History("credits", "event_ts", 0.001)),
    _check(6, "external credits", DailyCount("external_credits", "event_ts", 15, 0.15),
           History("external_credits", "upd_ts", 0.01)),
    _three(7, "fuel scans at one store", "scans", "event_ts", 20, 0.70, 365, 0.001, 0.001,
           where=f"store_nbr = '{FUEL_STORE}' and chnl_nm like 'pfs'", distinct_on=RECEIPTS),
    _check(8, "fuel giveaway share",
           RatioAgainstMedian("fuel_visit_level", "visit_dt", "earn", "ar_sales", 10, 0.85,
                              f"store_nbr = '{FUEL_STORE}'")),
    _three(9, "vouchers", "reward_wallets", "reward_gained_ts", 40, 0.25, 365, 0.001, 0.001,
           distinct_on=VOUCHER_COLUMNS),
    _check(10, "accounts", DailyCount("accounts", "event_ts", 20, 0.20),
           Duplicates("accounts", "event_ts", 365, 0.00001, ("wallet_id",))),
    _check(11, "first historic campaign version by load day",
           History("campaign_versions", "load_ts", 0.05, (), "rec_status_ind = 'HISTORIC'", ("cmpgn_id",))),
    _check(12, "first game per wallet and day",
           History("games", "game_start_ts", 0.01, (), None, ("wallet_id", "game_start_dt"))),
    _check(13, "used or cancelled coupons by load day",
           History("coupons", "load_ts", 0.70, (),
                   "rec_status_ind = 'CURRENT' and coupn_status_desc in ('USED', 'CANCELLED')")),
    _check(14, "account archive size", HasRows("account_archive", 2_339_190)),
    _daily(15, "consent accounts", "consent_accounts", "dt_cnvrt_to_full_acct_ts", 25, 0.20, lag=WEEKDAY_LAG),
    _daily(16, "customers", "customers", "ingest_ts", 25, 0.30, lag=2),
    _daily(17, "order promotions", "order_promos", "src_modfd_ts", 25, 0.25),
    _daily(18, "activity time series", "activity_time_series", "full_date", 20, 0.50, lag=0,
           value="max(active_prev_d)"),
    _check(19, "refunds", DailyCount("refunds", "src_create_ts", 25, 0.30, 2), History("refunds", "src_create_ts", 0.01)),
    _daily(20, "nursery series", "nursery_time_series", "full_date", 8, 0.80, value="max(nursery)"),
    _daily(21, "active earners", "active_earners", "full_date", 15, 0.50, value="max(earning_7d)"),
    _daily(22, "app usage", "app_usage", "date", 20, 0.30, day_format="yyyyMMdd",
           value="max(cast(activeUsers as bigint))"),
    _three(23, "completed online orders", "orders", "dlvr_dt", 20, 0.60, 365, 0.00001, 0.05, where=ORDER_DONE, lag=2,
           distinct_on=("web_order_id",)),
    _daily(24, "missions, stricter warning", "missions", "event_ts", 40, 0.40),
    _ran(25, "summary_activity"),
    _ran(26, "crm_send_level"),
    _ran(27, "key_objectives"),
    _daily(28, "completed fashion orders", "fashion_orders", "creation_date", 40, 0.25, lag=2,
           where="order_complete = 'Y'"),
    _check(29, "order items exist", HasRows("order_items")),
    _ran(30, "order_participation"),
    _ran(31, "voucher_shortfall"),
    _check(32, "identified fuel customers",
           *[DailyCount("fuel_lines", "visit_dt", 20, 0.70, value="count(distinct wallet_id)",
                        where=f"store_nbr = '{FUEL_STORE}' and upc_nbr = '{code}'") for code in ("FUEL1", "FUEL2")]),
    _daily(33, "store visits", "store_visits", "visit_dt", 20, 0.60),
    _daily(34, "supplier billing", "supplier_bill", "visit_dt", 20, 0.30, lag=2, noon_lag=3),
    _three(35, "online orders", "orders", "dlvr_dt", 30, 0.60, 365, 0.00001, 0.10, lag=2,
           distinct_on=("web_order_id",)),
    _ran(36, "fuel_cross_shop"),
    _three(37, "scans, domain copy", "scans_domain", "event_ts", 15, 0.4, 365, 0.001, 0.001, distinct_on=RECEIPTS),
    _check(38, "item hierarchy loaded today", Newest("items", "load_ts", (0,))),
    _daily(39, "basket items", "basket_items", "visit_ts", 30, 0.4),
    _check(40, "campaign set-up loaded today", Newest("campaign_versions", "load_ts", (0,))),
    _check(41, "campaign products loaded today", Newest("campaign_products", "load_ts", (0,))),
    _ran(42, "opt_in_figures"),
    _ran(43, "app_usage"),
    _check(44, "visits", Newest("visits", "visit_dt", (1, 2))),
    _check(45, "full visit history", Newest("visit_history", "visit_dt", (1, 2))),
    _check(46, "full online visit history", Newest("visit_history", "visit_dt", (1, 2), where="chnl_nm = 'ecom'")),
    _check(47, "customer summary week", RecentIsoWeek("customer_summary", "week_end_dt")),
    _check(48, "rewards burn", Newest("rewards_burn", "burn_dt", mode="since_last_friday")),
    _check(49, "last-week helper exists", HasRows("last_week_helper")),
    _check(50, "week finder", RecentIsoWeek("week_finder", "week_end_day")),
    _check(51, "earning rows", HasRows("earning", 5)),
    _check(52, "attribute rows", HasRows("attributes", 5)),
    _check(53, "campaign set-up copy", Newest("campaign_setup_copy", "load_ts", mode="since_last_friday")),
    _check(54, "weekly customer summary", WeekLoaded("weekly_customer_summary", "week")),
    _check(55, "weekly segment summary", WeekLoaded("weekly_segment_summary", "week")),
    _check(56, "weekly reward summary", WeekLoaded("weekly_reward_summary", "week")),
    _check(57, "weekly channel summary", WeekLoaded("weekly_channel_summary", "week")),
    _check(58, "store visit flags", Newest("store_visit_flags", "visit_dt", (1, 2))),
    _check(59, "tracker", Newest("tracker", "dt", (1, 2))),
    _check(60, "date hierarchy", Newest("date_hierarchy", "day_date", (1, 2))),
    _check(61, "store sales output", Newest("store_sales", "visit_dt", (1,))),
    _check(62, "earning completions", Newest("earning_completions", "cmplt_dt", (2,))),
    _ran(63, "control_groups"),
    _ran(64, "crm_monthly_online"),
    _ran(65, "crm_monthly_fashion"),
    _check(66, "scans per store", PerGroupCount("scans", "event_ts", "store_nbr", 10, 0.5)),
    _daily(67, "visits by day", "visits", "visit_dt", 20, 0.25),
    _ran(68, "store_test_vs_control"),
    _daily(69, "accounts, domain copy", "accounts_domain", "event_ts", 40, 0.25, lag=2),
)


def check(check_id: int) -> CheckSpec:
    return next(c for c in CHECKS if c.check_id == check_id)
