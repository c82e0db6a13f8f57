"""Bases, activity, retention and status-group queries."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from rolebook.oracle import A, E, LAUNCH, NUMERIC, SERIES, STATUS_LAUNCH, channel, day, pounds, total
from rolebook.registry import ORACLES, QUERIES, Bound, query
from rolebook.roles import AS_OF, EVENTS_AS_OF, SCHEME
from stampbook.plans import activity, bases, status_group, trading

# --- bases ---


@query(
    "scanners_daily",
    f"""SELECT {day('event_ts')} AS scan_date, {channel('chnl_nm')} AS chnl_nm, COUNT(DISTINCT wallet_id) AS scanners
    FROM event_scans WHERE event_ts < {E} GROUP BY 1, 2
    UNION ALL SELECT {day('event_ts')}, 'All', COUNT(DISTINCT wallet_id) FROM event_scans WHERE event_ts < {E} GROUP BY 1""",
)
def scanners_daily(r: Bound):
    return trading.scanners_daily(r.event_scans, EVENTS_AS_OF)


@query(
    "calendar",
    f"""SELECT day_date AS full_date, retail_week, retail_week AS retail_year_week, n_orders FROM
    (SELECT c.*, (SELECT COUNT(*) FROM scans WHERE visit_dt = day_date) AS n_orders FROM calendar c)
    WHERE day_date >= {LAUNCH} AND day_date < {A}""",
)
def calendar(r: Bound):
    per_day = r.scans.groupBy(F.col("visit_dt").alias("full_date")).agg(F.count(F.lit(1)).alias("n_orders"))
    return r.calendar_rows.join(per_day, "full_date", "left").fillna(0, ["n_orders"])


@query(
    "last_complete_week",
    f"""SELECT start_date, end_date, (SELECT COUNT(*) FROM scans WHERE visit_dt BETWEEN start_date AND end_date) AS n_scans
    FROM last_week_v""",
)
def last_complete_week(r: Bound):
    start, end = r.last_week.select("start_date").scalar(), r.last_week.select("end_date").scalar()
    inside = r.scans.filter(F.col("visit_dt").between(start, end)).agg(F.count(F.lit(1)).alias("n_scans"))
    return r.last_week.withColumn("n_scans", inside.scalar())


@query(
    "account_base",
    """SELECT a.*, CASE WHEN EXISTS (SELECT 1 FROM scans s WHERE s.wallet_id = a.wallet_id AND s.visit_dt = a.reg_dt)
      THEN 1 ELSE 0 END AS active_ind, b.label AS cashbank_categorised, b.i AS cashbank_categorised_order
    FROM account_v a LEFT JOIN (VALUES (0, 1, 1, '£0'), (1, 100, 2, '£0-£0.99'), (100, 200, 3, '£1-£1.99'),
      (200, 300, 4, '£2-£2.99'), (300, 400, 5, '£3-£3.99'), (400, 500, 6, '£4-£4.99'), (500, 1000, 7, '£5-£9.99'),
      (1000, 2000, 8, '£10-£19.99'), (2000, 99999999, 9, '£20+')) AS b(lo, hi, i, label)
    ON curr_cash_bnk_pnts_qty >= b.lo AND curr_cash_bnk_pnts_qty < b.hi""",
)
def account_base(r: Bound):
    return r.account_rows


@query("sign_ups", "SELECT * FROM sign_up_v")
def sign_ups(r: Bound):
    return r.sign_up_rows


@query("sign_ups_daily", "SELECT * FROM sign_up_day_v")
def sign_ups_daily(r: Bound):
    return bases.sign_ups_daily(r.sign_up_rows)


@query("scan_base", "SELECT * FROM scan_v")
def scan_base(r: Bound):
    return r.scan_rows


def _flag_sql(name: str, first: int, last: int) -> str:
    return f"MAX(CASE WHEN visit_dt BETWEEN {A} - {first} AND {A} - {last} THEN 1 ELSE 0 END) AS {name}"


_WALLET_FLAGS = ", ".join(
    _flag_sql(f"{family}_{n}_day_active_flag", n - 1 + shift + (1 if family == "current" else 0), shift)
    for family, shift in (("current", 0), ("yesterday", 2), ("rolling", 8))
    for n in (1, 7, 30, 91)
)


@query(
    "wallet_activity",
    f"""SELECT wallet_id, {_WALLET_FLAGS},
    MAX(CASE WHEN visit_dt BETWEEN (SELECT start_dt FROM year_v) AND (SELECT end_dt FROM year_v) THEN 1 ELSE 0 END) AS ytd_flag
    FROM scans WHERE {NUMERIC} AND visit_dt >= {LAUNCH} AND visit_dt < {A} GROUP BY wallet_id""",
)
def wallet_activity(r: Bound):
    return bases.wallet_activity(r.scans, r.calendar, AS_OF, SCHEME)


@query(
    "store_details",
    """SELECT s.store_nbr, region, split_part(MIN(store_nm), ' (', 1) AS store_nm, latitude, longitude
    FROM stores s JOIN store_regions m ON s.store_nbr = m.store_nbr WHERE store_nm NOT LIKE '%, %'
    GROUP BY s.store_nbr, region, latitude, longitude
    UNION SELECT s.store_nbr, region, split_part(MIN(store_nm), ' (', 1), latitude, longitude
    FROM stores s JOIN forced_stores f ON s.store_nbr = f.store_nbr WHERE latitude IS NOT NULL
    GROUP BY s.store_nbr, region, latitude, longitude""",
)
def store_details(r: Bound):
    return bases.store_details(r.stores, r.store_regions, r.forced_stores)


@query("status_lookup", "SELECT DISTINCT acct_status_id FROM voucher_v WHERE acct_status_id IS NOT NULL")
def status_lookup(r: Bound):
    return bases.status_lookup(r.voucher_rows)


@query("channel_lookup", "SELECT DISTINCT chnl_nm FROM voucher_v WHERE chnl_nm IS NOT NULL")
def channel_lookup(r: Bound):
    return bases.channel_lookup(r.voucher_rows)


# --- activity ---


@query(
    "first_scans",
    f""", f AS (SELECT wallet_id, MIN(visit_dt) AS first_scan_dt FROM scans
      WHERE wallet_id IN (SELECT wallet_id FROM accounts) GROUP BY wallet_id),
    d AS (SELECT first_scan_dt, COUNT(*) AS num_people FROM f WHERE first_scan_dt < {A} GROUP BY 1)
    SELECT first_scan_dt, num_people,
      (SELECT COUNT(*) FROM f WHERE f.first_scan_dt <= d.first_scan_dt) AS cumu_people FROM d""",
)
def first_scans(r: Bound):
    return activity.first_scans(r.scans, r.accounts, AS_OF)


@query(
    "scans_daily",
    f""", f AS (SELECT wallet_id, MIN({day('event_ts')}) AS d FROM scan_v GROUP BY wallet_id)
    SELECT m.*, u.num_users_scanning, c.active_cum, CAST(NULL AS VARCHAR) AS acct_status_id
    FROM (SELECT {day('event_ts')} AS event_dt, store_nbr, COUNT(wallet_id) AS num_transactions FROM scan_v GROUP BY 1, 2) m
    JOIN (SELECT {day('event_ts')} AS event_dt, COUNT(DISTINCT wallet_id) AS num_users_scanning FROM scan_v GROUP BY 1) u
      ON m.event_dt = u.event_dt
    LEFT JOIN (SELECT DISTINCT d, CAST(SUM(1) OVER (ORDER BY d) AS BIGINT) AS active_cum FROM f) c ON m.event_dt = c.d""",
)
def scans_daily(r: Bound):
    return activity.scans_daily(r.scan_rows)


@query(
    "active_time_series",
    f""", f AS (SELECT wallet_id, MIN({day('event_ts')}) AS d FROM scan_v GROUP BY wallet_id),
    a AS (SELECT day_date, (SELECT CASE WHEN COUNT(*) > 0 THEN COUNT(*) END FROM f WHERE d BETWEEN {SERIES} AND day_date) AS active_cum
      FROM calendar WHERE day_date >= {SERIES} AND day_date < {A}),
    s AS (SELECT DISTINCT signup_dt, CAST(SUM(num_sign_ups) OVER (ORDER BY signup_dt) AS BIGINT) AS sign_ups_cum FROM sign_up_day_v)
    SELECT day_date AS event_dt, active_cum, sign_ups_cum, CAST(active_cum AS DOUBLE) / sign_ups_cum AS percenta
    FROM a JOIN s ON day_date = signup_dt WHERE day_date >= {LAUNCH}""",
)
def active_time_series(r: Bound):
    return activity.active_time_series(bases.sign_ups_daily(r.sign_up_rows), r.scan_rows, r.calendar, AS_OF, SCHEME)


def _spine(r: Bound, start, end):
    return r.calendar.filter(F.col("day_date").between(F.lit(start), F.lit(end))).select(
        F.col("day_date").alias("full_date")
    )


@query(
    "activity_time_series",
    f"""SELECT day_date AS full_date, {', '.join(
        f"COUNT(DISTINCT CASE WHEN visit_dt >= day_date - {k} THEN wallet_id END) AS active_prev_{n}"
        for k, n in ((1, 'd'), (7, '7d'), (30, '30d'), (91, '91d')))}
    FROM calendar LEFT JOIN (SELECT DISTINCT wallet_id, visit_dt FROM scans) s ON visit_dt BETWEEN day_date - 91 AND day_date - 1
    WHERE day_date BETWEEN {SERIES} AND {A} GROUP BY day_date""",
)
def activity_time_series(r: Bound):
    return activity.activity_time_series(r.scans, _spine(r, SCHEME.series_start, AS_OF), first=SCHEME.series_start, as_of=AS_OF)


@query(
    "rolling_quarter_active",
    f"""SELECT month_end, COUNT(DISTINCT wallet_id) AS active_quarter
    FROM (SELECT MAX(day_date) AS month_end FROM calendar WHERE day_date >= {SERIES} GROUP BY date_trunc('month', day_date)) m
    JOIN scans ON visit_dt BETWEEN month_end - 90 AND month_end WHERE month_end <= {A} GROUP BY month_end""",
)
def rolling_quarter_active(r: Bound):
    return activity.rolling_quarter_active(r.scans, r.calendar, AS_OF, SCHEME.series_start)


def _segment_sql(period: str, alias: str) -> str:
    return f"""SELECT CAST(date_trunc('{period}', event_ts) AS DATE) AS {alias}, COUNT(DISTINCT wallet_id) AS active_wallets
    FROM scans WHERE visit_dt >= {LAUNCH} AND visit_dt < {A} GROUP BY 1"""


@query("active_monthly_seg", _segment_sql("month", "cal_month"))
def active_monthly_seg(r: Bound):
    return activity.active_segments(r.scans, AS_OF, SCHEME, "month", "cal_month")


@query("active_weekly_seg", _segment_sql("week", "cal_week"))
def active_weekly_seg(r: Bound):
    return activity.active_segments(r.scans, AS_OF, SCHEME, "week", "cal_week")


@query(
    "active_earners",
    f""", e AS (SELECT wallet_id, {day('cmpgn_cmplt_ts')} AS d FROM missions WHERE rec_status_ind = 'CURRENT'
        AND cmpgn_id <> {SCHEME.earners_excluded_campaign} AND {day('cmpgn_cmplt_ts')} >= {LAUNCH} AND {day('cmpgn_cmplt_ts')} < {A}
      UNION SELECT wallet_id, {day('game_redm_ts')} FROM order_games WHERE rec_status_ind = 'CURRENT' AND {day('game_redm_ts')} < {A}),
    c1 AS (SELECT day_date, COUNT(DISTINCT wallet_id) AS earning_7d FROM calendar JOIN e ON d BETWEEN day_date - 6 AND day_date
      WHERE day_date BETWEEN {SERIES} AND {A} - 1 GROUP BY day_date),
    c2 AS (SELECT day_date, COUNT(DISTINCT wallet_id) AS active_7d FROM calendar
      JOIN scans ON visit_dt BETWEEN day_date - 6 AND day_date AND visit_dt >= {LAUNCH} AND visit_dt < {A}
      WHERE day_date BETWEEN {SERIES} AND {A} - 1 GROUP BY day_date)
    SELECT c1.day_date AS full_date, earning_7d, active_7d, CAST(earning_7d AS DOUBLE) / active_7d AS percentage
    FROM c1 JOIN c2 ON c1.day_date = c2.day_date""",
)
def active_earners(r: Bound):
    spine = _spine(r, SCHEME.series_start, AS_OF - timedelta(days=1))
    return activity.active_earners(r.missions, r.order_games, r.scans, spine, AS_OF, SCHEME)


@query(
    "active_earning_ratio",
    f""", m AS (SELECT wallet_id, {day('cmpgn_cmplt_ts')} AS d FROM missions)
    SELECT (SELECT CAST(COUNT(DISTINCT wallet_id) AS DOUBLE) FROM m WHERE d >= {A} - 365)
         / (SELECT COUNT(DISTINCT wallet_id) FROM scans WHERE visit_dt >= {A} - 365) AS active_earning_ytd,
      (SELECT CAST(COUNT(DISTINCT wallet_id) AS DOUBLE) FROM m WHERE d >= {A} - 7)
         / (SELECT COUNT(DISTINCT wallet_id) FROM scans WHERE visit_dt >= {A} - 7) AS active_earning_7days""",
)
def active_earning_ratio(r: Bound):
    return activity.active_earning_ratio(r.missions, r.scans, AS_OF)


def _funnel_sql(as_of: str, cutoff: str) -> str:
    return f"""SELECT week_cat, COUNT(*) AS total, COUNT(*) FILTER (WHERE age <= 7) AS new_one_scanners,
      COUNT(*) FILTER (WHERE age > 7 AND span <= 91) AS new_active,
      COUNT(*) FILTER (WHERE span >= 92 AND gap > 92) AS reactive_active,
      COUNT(*) FILTER (WHERE span >= 92 AND gap <= 92) AS recycling_active
    FROM (SELECT {as_of} - f AS age, l - f AS span, l - p AS gap,
        CASE WHEN ceil(({as_of} - l) / 7.0) < 14 THEN CAST(CAST(ceil(({as_of} - l) / 7.0) AS INT) AS VARCHAR)
             WHEN NOT (CAST(regtn_ts AS DATE) < {cutoff} AND acct_status_id = 'TEMP') THEN 'Lapsed' END AS week_cat
      FROM (SELECT x.wallet_id, x.f, x.l, (SELECT MAX(visit_dt) FROM scans s WHERE s.wallet_id = x.wallet_id AND s.visit_dt < x.l) AS p
        FROM (SELECT wallet_id, MIN(visit_dt) AS f, MAX(visit_dt) AS l FROM scans WHERE visit_dt < {as_of} GROUP BY wallet_id) x) y
      JOIN accounts a ON a.wallet_id = y.wallet_id) z
    WHERE week_cat IS NOT NULL GROUP BY week_cat"""


def _funnel(r: Bound, back: int):
    return activity.active_funnel(
        r.scans, r.accounts, AS_OF - timedelta(days=back), AS_OF - timedelta(days=44), SCHEME
    )


@query("active_funnel", _funnel_sql(A, f"{A} - 44"))
def active_funnel(r: Bound):
    return _funnel(r, 0)


@query("active_funnel_last_week", _funnel_sql(f"({A} - 7)", f"{A} - 44"))
def active_funnel_last_week(r: Bound):
    return _funnel(r, 7)


@query(
    "active_breakdown",
    f""", cur AS ({_funnel_sql(A, f"{A} - 44")}), prev AS ({_funnel_sql(f"({A} - 7)", f"{A} - 44")})
    SELECT CASE WHEN cur.week_cat = 'Lapsed' THEN 14 ELSE CAST(cur.week_cat AS INT) END AS index,
      CASE WHEN cur.week_cat = 'Lapsed' THEN 'Lapsed'
        ELSE CAST(CAST(cur.week_cat AS INT) - 1 AS VARCHAR) || ' - ' || cur.week_cat || ' Weeks Ago' END AS heading,
      cur.*, cur.total - prev.total AS total_wk_chng, cur.new_one_scanners - prev.new_one_scanners AS first_week_wk_chng,
      cur.new_active - prev.new_active AS new_wk_chng, cur.recycling_active - prev.recycling_active AS retained_wk_chng,
      cur.reactive_active - prev.reactive_active AS reactive_wk_chng
    FROM cur JOIN prev ON cur.week_cat = prev.week_cat""",
)
def active_breakdown(r: Bound):
    return activity.active_breakdown(_funnel(r, 0), _funnel(r, 7))


@query(
    "nursery_time_series",
    f""", s AS (SELECT wallet_id, visit_dt FROM scans WHERE visit_dt >= {LAUNCH}),
    d AS (SELECT day_date FROM calendar WHERE day_date BETWEEN {SERIES} AND {A}),
    w AS (SELECT day_date, wallet_id, MAX(visit_dt) AS last_scan, COUNT(*) AS n FROM d JOIN s ON visit_dt <= day_date + 1
      GROUP BY day_date, wallet_id),
    c AS (SELECT day_date, COUNT(*) FILTER (WHERE day_date + 1 - last_scan > 92) AS lapsed,
      COUNT(*) FILTER (WHERE n < 4 AND day_date + 1 - last_scan <= 30) AS nursery FROM w GROUP BY day_date),
    x AS (SELECT visit_dt, COUNT(*) AS reactivated FROM (SELECT DISTINCT wallet_id, visit_dt FROM s) q
      WHERE visit_dt - (SELECT MAX(p.visit_dt) FROM s p WHERE p.wallet_id = q.wallet_id AND p.visit_dt < q.visit_dt) > 92 GROUP BY visit_dt)
    SELECT d.day_date AS full_date, reactivated, NULLIF(lapsed, 0) AS lapsed, NULLIF(nursery, 0) AS nursery
    FROM d LEFT JOIN c ON d.day_date = c.day_date LEFT JOIN x ON d.day_date = x.visit_dt
    WHERE reactivated IS NOT NULL OR lapsed > 0 OR nursery > 0""",
)
def nursery_time_series(r: Bound):
    return activity.nursery_time_series(r.scans, _spine(r, SCHEME.series_start, AS_OF), SCHEME, AS_OF)


@query(
    "rns_series",
    f""", f AS (SELECT wallet_id, MIN({day('event_ts')}) AS first_use FROM scan_v GROUP BY wallet_id),
    b AS (SELECT u.signup_dt, f.first_use, a.reg_dt, a.acct_status_id FROM sign_up_v u
      LEFT JOIN account_v a ON u.singl_profl_id = a.singl_profl_id LEFT JOIN f ON f.wallet_id = a.wallet_id),
    d AS (SELECT day_date FROM calendar WHERE day_date >= {LAUNCH} AND day_date < {A})
    SELECT day_date AS full_date, COUNT(*) FILTER (WHERE signup_dt <= day_date) AS sign_ups,
      COUNT(*) FILTER (WHERE first_use <= day_date) AS first_uses,
      NULLIF(COUNT(*) FILTER (WHERE acct_status_id = 'TEMP' AND reg_dt <= day_date - 37), 0) AS ct
    FROM d CROSS JOIN b GROUP BY day_date HAVING COUNT(*) FILTER (WHERE signup_dt <= day_date) > 0
      AND COUNT(*) FILTER (WHERE first_use <= day_date) > 0""",
)
def rns_series(r: Bound):
    return activity.rns_series(r.sign_up_rows, r.account_rows, r.scan_rows, r.calendar_rows, SCHEME)


@query(
    "rns_excl_expired",
    f""", x AS (SELECT a.*, (SELECT MIN({day('event_ts')}) FROM scan_v s WHERE s.wallet_id = a.wallet_id) AS first_scan FROM account_v a)
    SELECT day_date AS full_date, COUNT(DISTINCT x.wallet_id) AS wallet_id FROM calendar LEFT JOIN x
      ON (first_scan >= day_date OR first_scan IS NULL) AND reg_dt < day_date
      AND (acct_del_ind_1 = 0 OR reg_dt >= day_date - 37)
    WHERE day_date BETWEEN {SERIES} AND {A} GROUP BY day_date""",
)
def rns_excl_expired(r: Bound):
    return activity.rns_excl_expired(r.account_rows, r.scan_rows, r.calendar, AS_OF, SCHEME)


@query(
    "measures_row",
    f""", un AS (SELECT * FROM sign_up_v WHERE singl_profl_id NOT IN
        (SELECT a.singl_profl_id FROM account_v a JOIN scan_v s ON a.wallet_id = s.wallet_id)),
    mx AS (SELECT MAX(signup_dt) AS d FROM sign_up_v), lw AS (SELECT end_date AS d FROM last_week_v)
    SELECT (SELECT COUNT(*) FROM un WHERE signup_dt = (SELECT d FROM mx)) AS register_never_scanned_24_hrs,
      (SELECT COUNT(*) FROM un WHERE signup_dt BETWEEN (SELECT d - 6 FROM mx) AND (SELECT d FROM mx)) AS register_never_scanned_7_days,
      (SELECT median(date_diff('second', reward_gained_ts, reward_redm_ts)) / 60 FROM voucher_v WHERE reward_redm_ts IS NOT NULL)
        AS avg_time_voucher_held_mins,
      (SELECT COUNT(DISTINCT wallet_id) FROM scan_v) AS num_wallet_id,
      (SELECT CAST(SUM(CASE WHEN acct_status_id = 'DEFAULT' THEN opt_in_flag END) AS DOUBLE)
        / SUM(CASE WHEN acct_status_id = 'DEFAULT' THEN new_ind END) FROM sign_up_v) AS new_spid_opt_in,
      (SELECT COUNT(DISTINCT wallet_id) FROM scan_v WHERE event_ts <= (SELECT d FROM lw)) AS num_wallet_id_last_wk,
      (SELECT COUNT(*) FROM un WHERE signup_dt = (SELECT d FROM lw)) AS register_never_scanned_24_hrs_last_wk,
      (SELECT COUNT(*) FROM un WHERE signup_dt BETWEEN (SELECT d - 6 FROM lw) AND (SELECT d FROM lw)) AS register_never_scanned_7_days_last_wk""",
)
def measures_row(r: Bound):
    return activity.measures_row(r.sign_up_rows, r.account_rows, r.scan_rows, r.voucher_rows, r.last_week)


@query(
    "expiring_balances",
    f""", p AS (SELECT singl_profl_id, curr_cash_bnk_pnts_qty AS q, h.x FROM account_v, (VALUES ('7', 7), ('14', 14)) AS h(x, n)
      WHERE singl_profl_id LIKE 'no%' AND regtn_ts + INTERVAL 37 DAY BETWEEN CAST({A} AS TIMESTAMP) AND CAST({A} + h.n AS TIMESTAMP))
    SELECT COUNT(DISTINCT singl_profl_id) AS num_people, cshbnk_category, x AS expiry_category, AVG(q) / 100 AS average,
      cshbnk_category_order
    FROM (SELECT *, CASE WHEN q = 0 THEN '£0.00' WHEN q < 100 THEN '£0.01-£0.99'
        WHEN q < 1900 THEN '£' || CAST(q // 100 AS VARCHAR) || '-£' || CAST(q // 100 AS VARCHAR) || '.99' END AS cshbnk_category,
      CASE WHEN q = 0 THEN 'a' WHEN q < 100 THEN 'b' WHEN q < 1900 THEN chr(98 + CAST(q // 100 AS INT)) END AS cshbnk_category_order
      FROM p) GROUP BY ALL""",
)
def expiring_balances(r: Bound):
    return activity.expiring_balances(r.account_rows, AS_OF, scheme=SCHEME)


# thirteen metrics; per metric the row conditions of Total, yesterday and last week
def _grid_sql(as_of: str) -> str:
    def live(k: int) -> str:
        return "del = 0" if k == 0 else f"(del = 0 OR reg >= {as_of} - {37 + k})"

    def three(rule) -> tuple[str, str, str]:
        return rule(0), rule(1), rule(7)

    metrics = [
        ("registered", three(lambda k: f"reg < {as_of} - {k}"), "GP"),
        ("current accounts", three(lambda k: f"reg < {as_of} - {k} AND {live(k)}"), "GP"),
        ("expired accounts", three(lambda k: f"reg < {as_of} - {37 + k if k else 0} AND del = 1"), "G"),
        ("current perms", three(lambda k: f"reg < {as_of} - {k} AND {live(k)} AND st = 'DEFAULT'"), "P"),
        ("current guests", three(lambda k: f"reg < {as_of} - {k} AND {live(k)} AND st = 'TEMP'"), "G"),
        ("distinct_wallet_scans", three(lambda k: f"s{k} < {as_of} - {k}"), "GP"),
        ("non expired wallet scans",
         three(lambda k: f"s{k} < {as_of} - {k} AND {live(k)}" + (f" AND reg < {as_of}" if k == 0 else "")), "GP"),
        ("wallets, active in last 13 weeks", three(lambda k: f"s{k} >= {as_of} - {91 + k} AND s{k} < {as_of} - {k}"), "GP"),
        ("wallets, lapsed", three(lambda k: f"{live(k)} AND s{k} < {as_of} - {91 + k}"), "GP"),
        ("wallets, active in last 30 days", three(lambda k: f"s{k} >= {as_of} - {30 + k} AND s{k} < {as_of} - {k}"), "GP"),
        ("wallets, active in last 7 days", three(lambda k: f"s{k} >= {as_of} - {7 + k} AND s{k} < {as_of} - {k}"), "GP"),
        ("wallets, active in last 1 days", three(lambda k: f"s{k} >= {as_of} - {1 + k} AND s{k} < {as_of} - {k}"), "GP"),
        ("RNS - excluding expired guests",
         three(lambda k: f"{live(k)} AND reg < {as_of} - {k} AND (f >= {as_of} - {k} OR f IS NULL)"), "GP"),
    ]

    def cell(condition: str, alias: str) -> str:
        return f"(SELECT COUNT(*) FROM b WHERE {condition}) AS \"{alias}\""

    rows = []
    for i, (name, (now, yesterday, week), split) in enumerate(metrics, 1):
        guests = f"({now}) AND st = 'TEMP'" if "G" in split else "FALSE"
        perms = f"({now}) AND st = 'DEFAULT'" if "P" in split else "FALSE"
        rows.append(
            f"SELECT '{name}' AS type, {i} AS index, {cell(now, 'Total')}, {cell(guests, 'Guests')}, {cell(perms, 'Perms')}, "
            f"{cell(perms + ' AND opted', 'Perms_opted_in')}, {cell(yesterday, 'Total_yday')}, {cell(week, 'Total_last_wk')}"
        )
    return f""", b AS MATERIALIZED (SELECT a.wallet_id, {day('regtn_ts')} AS reg, acct_status_id AS st,
      CASE WHEN {day('regtn_ts')} < {as_of} - 37 AND acct_status_id = 'TEMP' THEN 1 ELSE 0 END AS del,
      (mktg_consent_email = 'Y' OR push_notif_consent = 'Y') AS opted, f, s0, s1, s7
      FROM accounts a LEFT JOIN consents c ON c.singl_profl_id = a.singl_profl_id
      LEFT JOIN (SELECT wallet_id, MIN(visit_dt) AS f, MAX(visit_dt) AS s0,
        MAX(visit_dt) FILTER (WHERE visit_dt < {as_of} - 1) AS s1, MAX(visit_dt) FILTER (WHERE visit_dt < {as_of} - 7) AS s7
        FROM scans WHERE visit_dt >= {LAUNCH} AND visit_dt < {as_of} GROUP BY wallet_id) s ON s.wallet_id = a.wallet_id
      WHERE {day('regtn_ts')} >= {LAUNCH} AND {day('regtn_ts')} < {as_of})
    {' UNION ALL '.join(rows)}"""


@query("activity_funnel_current", _grid_sql(A))
def activity_funnel_current(r: Bound):
    return activity.activity_funnel(r.scans, r.accounts, r.consents, AS_OF, SCHEME)


_SATURDAY = activity.saturday_after_last_friday(AS_OF)


@query("activity_funnel_last", _grid_sql(f"DATE '{_SATURDAY}'"))
def activity_funnel_last(r: Bound):
    return activity.activity_funnel(r.scans, r.accounts, r.consents, _SATURDAY, SCHEME)


# --- status group ---


@query(
    "status_activity_funnel",
    f""", l AS (SELECT wallet_id, MAX(event_ts) AS t FROM scans WHERE visit_dt >= {STATUS_LAUNCH} AND visit_dt < {A}
      AND chnl_nm = 'store' GROUP BY wallet_id)
    SELECT COUNT(*) AS scanned_total, COUNT(*) FILTER (WHERE t >= {A} - 30) AS scanned_30day,
      COUNT(*) FILTER (WHERE t >= {A} - 7) AS scanned_7day, COUNT(*) FILTER (WHERE t >= {A} - 1) AS scanned_1day
    FROM holder_v h JOIN l ON h.wallet_id = l.wallet_id AND h.status_upd_dt <= l.t""",
)
def status_activity_funnel(r: Bound):
    return status_group.status_activity_funnel(r.accounts, r.archive, r.scans, AS_OF, SCHEME)


@query(
    "status_earns",
    f"""SELECT {day('cmpgn_cmplt_ts')} AS cmpgn_cmplt_dt, store_nbr, COUNT(*) AS redemptions, {pounds('rdmpt_val')} AS earned,
      0 AS cumu_redemptions, 0 AS cumu_earned
    FROM missions m LEFT JOIN (SELECT DISTINCT wallet_id, event_ts, store_nbr FROM scans) s
      ON m.wallet_id = s.wallet_id AND m.cmpgn_cmplt_ts = s.event_ts
    WHERE cmpgn_id = {SCHEME.status_campaign} AND {day('cmpgn_cmplt_ts')} < {A} AND mssn_status_desc <> 'CANCELLED' GROUP BY 1, 2""",
)
def status_earns(r: Bound):
    return status_group.status_earns(r.missions, r.scans, AS_OF, SCHEME)


@query(
    "status_breakdown",
    f""", b AS (SELECT a.wallet_id, {day('regtn_ts')} < {STATUS_LAUNCH} AS old,
      (SELECT MAX(visit_dt) FROM scans s WHERE s.wallet_id = a.wallet_id) AS scan FROM accounts a WHERE status_id_last_upd_ts IS NOT NULL)
    SELECT 'Index' AS "group", 2 AS existing, 1 AS "new"
    UNION ALL SELECT 'Grand Total', COUNT(*) FILTER (WHERE old), COUNT(*) FILTER (WHERE NOT old) FROM b
    UNION ALL SELECT 'Users Scanned Post inc. launch', COUNT(*) FILTER (WHERE old AND scan >= {STATUS_LAUNCH}),
      COUNT(*) FILTER (WHERE NOT old AND scan IS NOT NULL) FROM b
    UNION ALL SELECT 'Users Scanned Pre launch', COUNT(*) FILTER (WHERE old AND scan < {STATUS_LAUNCH}), NULL FROM b
    UNION ALL SELECT 'Users Not Scanned', COUNT(*) FILTER (WHERE old AND scan IS NULL), COUNT(*) FILTER (WHERE NOT old AND scan IS NULL) FROM b""",
)
def status_breakdown(r: Bound):
    return status_group.status_breakdown(r.accounts, r.scans, SCHEME, AS_OF)


@query(
    "status_scans",
    f"""SELECT visit_dt AS scan_dt, store_nbr, COUNT(*) AS status_group_scans FROM holder_v h JOIN scans s
    ON h.wallet_id = s.wallet_id AND status_upd_dt <= event_ts WHERE visit_dt < {A} GROUP BY 1, 2""",
)
def status_scans(r: Bound):
    return status_group.status_scans(r.accounts, r.archive, r.scans, AS_OF)


@query(
    "status_users_series",
    f""", g AS (SELECT status_upd_dt, CASE WHEN {day('regtn_ts')} >= {STATUS_LAUNCH} THEN 'New to Rewards' ELSE 'Existed in Rewards' END
        AS new_rewards, COUNT(*) AS num_users FROM holder_v WHERE status_upd_dt < {A} GROUP BY 1, 2)
    SELECT g.*, (SELECT {total('num_users')} FROM g x WHERE x.status_upd_dt = g.status_upd_dt) AS total_users,
      (SELECT {total('num_users')} FROM g x WHERE x.status_upd_dt <= g.status_upd_dt AND x.new_rewards = g.new_rewards) AS cumu_users,
      (SELECT {total('num_users')} FROM g x WHERE x.status_upd_dt <= g.status_upd_dt) AS cumu_total_users FROM g""",
)
def status_users_series(r: Bound):
    return status_group.status_users_series(r.accounts, r.archive, AS_OF, SCHEME)
