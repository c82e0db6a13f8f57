"""Money, CRM, fuel, order and KPI queries."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from rolebook.oracle import A, E, LAUNCH, day, pounds, total
from rolebook.registry import Bound, query
from rolebook.roles import AS_OF, EVENTS_AS_OF, SCHEME
from stampbook.plans import campaigns, crm, fuel, jobs, money
from stampbook.sources import upsert

# --- vouchers ---


@query(
    "expired_vouchers",
    f"""SELECT cmpgn_id, {day('reward_end_ts')} AS reward_end_dt, CAST(NULL AS VARCHAR) AS store_nbr, COUNT(*) AS vouchers_expired,
    {pounds('COALESCE(value_pence, 0)')} AS voucher_value_pounds_expired, chnl_nm, acct_status_id
    FROM voucher_v WHERE reward_redm_ts IS NULL AND reward_end_ts < {A} GROUP BY cmpgn_id, {day('reward_end_ts')}, store_nbr, chnl_nm, acct_status_id""",
)
def expired_vouchers(r: Bound):
    return money.expired_vouchers(r.voucher_rows, AS_OF)


@query(
    "vouchers_daily",
    f"""SELECT cmpgn_id, {day('reward_gained_ts')} AS reward_gained_dt, {day('reward_redm_ts')} AS reward_redm_dt, store_nbr, chnl_nm, acct_status_id,
    COUNT(reward_redm_ts) AS vouchers_redeemed, {pounds('CASE WHEN reward_redm_ts IS NOT NULL THEN value_pence ELSE 0 END')} AS voucher_value_pounds_redeemed,
    COUNT(*) AS vouchers_created, {pounds('value_pence')} AS voucher_value_pounds_created,
    CAST(NULL AS BIGINT) AS vouchers_expired, CAST(NULL AS DOUBLE) AS voucher_value_pounds_expired FROM voucher_v GROUP BY 1, 2, 3, 4, 5, 6""",
)
def vouchers_daily(r: Bound):
    return money.vouchers_daily(r.voucher_rows)


@query(
    "vouchers_by_value",
    """SELECT c.*, n AS num_ppl_redeemed FROM (SELECT voucher_value_pounds, COUNT(wallet_id) AS num_ppl_create FROM voucher_v GROUP BY 1) c
    JOIN (SELECT voucher_value_pounds AS v, COUNT(wallet_id) AS n FROM voucher_v WHERE reward_redm_ts IS NOT NULL GROUP BY 1)
      ON voucher_value_pounds = v""",
)
def vouchers_by_value(r: Bound):
    return money.vouchers_by_value(r.voucher_rows)


@query(
    "vouchers_by_size",
    """SELECT CASE WHEN voucher_value_pounds <= 1.1 THEN CAST(voucher_value_pounds AS VARCHAR) WHEN voucher_value_pounds > 1.1 THEN '1.1+' END
      AS voucher_value_pounds, COUNT(wallet_id) AS num_ppl
    FROM (SELECT wallet_id, voucher_value_pounds, reward_redm_ts FROM voucher_v) WHERE reward_redm_ts IS NOT NULL GROUP BY 1""",
)
def vouchers_by_size(r: Bound):
    return money.vouchers_by_size(r.voucher_rows, cap=1.1)


@query(
    "voucher_hold_time",
    """, t AS (SELECT wallet_id, date_diff('second', reward_gained_ts, reward_redm_ts) / 60 AS m FROM voucher_v WHERE reward_redm_ts IS NOT NULL)
    SELECT label AS time_held_category, i AS time_held_category_order, COUNT(wallet_id) AS num_vouchers FROM t JOIN (VALUES
      (-1e18, 5, 1, 'Less than 5 minutes'), (5, 30, 2, '5-29 minutes'), (30, 60, 3, '30 minutes -59 minutes'), (60, 300, 4, '1-5 hours'),
      (300, 1440, 5, '5-24 hours'), (1440, 2880, 6, '1-2 days'), (2880, 7200, 7, '2-5 days'), (7200, 1e18, 8, '5 days +')) AS b(lo, hi, i, label)
      ON m >= lo AND m < hi GROUP BY 1, 2""",
)
def voucher_hold_time(r: Bound):
    return money.voucher_hold_time(r.voucher_rows)


@query(
    "voucher_orders",
    """SELECT singl_profl_id, promo_id, p.web_order_id, disc_coupn_cd, order_status_nm, evouch_tot_amt, dlvr_dt, src_create_ts, promo_nm, pos_tot_amt
    FROM order_promos p JOIN online_orders o ON p.web_order_id = o.web_order_id WHERE disc_coupn_cd IS NOT NULL AND seq_nbr = 1""",
)
def voucher_orders(r: Bound):
    return money.voucher_orders(r.order_promos, r.online_orders)


@query(
    "voucher_shortfall",
    f""", g AS (SELECT order_id, order_dlvr_dt, singl_profl_userid, {day('upd_ts')} AS rfnd_dt, SUM(rfnd_amt) AS amt FROM refunds
      WHERE rfnd_status_cd IS NULL OR rfnd_status_cd = 'COMPLETE' GROUP BY 1, 2, 3, 4)
    SELECT s.wallet_id, o.singl_profl_id AS spid, a.loyalty_id, o.web_order_id AS order_id, s.visit_dt AS delivery_date, rfnd_dt AS refund_date,
      {pounds('disc_amt')} AS rewards_voucher_val, CAST(amt - web_order_tot_amt AS DOUBLE) AS credit_amt, {A} AS today_date,
      CASE WHEN CAST(amt - web_order_tot_amt AS DOUBLE) < {pounds('disc_amt')} THEN 1 ELSE 0 END AS credit_indicator
    FROM scans s JOIN online_orders o ON s.trans_rcpt_nbr = o.web_order_id JOIN g ON g.order_id = o.web_order_id
    JOIN reward_wallets w ON w.wallet_id = s.wallet_id AND w.reward_redm_ts = s.event_ts AND w.reward_status_desc = 'USED' AND w.rec_status_ind = 'CURRENT'
    JOIN campaign_versions c ON c.cmpgn_id = w.cmpgn_id AND c.cmpgn_clsfctn_nm = 'COUPON' AND c.cmpgn_status_desc = 'ACTIVE'
      AND c.rec_status_ind = 'CURRENT' AND c.disc_amt > 0
    LEFT JOIN accounts a ON a.wallet_id = s.wallet_id
    WHERE s.chnl_nm = 'ecom' AND order_status_nm <> 'CANCELLED' AND dlvr_dt > {LAUNCH} AND amt > 0 AND amt > web_order_tot_amt
    GROUP BY s.wallet_id, o.singl_profl_id, a.loyalty_id, o.web_order_id, s.event_ts, s.visit_dt, web_order_tot_amt, amt, rfnd_dt""",
)
def voucher_shortfall(r: Bound):
    return money.voucher_shortfall(
        r.scans, r.refunds, r.online_orders, r.reward_wallets, r.campaign_versions, r.accounts, AS_OF, SCHEME.launch
    )


# --- credits, games, pots ---


@query(
    "bulk_upload",
    f"""SELECT {day('event_ts')} AS load_dt, CASE WHEN event_ts < DATE '{SCHEME.reference_prefix_change}' THEN substr(ref_id, 1, 10)
      ELSE substr(ref_id, 1, 20) END AS ref_camp, COUNT(wallet_id) AS volume, {pounds('trans_amt')} AS amount
    FROM external_credits WHERE chnl_nm <> 'Card' GROUP BY 1, 2""",
)
def bulk_upload(r: Bound):
    return money.bulk_upload(r.external_credits, SCHEME)


@query(
    "card_credits",
    f"""SELECT {day('trans_ts')} AS trans_dt, round({pounds('trans_amt')}, 2) AS sum_trans_amt FROM external_credits
    WHERE chnl_nm LIKE 'Card%' GROUP BY 1""",
)
def card_credits(r: Bound):
    return money.card_credits(r.external_credits, SCHEME)


@query(
    "goodwill",
    f"SELECT {day('event_ts')} AS event_dt, round({pounds('cr_pnts_qty')}, 2) AS goodwill_amt FROM credits WHERE event_nm = 'GOODWILL' GROUP BY 1",
)
def goodwill(r: Bound):
    return money.goodwill(r.credits)


@query(
    "game_giveaway",
    f"""SELECT *, game_win_pounds * customer_count AS giveaway FROM (SELECT {day('game_redm_ts')} AS game_redm_dt,
      round(CAST(game_win_val AS DOUBLE) / 100, 2) AS game_win_pounds, COUNT(*) AS customer_count
      FROM games WHERE rec_status_ind = 'CURRENT' AND game_redm_ts < {E} GROUP BY 1, game_win_val)""",
)
def game_giveaway(r: Bound):
    return money.game_giveaway(r.games, EVENTS_AS_OF)


@query(
    "game_spins",
    f"""SELECT {day('game_start_ts')} AS game_start_dt, COUNT(*) AS customer_count FROM games
    WHERE rec_status_ind = 'CURRENT' AND game_start_ts < {E} GROUP BY 1""",
)
def game_spins(r: Bound):
    return money.game_spins(r.games, EVENTS_AS_OF)


@query(
    "supplier_billing",
    f"""SELECT * EXCLUDE (prime_item_nbr, prime_product_variant), CAST(cmpgn_rdmpt_val AS DOUBLE) / 100 AS coupon_cashpot_given,
    CAST(prime_item_nbr AS VARCHAR) AS prime_item_nbr, upper(substr(prime_product_variant, 1, 1)) || lower(substr(prime_product_variant, 2))
      AS prime_product_variant, {day('cmpgn_start_ts')} AS cmpgn_start_dt, {day('cmpgn_end_ts')} AS cmpgn_end_ds,
    CAST(NULL AS DOUBLE) AS funding, CAST(NULL AS DOUBLE) AS owed FROM supplier_bill""",
)
def supplier_billing(r: Bound):
    return money.supplier_billing(r.supplier_bill)


_TRANSFERS = f""", t AS (SELECT m.*, {day('trans_ts')} AS trans_dt, b1.scheme_id AS src_scheme_id, p1.cashpot_nm AS src_cashpot_nm,
      b2.scheme_id AS dest_scheme_id, p2.cashpot_nm AS dest_cashpot_nm
    FROM pot_moves m JOIN pot_balances_role b1 ON b1.cashpot_id = m.cashpot_id_src JOIN pot_setup p1 ON p1.scheme_id = b1.scheme_id
    JOIN pot_balances_role b2 ON b2.cashpot_id = m.cashpot_id_dest JOIN pot_setup p2 ON p2.scheme_id = b2.scheme_id
    WHERE rsn_cd = 'TRANSFER' AND p1.rec_status_ind = 'CURRENT' AND p2.rec_status_ind = 'CURRENT')"""
_PAIR = "trans_dt, src_scheme_id, src_cashpot_nm, dest_scheme_id, dest_cashpot_nm"


@query(
    "pot_transfers",
    f"""{_TRANSFERS} SELECT {_PAIR}, {pounds('cashpot_val_dest')} AS amt_transfered, COUNT(wallet_id_dest) AS num_transfers,
    COUNT(DISTINCT wallet_id_dest) AS num_people FROM t WHERE trans_dt < {A} GROUP BY ALL""",
)
def pot_transfers(r: Bound):
    return money.pot_transfers(r.pot_moves, r.pot_balances_role, r.pot_setup, AS_OF)


@query(
    "pot_first_users",
    f"""{_TRANSFERS} SELECT {_PAIR}, COUNT(DISTINCT wallet_id_dest) AS num_first_users FROM (SELECT *, row_number() OVER
      (PARTITION BY wallet_id_dest ORDER BY trans_ts, src_scheme_id, dest_scheme_id) AS n FROM t) WHERE n = 1 AND trans_dt < {A} GROUP BY ALL""",
)
def pot_first_users(r: Bound):
    return money.pot_first_users(r.pot_moves, r.pot_balances_role, r.pot_setup, AS_OF)


@query(
    "pot_balances",
    f"""SELECT b.scheme_id, cashpot_nm, {pounds('curr_cash_bnk_pnts_qty')} AS total_cashpot, COUNT(DISTINCT wallet_id) AS users
    FROM pot_balances_role b JOIN pot_setup p ON b.scheme_id = p.scheme_id WHERE rec_status_ind = 'CURRENT' AND curr_cash_bnk_pnts_qty <> 0
    GROUP BY 1, 2""",
)
def pot_balances(r: Bound):
    return money.pot_balances(r.pot_balances_role, r.pot_setup)


@query(
    "pot_thresholds",
    f""", l AS (SELECT curr_cash_bnk_pnts_qty AS q FROM accounts WHERE acct_status_id = 'DEFAULT' OR (acct_status_id = 'TEMP' AND regtn_ts >= {A} - 37))
    {' UNION ALL '.join(f'''SELECT 'Current cashpot greater than (or equal to) £{p}' AS "desc", COUNT(*) FILTER (WHERE q >= {p}00) AS num_wallets,
      CAST(COUNT(*) FILTER (WHERE q >= {p}00) AS DOUBLE) / COUNT(*) AS percentage_of_total,
      CAST(SUM(CASE WHEN q >= {p}00 THEN q ELSE 0 END) AS DOUBLE) / 100 AS curr_cashpot FROM l''' for p in (10, 20))}""",
)
def pot_thresholds(r: Bound):
    return money.pot_thresholds(r.accounts, AS_OF, scheme=SCHEME)


@query(
    "saver_bands",
    """SELECT i AS index, label AS cashpot, boost, COUNT(DISTINCT wallet_id) AS customer_count, COUNT(DISTINCT wallet_id) * boost AS boost_cost
    FROM pot_balances_role JOIN (VALUES (-1e18, 1000, '1', '<£10', 0), (1000, 2000, '2', '£10-£19.99', 1), (2000, 2500, '3', '£20-£24.99', 2),
      (2500, 4000, '4', '£25-£39.99', 3), (4000, 5000, '5', '£40-£49.99', 5), (5000, 6000, '6', '£50-£59.99', 5),
      (6000, 7000, '7', '£60-£69.99', 5), (7000, 1e18, '8', '>=£70', 5)) AS b(lo, hi, i, label, boost)
      ON curr_cash_bnk_pnts_qty >= lo AND curr_cash_bnk_pnts_qty < hi
    WHERE scheme_id = 7 AND curr_cash_bnk_pnts_qty <> 0 GROUP BY i, label, boost""",
)
def saver_bands(r: Bound):
    return money.saver_bands(r.pot_balances_role, SCHEME)


def _month(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m')"


@query(
    "liability",
    f""", l AS (
      SELECT CASE cmpgn_id WHEN {SCHEME.status_campaign} THEN 2 ELSE 1 END AS i, {_month('cmpgn_cmplt_ts')} AS dt, SUM(mission_value_pence) AS p FROM completion_v GROUP BY 1, 2
      UNION ALL SELECT 3, {_month('event_ts')}, SUM(cr_pnts_qty) FROM credits WHERE event_nm = 'GOODWILL' GROUP BY 2
      UNION ALL SELECT 4, {_month('event_ts')}, SUM(trans_amt) FROM external_credits WHERE chnl_nm LIKE 'Card%' GROUP BY 2
      UNION ALL SELECT 5, {_month('event_ts')}, SUM(trans_amt) FROM external_credits WHERE chnl_nm NOT LIKE 'Card%' GROUP BY 2
      UNION ALL SELECT CASE WHEN acct_status_id = 'DEFAULT' THEN 6 ELSE 7 END, {_month('event_ts')}, COALESCE(SUM(cashpot_val_exp), 0)
        FROM pot_expiries x LEFT JOIN account_v a ON a.wallet_id = x.wallet_id GROUP BY 1, 2
      UNION ALL SELECT 8, {_month('reward_gained_ts')}, SUM(value_pence) FROM voucher_v GROUP BY 2
      UNION ALL SELECT 9, {_month('reward_end_ts')}, -SUM(COALESCE(value_pence, 0)) FROM voucher_v WHERE reward_redm_ts IS NULL AND reward_end_ts < {A} GROUP BY 2
      UNION ALL SELECT 10, {_month('reward_redm_ts')}, -SUM(value_pence) FROM voucher_v WHERE reward_redm_ts IS NOT NULL GROUP BY 2),
    n(i, type) AS (VALUES (1, 'total cashpot from campaigns (excl. Status Group) (historic)'), (2, 'total cashpot from Status Group (historic)'),
      (3, 'goodwill (historic)'), (4, 'credit cards'), (5, 'colleague incentive (historic)'), (6, 'Expired from cashpots (Default)'),
      (7, 'Expired from cashpots (TEMP)'), (8, 'vouchers created (historic)'), (9, 'vouchers expired (historic)'), (10, 'vouchers redeemed (historic)'),
      (11, 'Liability remaining')),
    z AS (SELECT i, dt, p FROM l UNION ALL SELECT 11, dt, SUM(p) FROM l WHERE i <> 8 GROUP BY dt)
    SELECT z.i AS index, n.type, CAST(p AS DOUBLE) / 100 AS val, dt FROM z JOIN n ON n.i = z.i""",
)
def liability(r: Bound):
    return money.liability(
        r.completion_totals, r.credits, r.external_credits, r.pot_expiries, r.account_rows, r.voucher_totals, AS_OF, SCHEME
    )


# --- CRM ---

SEND_START, SEND_END = date(1995, 5, 1), date(2001, 5, 1)
MIN_CUSTOMERS = 12
_FRAMES = (("Pre", 42, "o.d >= s.d - 42 AND o.d < s.d"), ("Post", 15, "o.d >= s.d AND o.d <= s.d + 14"))


def crm_sql(key: str, channels: dict[str, str], span: tuple[date, date]) -> str:
    """All groups of the sends in a span; ``channels`` maps a name to a SELECT of k, d, id, items, sales."""
    ctes = [
        f""", s AS (SELECT {day('eventdate')} AS d, campaignname AS j, CASE sendtype WHEN 'Send' THEN 'Emailed' ELSE sendtype END AS g, {key} AS k
        FROM sends WHERE {day('eventdate')} BETWEEN DATE '{span[0]}' AND DATE '{span[1]}' AND campaignname NOT LIKE '%CashpotExpiry%'
          AND campaignname NOT LIKE '%Abandoned%' AND campaignname NOT LIKE '%Triggers%')"""
    ]
    halves = []
    for frame, days, window in _FRAMES:
        parts, columns = [], []
        for name, orders in channels.items():
            cte = f"{name}_{frame}".lower()
            ctes.append(
                f"""{cte} AS (SELECT s.d, j, g, COUNT(DISTINCT s.k) AS customers, COUNT(DISTINCT o.k) AS orderers, COUNT(o.id) AS orders,
                CAST(SUM(o.items) AS DOUBLE) AS items, CAST(SUM(o.sales) AS DOUBLE) AS sales
                FROM s LEFT JOIN ({orders}) o ON o.k = s.k AND {window} GROUP BY s.d, j, g)"""
            )
            first = not parts
            parts.append(cte if first else f"JOIN {cte} USING (d, j, g)")
            columns.append(
                f"""{cte}.orderers AS {name}_orderers, {cte}.orders AS {name}_orders, {cte}.items AS {name}_items, {cte}.sales AS {name}_sales,
                CAST({cte}.orderers AS DOUBLE) / {cte}.customers AS {name}_orderers_mailed, {cte}.sales / NULLIF({cte}.orders, 0) AS {name}_avg_order,
                CAST({cte}.orders AS DOUBLE) / NULLIF({cte}.orderers, 0) AS {name}_orders_orderers, {cte}.sales / {cte}.customers AS {name}_sales_mailed,
                {cte}.items / NULLIF({cte}.orders, 0) AS {name}_items_order"""
            )
        lead = f"{next(iter(channels))}_{frame}".lower()
        halves.append(
            f"""SELECT '{frame}' AS type, {days} AS days_analysed, 1234 AS journey_id, j AS journey_name, g AS groups, d AS journey_date,
            {lead}.customers AS customers, {', '.join(columns)} FROM {' '.join(parts)}"""
        )
    return f"{', '.join(ctes)}, r AS ({' UNION ALL '.join(halves)}) SELECT * FROM r"


def _crm_sql(key: str, channels: dict[str, str]) -> str:
    whole = crm_sql(key, channels, (SEND_START, SEND_END)).removesuffix(" SELECT * FROM r")
    return f"""{whole}, k2 AS (SELECT * FROM r WHERE customers >= {MIN_CUSTOMERS})
    SELECT * FROM k2 WHERE journey_name NOT IN (SELECT journey_name FROM k2 GROUP BY journey_date, journey_name HAVING COUNT(DISTINCT groups) <> 2)"""


def _crm(r: Bound, key: str, channels: dict):
    sends = crm.journeys(r.sends, SEND_START, SEND_END, key)
    return crm.prune_journeys(crm.crm_send_level(sends, channels), min_customers=MIN_CUSTOMERS)


def _fashion(r: Bound, key: str):
    return crm.channel_orders(
        r.fashion_orders, "order_id", key, "creation_date", "sum_order_quantity", "total_order_value", (SEND_START, SEND_END)
    )


_FASHION_SQL = f"SELECT {{}} AS k, {day('creation_date')} AS d, order_id AS id, sum_order_quantity AS items, total_order_value AS sales FROM (SELECT DISTINCT * FROM fashion_orders)"


@query(
    "crm_send_level",
    _crm_sql(
        "spid",
        {
            "fashion": _FASHION_SQL.format("spid"),
            "grocery": f"SELECT spid AS k, {day('order_sbmtd_ts')} AS d, web_order_id AS id, item_qty AS items, pos_tot_amt AS sales FROM grocery_orders",
        },
    ),
)
def crm_send_level(r: Bound):
    grocery = crm.channel_orders(
        r.grocery_orders, "web_order_id", "spid", "order_sbmtd_ts", "item_qty", "pos_tot_amt", (SEND_START, SEND_END)
    )
    return _crm(r, "spid", {"fashion": _fashion(r, "spid"), "grocery": grocery})


@query(
    "crm_send_level_store",
    _crm_sql(
        "walletid",
        {"store": "SELECT wallet_id AS k, visit_dt AS d, basket_id AS id, reg_nbr AS items, sale_amt_inc_vat AS sales FROM scans WHERE chnl_nm = 'store'"},
    ),
)
def crm_send_level_store(r: Bound):
    store = crm.channel_orders(
        r.scans.filter("chnl_nm = 'store'"), "basket_id", "wallet_id", "event_ts", "reg_nbr", "sale_amt_inc_vat", (SEND_START, SEND_END)
    )
    return _crm(r, "walletid", {"store": store})


@query("crm_send_level_fashion", _crm_sql("walletid", {"fashion": _FASHION_SQL.format("walletid")}))
def crm_send_level_fashion(r: Bound):
    return _crm(r, "walletid", {"fashion": _fashion(r, "walletid")})


_PERIODS = """CASE WHEN w % 100 BETWEEN 1 AND 4 THEN '1-4' WHEN w % 100 BETWEEN 5 AND 8 THEN '5-8' WHEN w % 100 BETWEEN 9 AND 13 THEN '9-13'
    WHEN w % 100 BETWEEN 14 AND 17 THEN '14-17' WHEN w % 100 BETWEEN 18 AND 21 THEN '18-21' WHEN w % 100 BETWEEN 22 AND 26 THEN '22-26'
    WHEN w % 100 BETWEEN 27 AND 30 THEN '27-30' WHEN w % 100 BETWEEN 31 AND 34 THEN '31-34' WHEN w % 100 BETWEEN 35 AND 39 THEN '35-39'
    WHEN w % 100 BETWEEN 40 AND 43 THEN '40-43' WHEN w % 100 BETWEEN 44 AND 47 THEN '44-47' WHEN w % 100 BETWEEN 48 AND 52 THEN '48-52' ELSE '0' END"""
_PHASE = "CASE WHEN w BETWEEN 199540 AND 199552 THEN 'Pre' WHEN w > 199552 THEN 'Post' END"
PRE_WEEKS = (199540, 199552)


def monthly_sql(channel_name: str, orders: str, condition: str = "TRUE") -> str:
    return f"""SELECT control_group, segment, w AS week_id, {_PERIODS} AS periods, '{channel_name}' AS channel, {_PHASE} AS analysis_type,
    COUNT(DISTINCT k) AS orderers, COUNT(id) AS orders, CAST(SUM(sales) AS DOUBLE) AS sales
    FROM control_population c JOIN (SELECT x.*, retail_week AS w FROM ({orders}) x JOIN calendar ON d = day_date WHERE retail_week > 199539 AND {condition}) o
      ON o.k = c.spid GROUP BY control_group, segment, w"""


@query(
    "crm_monthly_online",
    monthly_sql("online", "SELECT order_id AS id, spid AS k, sales, order_day AS d FROM week_orders"),
)
def crm_monthly_online(r: Bound):
    return crm.crm_monthly(r.control_population, r.week_orders, r.calendar, "online", 199539, PRE_WEEKS)


@query(
    "crm_monthly_fashion",
    monthly_sql("fashion", "SELECT order_id AS id, spid AS k, sales, order_day AS d FROM fashion_weeks"),
)
def crm_monthly_fashion(r: Bound):
    return crm.crm_monthly(r.control_population, r.fashion_weeks, r.calendar, "fashion", 199539, PRE_WEEKS)


@query(
    "store_test_vs_control",
    f""", s AS (SELECT x.*, retail_week AS w FROM scans x JOIN calendar ON visit_dt = day_date WHERE chnl_nm = 'store' AND retail_week > 199539),
    c AS (SELECT wallet_id, w, COUNT(trans_nbr) AS visits, round(CAST(SUM(sale_amt_inc_vat) AS DOUBLE), 2) AS sales FROM s GROUP BY 1, 2),
    t AS (SELECT w, round(AVG(CAST(sale_amt_inc_vat AS DOUBLE)), 2) AS mu, round(stddev_samp(CAST(sale_amt_inc_vat AS DOUBLE)), 2) AS sd FROM s GROUP BY 1)
    SELECT control_group, c.w AS week_id, {_PERIODS.replace('w %', 'c.w %')} AS periods, {_PHASE.replace('w >', 'c.w >').replace('w BETWEEN', 'c.w BETWEEN')} AS analysis_type,
      segment, 'store' AS channel, COUNT(p.spid) AS orderers, {total('visits')} AS orders,
      round(SUM(CASE WHEN sales < mu - 1.5 * sd OR sales > mu + 1.5 * sd THEN mu * visits ELSE sales END), 2) AS new_sales, round(SUM(sales), 2) AS sales
    FROM control_population p JOIN accounts a ON a.singl_profl_id = p.spid JOIN c ON c.wallet_id = a.wallet_id JOIN t ON t.w = c.w
    GROUP BY control_group, segment, c.w""",
)
def store_test_vs_control(r: Bound):
    return crm.store_test_vs_control(
        r.control_population, r.accounts, r.scans, r.calendar, PRE_WEEKS[0], PRE_WEEKS, sigmas=1.5
    )


# --- fuel ---

FUEL_START = date(1996, 1, 1)
FUEL_OUTAGE = (date(1996, 3, 1), date(1996, 3, 6))
_FUEL = f""", ln AS (SELECT *, abs(TRY_CAST(sales_adj AS DOUBLE)) AS adj FROM fuel_lines WHERE upc_nbr LIKE '%FUEL%'
      AND visit_dt BETWEEN DATE '{FUEL_START}' - 91 AND {A} - 1 AND visit_dt NOT BETWEEN DATE '{FUEL_OUTAGE[0]}' AND DATE '{FUEL_OUTAGE[1]}'),
    tp AS (SELECT DISTINCT visit_dt, trans_nbr, reg_nbr, store_nbr, store_type, wallet_id, upc_nbr, sale_amt_inc_vat, qty, adj FROM (SELECT *,
      rank() OVER (PARTITION BY visit_dt, trans_nbr, store_nbr, reg_nbr ORDER BY adj DESC NULLS LAST) AS rk FROM ln) WHERE rk = 1),
    v AS MATERIALIZED (SELECT retail_week AS wk, visit_dt, trans_nbr, reg_nbr, store_nbr, wallet_id,
        CASE upc_nbr WHEN 'FUEL1' THEN 'petrol' WHEN 'FUEL2' THEN 'diesel' WHEN 'FUEL0' THEN 'other_fuel' WHEN 'FUEL3' THEN 'other_fuel' ELSE 'non_fuel' END AS prod_type,
        CASE WHEN wallet_id IS NULL THEN 0 ELSE 1 END AS ar, SUM(sale_amt_inc_vat) AS sales, SUM(qty) AS units, SUM(adj) AS earn
      FROM tp LEFT JOIN calendar ON visit_dt = day_date GROUP BY ALL),
    rc AS (SELECT * FROM forecourt_scans),
    r1 AS (SELECT DISTINCT wallet_id, visit_dt, trans_nbr, reg_nbr FROM (SELECT *, rank() OVER (PARTITION BY wallet_id ORDER BY visit_dt, trans_nbr, reg_nbr) AS rk FROM rc) WHERE rk = 1),
    r2 AS (SELECT DISTINCT wallet_id, visit_dt, trans_nbr, reg_nbr FROM (SELECT *, rank() OVER (PARTITION BY wallet_id ORDER BY visit_dt, trans_nbr, reg_nbr) AS rk
      FROM v WHERE wallet_id IS NOT NULL) WHERE rk = 1),
    sv AS MATERIALIZED (SELECT rc.wallet_id, rc.visit_dt AS d, tot_visit_amt, tot_scan_cnt FROM rc JOIN store_visits s
      ON s.visit_dt = rc.visit_dt AND s.trans_nbr = rc.trans_nbr AND s.reg_nbr = rc.reg_nbr
      WHERE chnl_nm = 'store' AND trans_rcpt_nbr NOT LIKE '%ZD%' AND rc.visit_dt BETWEEN DATE '{FUEL_START}' - 91 AND {A} - 1),
    cs AS (SELECT f.wallet_id, f.visit_dt, {', '.join(f"COUNT(*) FILTER (WHERE {w}) AS n{i}, CAST(SUM(tot_visit_amt) FILTER (WHERE {w}) AS DOUBLE) / NULLIF(COUNT(*) FILTER (WHERE {w}), 0) AS spv{i}" for i, w in enumerate(("d = visit_dt", "d < visit_dt AND d >= visit_dt - 7", "d < visit_dt - 7 AND d >= visit_dt - 30", "d < visit_dt - 30 AND d >= visit_dt - 91")))}
      FROM (SELECT DISTINCT wallet_id, visit_dt FROM v WHERE wallet_id IS NOT NULL) f JOIN sv ON sv.wallet_id = f.wallet_id AND sv.d <= f.visit_dt GROUP BY 1, 2),
    x AS MATERIALIZED (SELECT v.*, CASE WHEN r1.wallet_id IS NOT NULL THEN 1 END AS first_scan, CASE WHEN r2.wallet_id IS NOT NULL THEN 1 END AS first_fuel,
        CASE WHEN n0 > 0 THEN 1 WHEN n0 = 0 THEN 0 END AS f0, CASE WHEN n0 = 0 AND n1 > 0 THEN 1 WHEN n0 >= 0 THEN 0 END AS f1,
        CASE WHEN n0 + n1 = 0 AND n2 > 0 THEN 1 WHEN n0 >= 0 THEN 0 END AS f2, CASE WHEN n0 + n1 + n2 = 0 AND n3 > 0 THEN 1 WHEN n0 >= 0 THEN 0 END AS f3,
        spv0, spv1, spv2, spv3
      FROM v LEFT JOIN r1 USING (wallet_id, visit_dt, trans_nbr, reg_nbr) LEFT JOIN r2 USING (wallet_id, visit_dt, trans_nbr, reg_nbr)
      LEFT JOIN cs ON cs.wallet_id = v.wallet_id AND cs.visit_dt = v.visit_dt)"""


def _fuel(r: Bound) -> fuel.FuelReports:
    return fuel.fuel_cross_shop(
        r.fuel_lines, r.forecourt_scans, r.store_visits, r.calendar, AS_OF, "7", FUEL_START, FUEL_OUTAGE
    )


_RECEIPT = "(visit_dt, trans_nbr, reg_nbr, store_nbr)"
_NAMES = ("1d", "7d", "30d", "13wk")


@query(
    "fuel_customers",
    f"""{_FUEL}, y AS (SELECT wallet_id, COUNT(DISTINCT wk) AS shopped_weeks, COUNT(DISTINCT {_RECEIPT}) AS total_visits,
      CAST(SUM(sales) AS DOUBLE) AS total_sales, CAST(SUM(units) AS DOUBLE) AS total_units, CAST(SUM(sales) AS DOUBLE) AS ar_sales,
      CAST(SUM(units) AS DOUBLE) AS ar_units, {total('ar')} AS ar_visits, SUM(earn) AS earn, {total('first_scan')} AS first_ar_visit,
      {', '.join(f"MAX(CASE WHEN visit_dt BETWEEN {A} - {k} AND {A} - 1 THEN 1 ELSE 0 END) AS active_{n}" for n, k in (('1d', 1), ('7d', 8), ('30d', 31), ('13wk', 92)))},
      {', '.join(f"CASE WHEN COUNT(f{i}) > 0 THEN COUNT(DISTINCT CASE WHEN f{i} = 1 THEN {_RECEIPT} END) END AS fv_cross_shop_{n}" for i, n in enumerate(_NAMES))}
      FROM x WHERE wallet_id IS NOT NULL GROUP BY wallet_id)
    SELECT *, CASE WHEN fv_cross_shop_1d > 0 THEN 1 ELSE 0 END AS cust_cross_shop_1d,
      CASE WHEN fv_cross_shop_1d = 0 AND fv_cross_shop_7d > 0 THEN 1 ELSE 0 END AS cust_cross_shop_7d,
      CASE WHEN fv_cross_shop_1d + fv_cross_shop_7d = 0 AND fv_cross_shop_30d > 0 THEN 1 ELSE 0 END AS cust_cross_shop_30d,
      CASE WHEN fv_cross_shop_1d + fv_cross_shop_7d + fv_cross_shop_30d = 0 AND fv_cross_shop_13wk > 0 THEN 1 ELSE 0 END AS cust_cross_shop_13wk FROM y""",
)
def fuel_customers(r: Bound):
    return _fuel(r).customers


@query("fuel_products", f"{_FUEL} SELECT prod_type, COUNT(DISTINCT wallet_id) AS eof_custs FROM x GROUP BY 1")
def fuel_products(r: Bound):
    return _fuel(r).products


@query(
    "fuel_visit_days",
    f"""{_FUEL} SELECT store_nbr, visit_dt, prod_type, COUNT(DISTINCT wallet_id) AS eof_custs,
    COUNT(DISTINCT CASE WHEN first_fuel = 1 THEN wallet_id END) AS dist_eof_custs, COUNT(DISTINCT {_RECEIPT}) AS visits,
    CAST(SUM(sales) AS DOUBLE) AS total_sales, CAST(SUM(units) AS DOUBLE) AS total_units, COUNT(DISTINCT CASE WHEN ar = 1 THEN {_RECEIPT} END) AS ar_visits,
    CAST(SUM(CASE WHEN ar = 1 THEN sales ELSE 0 END) AS DOUBLE) AS ar_sales, CAST(SUM(CASE WHEN ar = 1 THEN units ELSE 0 END) AS DOUBLE) AS ar_units,
    COUNT(DISTINCT CASE WHEN ar = 0 THEN {_RECEIPT} END) AS non_ar_visits, CAST(SUM(CASE WHEN ar = 0 THEN sales ELSE 0 END) AS DOUBLE) AS non_ar_sales,
    CAST(SUM(CASE WHEN ar = 0 THEN units ELSE 0 END) AS DOUBLE) AS non_ar_units, SUM(earn) AS earn, {total('first_scan')} AS new_signup,
    {', '.join(f"{total(f'f{i}')} AS cross_shop_{n}, SUM(spv{i}) AS cs_spv_{n}" for i, n in enumerate(_NAMES))}
    FROM x WHERE visit_dt >= DATE '{FUEL_START}' GROUP BY store_nbr, visit_dt, prod_type""",
)
def fuel_visit_days(r: Bound):
    return _fuel(r).visits


# --- orders, opt-ins, KPIs, app usage ---

REGIONS = (
    ("West", ("1", "2", "3", "5", "8", "13"), date(1996, 6, 23), date(1996, 6, 23)),
    ("North", ("8", "21", "34"), date(1996, 5, 27), date(1996, 6, 23)),
)
DEFAULT_REGION = ("Main launch", date(1996, 8, 10), date(1996, 8, 10))


def participation_sql(delivered: str) -> str:
    return f""", t AS (SELECT dlvr_dt AS delivery_dt, {day('order_sbmtd_ts')} AS order_dt, outbase_store_id AS store_id,
        COUNT(DISTINCT web_order_id) AS total_orders, COUNT(DISTINCT trans_rcpt_nbr) AS reward_orders, COUNT(DISTINCT singl_profl_id) AS total_customers,
        COUNT(DISTINCT wallet_id) AS reward_customers, CAST(SUM(pos_tot_amt) AS DOUBLE) AS total_sales,
        CAST(SUM(CASE WHEN trans_rcpt_nbr IS NOT NULL THEN pos_tot_amt ELSE 0 END) AS DOUBLE) AS reward_sales,
        CASE WHEN outbase_store_id IN ('1', '2', '3', '5', '8', '13') THEN 'West' WHEN outbase_store_id IN ('8', '21', '34') THEN 'North' ELSE 'Main launch' END AS region
      FROM online_orders LEFT JOIN (SELECT trans_rcpt_nbr, wallet_id FROM order_scans) s ON trans_rcpt_nbr = web_order_id
      WHERE order_sbmtd_ts >= DATE '1996-01-01' AND dlvr_dt >= DATE '1996-02-01' AND dlvr_dt < {A} AND {delivered} GROUP BY 1, 2, 3)
    SELECT t.*, b.retail_week AS delivery_wk, c.retail_week AS order_wk FROM t JOIN calendar b ON b.day_date = delivery_dt JOIN calendar c ON c.day_date = order_dt
    WHERE (region = 'Main launch' AND order_dt > DATE '1996-08-10' AND delivery_dt > DATE '1996-08-10')
      OR (region = 'West' AND order_dt > DATE '1996-06-23' AND delivery_dt > DATE '1996-06-23')
      OR (region = 'North' AND order_dt > DATE '1996-05-27' AND delivery_dt > DATE '1996-06-23')"""


@query("order_participation", participation_sql("TRUE"))
def order_participation(r: Bound):
    return jobs.order_participation(
        r.online_orders, r.order_scans, r.calendar, REGIONS, DEFAULT_REGION, date(1996, 1, 1), date(1996, 2, 1), AS_OF
    )


@query(
    "opt_in_figures",
    f""", d AS (SELECT named_user, MAX(CASE notification_opt_in WHEN 'true' THEN 1 ELSE 0 END) AS p FROM device_file
      WHERE notification_opt_in IS NOT NULL GROUP BY 1),
    m AS (SELECT COALESCE(is_email_contactable = 'Y', FALSE) AS e, COALESCE(p, CASE push_notif_consent WHEN 'Y' THEN 1 ELSE 0 END) = 1 AS p,
        COALESCE(registration_channel = 'LOYALTY' OR {day('registration_date')} = {day('tnc_accepted_at_loyalty')}, FALSE) AS n
      FROM accounts a LEFT JOIN consents c ON c.singl_profl_id = a.singl_profl_id LEFT JOIN profiles f ON f.singl_profl_id = a.singl_profl_id
      LEFT JOIN contactable k ON k.single_profile_id = a.singl_profl_id LEFT JOIN d ON d.named_user = a.singl_profl_id
      WHERE acct_status_id = 'DEFAULT' AND {day('regtn_ts')} < {A})
    {' UNION ALL '.join(f'''SELECT '{name}' AS type, COUNT(*) AS total_spids, COUNT(*) FILTER (WHERE e OR p) AS num_opt_in,
      CAST(COUNT(*) FILTER (WHERE e OR p) AS DOUBLE) / COUNT(*) AS perc_opt_in, COUNT(*) FILTER (WHERE e) AS num_email_opt_in,
      CAST(COUNT(*) FILTER (WHERE e) AS DOUBLE) / COUNT(*) AS perc_email_opt_in, COUNT(*) FILTER (WHERE p) AS num_push_opt_in,
      CAST(COUNT(*) FILTER (WHERE p) AS DOUBLE) / COUNT(*) AS perc_push_opt_in FROM m WHERE {cond}''' for name, cond in (('all spids', 'TRUE'), ('new spids', 'n')))}""",
)
def opt_in_figures(r: Bound):
    return jobs.opt_in_figures(r.accounts, r.consents, r.profiles, r.contactable, r.device_file, AS_OF)


@query(
    "kpi_row",
    f"""SELECT {A} AS date, (SELECT AVG(rating) FROM ratings) AS app_rating,
    (SELECT COUNT(DISTINCT wallet_id) FROM scans WHERE visit_dt BETWEEN {A} - 91 AND {A} - 1) AS active_members,
    (SELECT COUNT(DISTINCT spid) FROM baskets WHERE {day('timestamp')} BETWEEN {A} - 91 AND {A} AND is_spid_connected AND is_active
      AND is_spid_connected_direct) AS active_connected_cust,
    (SELECT round({pounds('mission_value_pence')}, 2) FROM completion_v WHERE {day('cmpgn_cmplt_ts')} >= DATE '2001-01-01') AS invested_into_cashpot""",
)
def kpi_row(r: Bound):
    return jobs.kpi_row(
        r.scans, r.baskets, campaigns.missions_daily(r.completions), r.ratings, AS_OF, date(2001, 1, 1), SCHEME
    )


@query(
    "kpi_upsert",
    f"""SELECT visit_dt AS date, CAST(NULL AS DOUBLE) AS app_rating, COUNT(DISTINCT wallet_id) AS active_members, CAST(NULL AS BIGINT) AS active_connected_cust,
      CAST(NULL AS DOUBLE) AS invested_into_cashpot FROM scans WHERE visit_dt <> {A} GROUP BY 1
    UNION ALL SELECT {A}, (SELECT AVG(rating) FROM ratings), (SELECT COUNT(DISTINCT wallet_id) FROM scans WHERE visit_dt BETWEEN {A} - 91 AND {A} - 1),
      (SELECT COUNT(DISTINCT spid) FROM baskets WHERE {day('timestamp')} BETWEEN {A} - 91 AND {A} AND is_spid_connected AND is_active AND is_spid_connected_direct),
      (SELECT round({pounds('mission_value_pence')}, 2) FROM completion_v WHERE {day('cmpgn_cmplt_ts')} >= DATE '2001-01-01')""",
)
def kpi_upsert(r: Bound):
    older = (
        r.scans.groupBy(F.col("visit_dt").alias("date"))
        .agg(F.countDistinct("wallet_id").alias("active_members"))
        .withColumn("app_rating", F.lit(None).cast("double"))
        .withColumn("active_connected_cust", F.lit(None).cast("long"))
        .withColumn("invested_into_cashpot", F.lit(None).cast("double"))
    )
    return upsert(older, kpi_row(r), ["date"])


@query(
    "app_usage_merge",
    "SELECT o.*, clicks, removes FROM app_opens o JOIN app_engagement g ON g.date = o.date JOIN app_removes x ON x.date = o.date",
)
def app_usage_merge(r: Bound):
    return jobs.app_usage_merge(r.app_opens, r.app_engagement, r.app_removes)
