"""Campaign, mission, coupon and trading queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from rolebook.oracle import A, COUPONS, LAUNCH, MISSION_PENCE, NUMERIC, SCANNERS, TRADING, channel, day, pounds, total
from rolebook.registry import Bound, query
from rolebook.roles import AS_OF, SCHEME
from stampbook.plans import bases, campaigns, trading


def _initcap(c: str) -> str:
    """Words separated by single spaces."""
    return (
        f"array_to_string(list_transform(string_split({c}, ' '), "
        "lambda w: upper(substr(w, 1, 1)) || lower(substr(w, 2))), ' ')"
    )


@query(
    "campaign_setup",
    """SELECT cmpgn_id, cmpgn_nm, cmpgn_start_ts, cmpgn_end_ts, upd_ts, offr_type_desc, cmpgn_type_nm, cmpgn_tag_array, category,
    burn_earn, cmpgn_status_desc, pound_value, cmpgn_mode_nm, cmpgn_clsfctn_nm, coupn_exp_type_desc, activity_type, value_pence FROM setup_v""",
)
def campaign_setup(r: Bound):
    return r.setup


@query("vouchers", "SELECT * FROM voucher_v")
def vouchers(r: Bound):
    return r.voucher_rows


@query(
    "mission_completions",
    """SELECT wallet_id, cmpgn_id, cmpgn_seen_ts, cmpgn_cmplt_ts, rdmpt_cnt, mission_value_pounds_new, mission_value_pounds,
    mission_value_pence, store_nbr, rec_status_ind, chnl_nm, activity_type, cmplt_lst_wk, cmplt_prior_wk, cmplt_ytd, last_week_flag,
    acct_status_id FROM completion_v""",
)
def mission_completions(r: Bound):
    return r.completions


@query(
    "missions_daily",
    f"""SELECT cmpgn_id, {day('cmpgn_cmplt_ts')} AS cmpgn_cmplt_dt, store_nbr, chnl_nm, activity_type, acct_status_id,
    {total('rdmpt_cnt')} AS rdmpt_cnt, {pounds('mission_value_pence')} AS earn_value_gbp, CAST(NULL AS VARCHAR) AS expr
    FROM completion_v GROUP BY 1, 2, 3, 4, 5, 6""",
)
def missions_daily(r: Bound):
    return campaigns.missions_daily(r.completions)


def _activity_sql() -> str:
    d = day("cmpgn_cmplt_ts")
    week = f"{d} BETWEEN (SELECT end_date - 6 FROM last_week_v) AND (SELECT end_date FROM last_week_v)"
    before = f"{d} BETWEEN (SELECT end_date - 13 FROM last_week_v) AND (SELECT end_date - 7 FROM last_week_v)"

    def value(condition: str) -> str:
        return f"SUM(CASE WHEN {condition} THEN mission_value_pence END)"

    return f""", m AS MATERIALIZED (SELECT *, {week} AS in_week, {before} AS in_before, cmplt_lst_wk IS NOT NULL AS in_roll,
        cmplt_prior_wk IS NOT NULL AS in_prior FROM completion_v),
    sc AS (SELECT visit_dt FROM scans WHERE {NUMERIC} AND visit_dt >= {LAUNCH} AND visit_dt < {A}),
    n AS (SELECT (SELECT COUNT(*) FROM sc WHERE visit_dt BETWEEN {A} - 7 AND {A}) AS roll,
      (SELECT COUNT(*) FROM sc WHERE visit_dt BETWEEN (SELECT end_date - 6 FROM last_week_v) AND (SELECT end_date FROM last_week_v)) AS wk),
    tt AS (SELECT {value('in_roll')} AS roll, {value('in_week')} AS wk FROM m)
    SELECT activity_type, CAST({value('in_roll')} AS DOUBLE) / 100 AS rdmpt_val,
      CAST({value('in_roll')} AS DOUBLE) / (SELECT roll FROM tt) AS week_percentage_rdmpt_val,
      COUNT(DISTINCT CASE WHEN in_roll THEN wallet_id END) AS number_unique_completions,
      CAST(COUNT(DISTINCT CASE WHEN in_roll THEN wallet_id END) AS DOUBLE) / (SELECT roll FROM n) AS percentage_active_customers,
      CAST({value('cmplt_ytd = 1')} AS DOUBLE) / 100 AS ytd_total_sum, CAST({value('in_prior')} AS DOUBLE) / 100 AS pr_wk,
      CAST({value('in_week')} AS DOUBLE) / 100 AS rdmpt_val_last_week,
      CAST({value('in_week')} AS DOUBLE) / (SELECT wk FROM tt) AS week_percentage_rdmpt_val_last_week,
      COUNT(DISTINCT CASE WHEN in_week THEN wallet_id END) AS number_unique_completions_last_week,
      (SELECT wk FROM n) AS number_active_customers_last_week,
      COUNT(DISTINCT CASE WHEN in_week THEN wallet_id END) AS number_active_customers_per_area_last_week,
      CAST(COUNT(DISTINCT CASE WHEN in_week THEN wallet_id END) AS DOUBLE) / (SELECT wk FROM n) AS percentage_active_customers_last_week,
      CAST({value('cmplt_ytd = 1 AND last_week_flag = 1')} AS DOUBLE) / 100 AS ytd_total_sum_last_week,
      CAST({value('in_before')} AS DOUBLE) / 100 AS pr_wk_last_week
    FROM m WHERE activity_type IS NOT NULL GROUP BY activity_type HAVING bool_or(in_roll) AND bool_or(in_week)"""


@query("mission_activity", _activity_sql())
def mission_activity(r: Bound):
    return campaigns.mission_activity(r.completions, r.scans, r.last_week, AS_OF, SCHEME)


@query(
    "mission_participation",
    f""", b AS (SELECT COUNT(DISTINCT wallet_id) AS total FROM scans WHERE {NUMERIC} AND visit_dt BETWEEN {A} - 8 AND {A} - 2),
    m AS (SELECT * FROM missions WHERE {day('event_ts')} BETWEEN {A} - 8 AND {A} - 2),
    p AS (SELECT cmpgn_id, SUM(c) AS c, SUM(s) AS s FROM (SELECT cmpgn_id, wallet_id,
        MAX(CASE WHEN cmpgn_cmplt_ts IS NOT NULL THEN 1 ELSE 0 END) AS c,
        MAX(CASE WHEN cmpgn_cmplt_ts IS NULL AND progress_qty IS NOT NULL THEN 1 ELSE 0 END) AS s FROM m GROUP BY 1, 2)
      WHERE cmpgn_id IN (SELECT cmpgn_id FROM campaign_versions WHERE cmpgn_tag_array LIKE '%MISSION%' OR cmpgn_tag_array LIKE '%ACCA%')
      GROUP BY 1),
    z AS (SELECT cmpgn_id, 'Mission' AS mssn_type, 'active_perc' AS calc_type, CAST(s AS BIGINT) AS dist_cmplt FROM p
      UNION ALL SELECT cmpgn_id, 'Mission', 'redemption_perc', CAST(c AS BIGINT) FROM p
      UNION ALL SELECT cmpgn_id, 'SP', 'redemption_perc', COUNT(DISTINCT wallet_id) FROM m WHERE cmpgn_id IN (SELECT cmpgn_id
        FROM campaign_versions WHERE cmpgn_tag_array LIKE '%STARPRODUCT%' OR cmpgn_tag_array LIKE '%OPENSP') GROUP BY cmpgn_id)
    SELECT z.*, b.total, CAST(dist_cmplt AS DOUBLE) / b.total AS proportion FROM z, b""",
)
def mission_participation(r: Bound):
    active = bases.wallet_activity(r.scans, r.calendar, AS_OF, SCHEME)
    return campaigns.mission_participation(r.missions_with_progress, r.campaign_versions, active, AS_OF)


# campaigns that begin and end within a day, some within one; versions with other names run at other times


def timed(rows):
    """The rows with starts and ends moved by some minutes, and by 40 or 80 days where the name's length says so."""
    name = F.length("cmpgn_nm")
    days, early, late = name % 3 * 40, F.col("cmpgn_id") * 13 % 1440, F.col("cmpgn_id") * 29 % 1440 + name
    return rows.withColumns(
        {
            "cmpgn_start_ts": F.col("cmpgn_start_ts") + F.make_dt_interval(days, mins=early),
            "cmpgn_end_ts": F.col("cmpgn_end_ts") + F.make_dt_interval(days - F.when(F.col("cmpgn_id") % 2 == 0, 12).otherwise(0), mins=late),
        }
    )


def _timed(column: str) -> str:
    minutes = "cmpgn_id * 13 % 1440" if column == "cmpgn_start_ts" else "cmpgn_id * 29 % 1440 + length(cmpgn_nm)"
    back = "0" if column == "cmpgn_start_ts" else "CASE WHEN cmpgn_id % 2 = 0 THEN 12 ELSE 0 END"
    return f"{column} + INTERVAL 1 DAY * CAST(length(cmpgn_nm) % 3 * 40 - {back} AS INT) + INTERVAL 1 MINUTE * CAST({minutes} AS INT)"


@query(
    "mission_scanners",
    f""", c AS (SELECT DISTINCT cmpgn_id, {_timed('cmpgn_start_ts')} AS s, {_timed('cmpgn_end_ts')} AS e FROM setup_v WHERE upper(activity_type) IN ('ACCA', 'MISSION')
      AND upper(cmpgn_status_desc) IN ('ACTIVE', 'EXPIRED') AND CAST({_timed('cmpgn_start_ts')} AS DATE) >= {TRADING}),
    p AS (SELECT DISTINCT wallet_id, event_ts FROM timed_scans WHERE {day('event_ts')} >= {SCANNERS} AND {day('event_ts')} < {A}),
    w AS (SELECT DISTINCT wallet_id, cmpgn_id FROM missions WHERE rec_status_ind = 'CURRENT' AND cmpgn_seen_ts IS NOT NULL
      AND {day('event_ts')} >= {TRADING})
    SELECT c.cmpgn_id, COUNT(DISTINCT p.wallet_id) AS rewards_swipers, COUNT(DISTINCT w.wallet_id) AS rewards_swipers_delivered
    FROM c JOIN p ON event_ts BETWEEN s AND e LEFT JOIN w ON w.wallet_id = p.wallet_id AND w.cmpgn_id = c.cmpgn_id GROUP BY c.cmpgn_id""",
)
def mission_scanners(r: Bound):
    return campaigns.mission_scanners(timed(r.setup), r.timed_scans, r.missions, AS_OF, SCHEME)


@query(
    "mission_summary",
    f""", c AS (SELECT DISTINCT cmpgn_id, cmpgn_nm, activity_type, pound_value, value_pence, {day('cmpgn_start_ts')} AS s,
        {day('cmpgn_end_ts')} AS e FROM mission_campaign_v),
    n AS (SELECT cmpgn_id, CAST(MAX(trans_needed_reward_pnt_qty) AS DOUBLE) / 100 AS t FROM campaign_versions GROUP BY 1),
    q AS (SELECT DISTINCT wallet_id, event_ts FROM scans)
    SELECT c.cmpgn_id, cmpgn_nm, CASE activity_type WHEN 'ACCA' THEN 'Accumulator' ELSE activity_type END AS activity_type,
      'Continuity' AS offr_type_desc, pound_value, t AS trans_needed_reward_pnt_qty, s AS cmpgn_start_dt, e AS cmpgn_end_dt,
      {day('m.event_ts')} AS event_ts, CASE WHEN e >= {A} THEN 'Active' ELSE 'Expired' END AS mission_status,
      COUNT(DISTINCT CASE WHEN cmpgn_seen_ts IS NOT NULL THEN m.wallet_id END) AS customers_seen,
      COUNT(DISTINCT CASE WHEN cmpgn_seen_ts IS NOT NULL AND q.wallet_id IS NOT NULL THEN m.wallet_id END) AS customers_progressed,
      0 AS customers_seen_not_cmplt,
      COUNT(DISTINCT CASE WHEN cmpgn_seen_ts IS NOT NULL AND cmpgn_cmplt_ts IS NOT NULL THEN m.wallet_id END) AS redeemers,
      COUNT(DISTINCT CASE WHEN cmpgn_seen_ts IS NOT NULL AND cmpgn_cmplt_ts IS NOT NULL THEN m.wallet_id END) * CAST(value_pence AS DOUBLE) / 100
        AS cashpot_earn
    FROM c JOIN n ON c.cmpgn_id = n.cmpgn_id JOIN missions m ON m.cmpgn_id = c.cmpgn_id
    LEFT JOIN q ON q.wallet_id = m.wallet_id AND q.event_ts = m.event_ts
    WHERE m.rec_status_ind = 'CURRENT' AND {day('m.event_ts')} >= {TRADING} AND {day('m.event_ts')} < {A}
    GROUP BY c.cmpgn_id, cmpgn_nm, activity_type, pound_value, value_pence, t, s, e, {day('m.event_ts')}""",
)
def mission_summary(r: Bound):
    return campaigns.mission_summary(r.setup, r.campaign_versions, r.missions, r.scans, AS_OF, SCHEME)


# --- coupons ---


@query("coupon_details", "SELECT * FROM coupon_v")
def coupon_details(r: Bound):
    return r.coupon_details


def _per_coupon(where: str, alias: str) -> str:
    return f"""{alias} AS (SELECT cmpgn_id, MAX(cmpgn_nm) AS cmpgn_nm, MIN(cmpgn_start_ts) AS cmpgn_start_ts, MAX(cmpgn_end_ts) AS cmpgn_end_ts,
      MAX(disc_amt) AS disc_amt, MAX(supplier) AS supplier, MAX(dept_desc) AS department, MAX(catg_desc) AS category,
      MAX(coupon_type) AS coupon_type FROM coupon_v WHERE {where} GROUP BY cmpgn_id)"""


@query(
    "coupon_daily_items",
    f""", {_per_coupon('win IS NOT NULL', 'd')},
    f AS (SELECT cmpgn_id, item_nbr, prod_disp_nm, {day('coupn_redm_ts')} AS redemption_date,
        CASE chnl_nm WHEN 'ecom' THEN 'Online' ELSE 'In-store' END AS chnl_nm, rdmpt_cnt, rdmpt_val, vat_sell_price_amt
      FROM coupon_adjustments WHERE visit_dt >= {COUPONS} AND supplier_bill_ind = 1 AND in_cmpgn_ind = 1
        AND cmpgn_id NOT IN ({', '.join(map(str, SCHEME.excluded_coupon_campaigns))})),
    u AS (SELECT * FROM f UNION ALL SELECT cmpgn_id, item_nbr, prod_disp_nm, redemption_date, 'All', rdmpt_cnt, rdmpt_val, vat_sell_price_amt FROM f)
    SELECT u.cmpgn_id, d.cmpgn_nm, cmpgn_start_ts, cmpgn_end_ts, disc_amt, supplier, department, category, item_nbr, prod_disp_nm,
      redemption_date, chnl_nm, {total('rdmpt_cnt')} AS redemption_vol, {total('rdmpt_val')} AS redemption_value,
      CAST(SUM(vat_sell_price_amt) AS DOUBLE) AS basket_spend
    FROM u JOIN d ON u.cmpgn_id = d.cmpgn_id GROUP BY ALL""",
)
def coupon_daily_items(r: Bound):
    return campaigns.coupon_daily_items(r.coupon_adjustments, r.coupon_sides, SCHEME)


_COUPON_MEASURES = f"""{total('rdmpt_cnt')} AS redemption_count, {pounds('rdmpt_val')} AS redemption_value,
    {total("CASE WHEN ch <> 'ECOM' THEN rdmpt_cnt END")} AS redemptions_store,
    {total("CASE WHEN ch = 'ECOM' THEN rdmpt_cnt END")} AS redemptions_online,
    {pounds("CASE WHEN ch <> 'ECOM' THEN rdmpt_val END")} AS cost_store, {pounds("CASE WHEN ch = 'ECOM' THEN rdmpt_val END")} AS cost_online"""
_COUPON_SCANS = f"s AS (SELECT DISTINCT wallet_id, event_ts, upper(chnl_nm) AS ch FROM scans WHERE visit_dt >= {COUPONS})"


@query(
    "coupon_daily_redemptions",
    f""", {_per_coupon('TRUE', 'd')}, {_COUPON_SCANS}
    SELECT d.*, {day('coupn_redm_ts')} AS coupn_redm_dt, COUNT(c.wallet_id) AS redeemers, {_COUPON_MEASURES}
    FROM coupons c JOIN d ON c.cmpgn_id = d.cmpgn_id LEFT JOIN s ON s.wallet_id = c.wallet_id AND s.event_ts = c.coupn_redm_ts
    WHERE rec_status_ind = 'CURRENT' AND {day('coupn_redm_ts')} < {A} GROUP BY ALL""",
)
def coupon_daily_redemptions(r: Bound):
    return campaigns.coupon_daily_redemptions(r.coupons, r.coupon_sides, r.scans, AS_OF, SCHEME)


@query(
    "coupon_summary",
    f""", {_per_coupon(f"(prime_win = win OR win IS NULL) AND {day('cmpgn_start_ts')} < {A}", 'd')}, {_COUPON_SCANS},
    k AS (SELECT DISTINCT x.cmpgn_id, p.wallet_id FROM (SELECT DISTINCT cmpgn_id, cmpgn_start_ts, cmpgn_end_ts FROM coupon_v) x
      JOIN (SELECT DISTINCT wallet_id, visit_dt FROM scans WHERE visit_dt >= {COUPONS}) p
      ON visit_dt BETWEEN {day('x.cmpgn_start_ts')} AND {day('x.cmpgn_end_ts')})
    SELECT d.*, COUNT(DISTINCT acct_id) AS allocated, COUNT(DISTINCT CASE WHEN k.wallet_id IS NOT NULL THEN acct_id END) AS allocated_scanned,
      0 AS wallets, COUNT(CASE WHEN coupn_redm_ts IS NOT NULL THEN acct_id END) AS redemptions,
      COUNT(DISTINCT CASE WHEN coupn_redm_ts IS NOT NULL THEN c.wallet_id END) AS redeemers, {_COUPON_MEASURES}
    FROM coupons c JOIN d ON c.cmpgn_id = d.cmpgn_id LEFT JOIN s ON s.wallet_id = c.wallet_id AND s.event_ts = c.coupn_redm_ts
    LEFT JOIN k ON k.wallet_id = c.wallet_id AND k.cmpgn_id = c.cmpgn_id
    WHERE rec_status_ind = 'CURRENT' AND {day('c.event_ts')} < {A} GROUP BY ALL""",
)
def coupon_summary(r: Bound):
    return campaigns.coupon_summary(r.coupons, r.coupon_sides, r.scans, AS_OF, SCHEME)


@query(
    "coupon_alloc",
    f"""SELECT cmpgn_id, {day('coupn_alloc_ts')} AS alloc_dt, COUNT(*) AS total_alloc,
    COUNT(*) FILTER (WHERE coupn_redm_ts IS NULL) AS alloc_not_redeemed
    FROM coupons WHERE rec_status_ind = 'CURRENT' AND {day('coupn_alloc_ts')} < {A} GROUP BY 1, 2""",
)
def coupon_alloc(r: Bound):
    return campaigns.coupon_alloc(r.coupons, AS_OF)


@query(
    "coupon_redm",
    f"""SELECT {day('coupn_redm_ts')} AS redm_dt, cmpgn_id, CASE WHEN s.store_nbr = '-1' THEN o.store_nbr ELSE s.store_nbr END AS store_nbr,
    chnl_nm, {total('rdmpt_cnt')} AS redm_cnt, {pounds('rdmpt_val')} AS redm_pounds,
    {total("CASE WHEN chnl_nm = 'ecom' THEN rdmpt_cnt ELSE 0 END")} AS online_redm,
    {total("CASE WHEN chnl_nm = 'store' THEN rdmpt_cnt ELSE 0 END")} AS store_redm,
    {pounds("CASE WHEN chnl_nm = 'ecom' THEN rdmpt_val ELSE 0 END")} AS online_pounds,
    {pounds("CASE WHEN chnl_nm = 'store' THEN rdmpt_val ELSE 0 END")} AS store_pounds
    FROM coupons c LEFT JOIN scans s ON s.wallet_id = c.wallet_id AND s.event_ts = c.coupn_redm_ts
    LEFT JOIN online_orders o ON o.web_order_id = s.trans_rcpt_nbr
    WHERE rec_status_ind = 'CURRENT' AND {day('coupn_redm_ts')} < {A} GROUP BY 1, 2, 3, 4""",
)
def coupon_redm(r: Bound):
    return campaigns.coupon_redm(r.coupons, r.scans, r.online_orders, AS_OF)


# --- trading ---


@query("star_product_list", "SELECT * FROM star_v")
def star_product_list(r: Bound):
    return r.star_products


@query(
    "epos_items_daily",
    f""", p AS (SELECT DISTINCT activity_type, cmpgn_nm, cmpgn_id, cons_item_nbr, {day('cmpgn_start_ts')} AS s, {day('cmpgn_end_ts')} + 30 AS e
      FROM star_v),
    f AS (SELECT p.activity_type, p.cmpgn_nm, p.cmpgn_id, visit_dt, basket_id, unmeasured_qty, sale_amt_inc_vat,
        CASE channel_src_id WHEN 2 THEN 'Online Only' ELSE 'In-store Only' END AS ch
      FROM p JOIN basket_items b ON b.cons_item_nbr = p.cons_item_nbr AND visit_dt BETWEEN s AND e
      WHERE visit_dt >= {TRADING} AND visit_dt < {A})
    SELECT 'All' AS chnl_nm, activity_type, cmpgn_nm, cmpgn_id, visit_dt, COUNT(DISTINCT basket_id) AS customers_proxy,
      {total('unmeasured_qty')} AS items, CAST(round(SUM(sale_amt_inc_vat), 2) AS DOUBLE) AS spend FROM f GROUP BY ALL
    UNION ALL SELECT ch, activity_type, cmpgn_nm, cmpgn_id, visit_dt, COUNT(DISTINCT basket_id),
      {total('unmeasured_qty')}, CAST(round(SUM(sale_amt_inc_vat), 2) AS DOUBLE) FROM f GROUP BY ALL""",
)
def epos_items_daily(r: Bound):
    return trading.epos_items_daily(r.star_products, r.basket_items, AS_OF, SCHEME)


_STAR_DAILY = f"""activity_type, cmpgn_nm, cmpgn_id, visit_dt, COUNT(DISTINCT wallet_id) AS customers,
      COUNT(DISTINCT CASE WHEN visit_dt = first_swipe THEN wallet_id END) AS first_swipe_customers, {total('rdmpt_cnt')} AS items,
      {pounds('pence')} AS cashpot FROM f GROUP BY ALL"""


@query(
    "star_products_daily",
    f""", f AS (SELECT p.activity_type, p.cmpgn_nm, p.cmpgn_id, {day('m.event_ts')} AS visit_dt, m.wallet_id, rdmpt_cnt, {MISSION_PENCE} AS pence,
        {channel('chnl_nm')} AS ch, first_swipe
      FROM (SELECT DISTINCT activity_type, cmpgn_nm, cmpgn_id, value_pence FROM star_v) p JOIN missions m ON m.cmpgn_id = p.cmpgn_id
      JOIN (SELECT DISTINCT wallet_id, event_ts, {channel('chnl_nm')} AS chnl_nm0, chnl_nm FROM scans) s
        ON s.wallet_id = m.wallet_id AND s.event_ts = m.event_ts
      JOIN (SELECT wallet_id, MIN(visit_dt) AS first_swipe FROM scans GROUP BY wallet_id) w ON w.wallet_id = m.wallet_id
      WHERE cmpgn_cmplt_ts IS NOT NULL AND rec_status_ind = 'CURRENT' AND {day('m.event_ts')} >= {TRADING} AND {day('m.event_ts')} < {A})
    SELECT 'All' AS chnl_nm, {_STAR_DAILY} UNION ALL SELECT ch, {_STAR_DAILY}""",
)
def star_products_daily(r: Bound):
    return trading.star_products_daily(r.star_products, r.missions, r.scans, AS_OF, SCHEME)


@query(
    "sp_details",
    f""", w AS (SELECT a.cmpgn_id, MIN(COALESCE(b.prime_win, c.prime_win)) AS prime_win, MIN(COALESCE(b.catg_desc, c.catg_desc)) AS catg_desc,
        MIN(COALESCE(b.dept_desc, c.dept_desc)) AS dept_desc, MIN(COALESCE(b.vendor_nm, c.vendor_nm)) AS vendor_nm,
        MIN(COALESCE(b.cmpgn_start_ts, c.cmpgn_start_ts)) AS s, MAX(COALESCE(b.cmpgn_end_ts, c.cmpgn_end_ts)) AS e,
        MAX(COALESCE(b.pound_value, c.pound_value)) AS pound_value
      FROM (SELECT DISTINCT cmpgn_id, prime_win, win FROM star_v) a
      LEFT JOIN star_v b ON a.cmpgn_id = b.cmpgn_id AND a.prime_win = b.win
      LEFT JOIN star_v c ON a.cmpgn_id = c.cmpgn_id AND a.win = c.win GROUP BY a.cmpgn_id)
    SELECT DISTINCT p.activity_type, {_initcap('p.cmpgn_nm')} AS cmpgn_nm, p.cmpgn_id, 0 AS upc_number, w.prime_win,
      {day('w.s')} AS cmpgn_start_ts, {day('w.e')} AS cmpgn_end_ts,
      CASE WHEN p.cmpgn_id = {SCHEME.food_to_go_campaign} THEN 'Food To Go' ELSE {_initcap('w.dept_desc')} END AS dept_desc,
      CASE WHEN p.cmpgn_id = {SCHEME.food_to_go_campaign} THEN 'Food for Later' ELSE {_initcap('w.catg_desc')} END AS catg_desc,
      CASE WHEN p.cmpgn_id = {SCHEME.food_to_go_campaign} THEN 'N/A' ELSE {_initcap('w.vendor_nm')} END AS vendor_nm, w.pound_value,
      CASE p.activity_type WHEN 'Star Product' THEN '10%' ELSE '£' || rpad(CAST(w.pound_value AS VARCHAR), 4, '0') END AS reward_value
    FROM star_v p JOIN w ON p.cmpgn_id = w.cmpgn_id""",
)
def sp_details(r: Bound):
    return trading.sp_details(r.star_products, SCHEME)


@query(
    "sp_redeemers",
    f""", f AS (SELECT p.cmpgn_id, m.wallet_id, m.event_ts FROM (SELECT DISTINCT cmpgn_id, {day('cmpgn_start_ts')} AS s, {day('cmpgn_end_ts')} AS e FROM star_v) p
      JOIN missions m ON m.cmpgn_id = p.cmpgn_id AND {day('m.event_ts')} BETWEEN s AND e
      WHERE cmpgn_cmplt_ts IS NOT NULL AND rec_status_ind = 'CURRENT' AND {day('m.event_ts')} >= {TRADING} AND {day('m.event_ts')} < {A})
    SELECT 'All' AS chnl_nm, cmpgn_id, COUNT(DISTINCT wallet_id) AS customers FROM f GROUP BY cmpgn_id
    UNION ALL SELECT {channel('chnl_nm')}, cmpgn_id, COUNT(DISTINCT f.wallet_id) FROM f JOIN scans s
      ON s.wallet_id = f.wallet_id AND s.event_ts = f.event_ts GROUP BY 1, 2""",
)
def sp_redeemers(r: Bound):
    return trading.sp_redeemers(r.star_products, r.missions, r.scans, AS_OF, SCHEME)


def _sp_scanners_sql(label: str) -> str:
    only = "TRUE" if label == "All" else f"{channel('chnl_nm')} = '{label}'"
    return f""", p AS (SELECT DISTINCT cmpgn_id, {_timed('cmpgn_start_ts')} AS s, {_timed('cmpgn_end_ts')} AS e FROM star_v)
    SELECT cmpgn_id, '{label}' AS chnl_nm, COUNT(DISTINCT wallet_id) AS rewards_swipers FROM p
    JOIN (SELECT DISTINCT wallet_id, event_ts FROM timed_scans WHERE {day('event_ts')} >= {SCANNERS} AND {day('event_ts')} < {A} AND {only}) x
      ON event_ts BETWEEN s AND e GROUP BY cmpgn_id"""


@query("sp_scanners", _sp_scanners_sql("All"))
def sp_scanners(r: Bound):
    return trading.sp_scanners(timed(r.star_products), r.timed_scans, AS_OF, SCHEME)


@query("sp_scanners_online", _sp_scanners_sql("Online Only"))
def sp_scanners_online(r: Bound):
    return trading.sp_scanners(timed(r.star_products), r.timed_scans, AS_OF, SCHEME, "Online Only")


@query("sp_scanners_store", _sp_scanners_sql("In-store Only"))
def sp_scanners_store(r: Bound):
    return trading.sp_scanners(timed(r.star_products), r.timed_scans, AS_OF, SCHEME, "In-store Only")


@query(
    "sp_lookup",
    f"""SELECT DISTINCT activity_type, cmpgn_id, {_initcap('cmpgn_nm')} AS cmpgn_nm, 0 AS dept_nbr, {_initcap('dept_desc')} AS dept_desc,
    0 AS catg_id, {_initcap('catg_desc')} AS catg_desc, {_initcap('vendor_nm')} AS vendor_nm, CAST(upc_nbr AS DECIMAL(10, 0)) AS upc,
    win, prime_win, pound_value FROM star_v WHERE upper(cmpgn_nm) NOT LIKE '%REMOVED%'""",
)
def sp_lookup(r: Bound):
    return trading.sp_lookup(r.star_products)
