"""Reference SQL for the correctness check: shared views and the text builder.

The views restate the conformed bases in plain SQL (range joins, EXISTS,
UNION), independently of the DataFrame operators.
"""

from __future__ import annotations

import re

from rolebook.roles import AS_OF, CALENDAR_SQL, EVENTS_AS_OF, ROLES, SCHEME

A = f"DATE '{AS_OF}'"
E = f"DATE '{EVENTS_AS_OF}'"
LAUNCH = f"DATE '{SCHEME.launch}'"
SERIES = f"DATE '{SCHEME.series_start}'"
TRADING = f"DATE '{SCHEME.trading_start}'"
SCANNERS = f"DATE '{SCHEME.scanners_start}'"
COUPONS = f"DATE '{SCHEME.coupon_start}'"
STATUS_LAUNCH = f"DATE '{SCHEME.status_launch}'"
ALWAYS_ON = ", ".join(str(c) for c in SCHEME.always_on_campaigns)


def total(x: str) -> str:
    return f"CAST(SUM({x}) AS BIGINT)"


def pounds(x: str) -> str:
    return f"CAST(SUM({x}) AS DOUBLE) / 100"


def day(ts: str) -> str:
    return f"CAST({ts} AS DATE)"


def channel(c: str) -> str:
    return f"CASE upper({c}) WHEN 'ECOM' THEN 'Online Only' WHEN 'STORE' THEN 'In-store Only' ELSE '???' END"


GUEST_EXPIRED = f"CASE WHEN regtn_ts < {A} - INTERVAL 37 DAY AND acct_status_id = 'TEMP' THEN 1 ELSE 0 END"
EVER_GUEST = "CASE WHEN dt_cnvrt_to_full_acct_ts IS NULL OR regtn_ts <> dt_cnvrt_to_full_acct_ts THEN 1 ELSE 0 END"
PROFILE = "COALESCE(singl_profl_id, 'no_assgnd_spid_' || CAST(wallet_id AS VARCHAR))"
NUMERIC = "regexp_matches(store_nbr, '^-?[0-9]+$')"
STAR = "(t LIKE '%STARPRODUCT%' OR t LIKE '%OPENSP%' OR (offr_type_desc = 'FIXED_POINTS_PRODUCTS' AND cmpgn_type_nm = 'POINTS_FIXED'))"
MISSION_PENCE = f"""CASE WHEN activity_type = 'Star Product' AND cmpgn_cmplt_ts <= TIMESTAMP '{SCHEME.star_value_change}' THEN value_pence * rdmpt_cnt
      WHEN activity_type = 'Star Product' THEN rdmpt_val
      WHEN activity_type = 'Super Star Product' THEN rdmpt_val * rdmpt_cnt
      WHEN activity_type IN ('Status Group', 'Clubs') THEN rdmpt_val
      WHEN activity_type IN ('ACCA', 'Mission') THEN value_pence END"""

VIEWS: dict[str, str] = {
    "calendar": CALENDAR_SQL,
    "last_week_v": f"""SELECT MIN(day_date) AS start_date, MAX(day_date) AS end_date FROM calendar
    WHERE day_date >= {LAUNCH} AND day_date < {A} AND retail_week = (SELECT MAX(retail_week) FROM calendar
      WHERE day_date < {A} AND retail_week < (SELECT MAX(retail_week) FROM calendar WHERE day_date < {A}))""",
    "year_v": f"""SELECT MIN(day_date) AS start_dt, MAX(day_date) AS end_dt FROM calendar
    WHERE retail_year = (SELECT retail_year FROM calendar WHERE day_date = {A})""",
    "account_v": f"""SELECT a.wallet_id, COALESCE(singl_profl_id, 'no_assgnd_spid_' || CAST(a.wallet_id AS VARCHAR)) AS singl_profl_id,
    {day('regtn_ts')} AS reg_dt, curr_cash_bnk_pnts_qty, lifetime_pnts_qty, last_shopped_store_id, acct_status_id,
    dt_cnvrt_to_full_acct_ts, regtn_ts, {EVER_GUEST} AS guest_ind, {GUEST_EXPIRED} AS acct_del_ind_1, src_modfd_ts
    FROM accounts a WHERE {day('regtn_ts')} >= {LAUNCH} AND {day('regtn_ts')} < {A}""",
    "sign_up_v": f"""SELECT b.singl_profl_id, {day('regtn_ts')} AS signup_dt,
    CASE WHEN registration_channel = 'LOYALTY' OR {day('registration_date')} = {day('tnc_accepted_at_loyalty')} THEN 1 ELSE 0 END AS new_ind,
    CASE WHEN mktg_consent_email = 'Y' OR push_notif_consent = 'Y' THEN 1 ELSE 0 END AS opt_in_flag,
    {GUEST_EXPIRED} AS acct_del_ind_1, acct_status_id
    FROM (SELECT DISTINCT {PROFILE} AS singl_profl_id, regtn_ts, acct_status_id, {EVER_GUEST} AS g FROM accounts
          WHERE {day('regtn_ts')} < {A}) b
    LEFT JOIN consents c ON b.singl_profl_id = c.singl_profl_id LEFT JOIN profiles p ON b.singl_profl_id = p.singl_profl_id""",
    "sign_up_day_v": """SELECT signup_dt, acct_status_id, COUNT(singl_profl_id) AS num_sign_ups,
    CAST(SUM(new_ind) AS BIGINT) AS num_new_ind, CAST(SUM(opt_in_flag) AS BIGINT) AS num_opt_in_flag,
    CAST(SUM(acct_del_ind_1) AS BIGINT) AS num_acct_del,
    COUNT(*) FILTER (WHERE acct_status_id = 'DEFAULT' AND opt_in_flag = 1) AS opt_in_perm_only,
    COUNT(*) FILTER (WHERE acct_status_id = 'DEFAULT' AND new_ind = 1) AS new_ind_perm_only
    FROM sign_up_v GROUP BY signup_dt, acct_status_id""",
    "scan_v": f"""SELECT wallet_id, store_nbr, event_ts,
    CASE WHEN {day('event_ts')} BETWEEN {A} - 7 AND {A} THEN wallet_id ELSE 0 END AS current_7_day_active_flag,
    CASE WHEN {day('event_ts')} BETWEEN {A} - 8 AND {A} - 2 THEN wallet_id ELSE 0 END AS yesterday_7_day_active_flag,
    CASE WHEN {day('event_ts')} BETWEEN {A} - 14 AND {A} - 8 THEN wallet_id ELSE 0 END AS rolling_7_day_active_flag
    FROM scans WHERE {day('event_ts')} >= {LAUNCH} AND {day('event_ts')} < {A} AND TRY_CAST(store_nbr AS INT) IS NOT NULL""",
    "scan_point_v": "SELECT DISTINCT wallet_id, event_ts, store_nbr, chnl_nm FROM scans",
    "setup_v": f"""SELECT *, CAST(value_pence AS DOUBLE) / 100 AS pound_value FROM (
      SELECT v.*, CASE WHEN reward_pnt_qty IS NULL THEN disc_amt WHEN disc_amt IS NULL THEN reward_pnt_qty END AS value_pence,
      CASE WHEN cmpgn_id = {SCHEME.status_campaign} THEN 'Status Group' WHEN cmpgn_id = {SCHEME.club_campaign} THEN 'Baby Club'
        WHEN cmpgn_type_nm = 'DISCOUNT_BASKET' THEN 'Voucher' WHEN t LIKE '%MISSION%' OR t LIKE '%ACCA%' THEN 'Mission'
        WHEN {STAR} THEN 'Star Product' END AS category,
      CASE WHEN cmpgn_type_nm = 'DISCOUNT_BASKET' THEN 'Burn' ELSE 'Earn' END AS burn_earn,
      CASE WHEN t LIKE '%FREQ%' OR t LIKE '%ACCA%' THEN 'ACCA' WHEN t LIKE '%MISSION%' THEN 'Mission'
        WHEN t LIKE '%SUPERSTAR%' THEN 'Super Star Product' WHEN t LIKE '%ESSENTIAL_WORKER' THEN 'Status Group'
        WHEN t LIKE '%CLUB_%' THEN 'Clubs' WHEN {STAR} THEN 'Star Product' END AS activity_type
      FROM (SELECT c.*, upper(cmpgn_tag_array) AS t FROM campaign_versions c) v
      WHERE upd_ts = (SELECT MAX(upd_ts) FROM campaign_versions m WHERE m.cmpgn_id = v.cmpgn_id)
        AND rec_status_ind = 'CURRENT'
        AND ((cmpgn_status_desc <> 'DRAFT' AND cmpgn_nm NOT LIKE '%TEST%' AND {day('cmpgn_start_ts')} <= {A}
              AND {day('cmpgn_end_ts')} >= DATE '{SCHEME.campaign_end_floor}' AND cmpgn_type_nm <> 'MANUAL')
          OR (cmpgn_type_nm = 'DISCOUNT_BASKET' AND cmpgn_nm = 'Rewards Voucher'
              AND {day('cmpgn_end_ts')} >= DATE '{SCHEME.evergreen_end_floor}')))""",
    "voucher_v": f"""SELECT r.wallet_id, r.cmpgn_id, reward_gained_ts, reward_end_ts, reward_redm_ts,
    pound_value AS voucher_value_pounds, value_pence, store_nbr, cmpgn_type_desc, s.chnl_nm, a.acct_status_id
    FROM reward_wallets r
    LEFT JOIN scan_point_v s ON r.wallet_id = s.wallet_id AND r.reward_redm_ts = s.event_ts
    LEFT JOIN setup_v c ON r.cmpgn_id = c.cmpgn_id LEFT JOIN account_v a ON r.wallet_id = a.wallet_id
    WHERE r.rec_status_ind = 'CURRENT' AND {day('reward_gained_ts')} >= {LAUNCH} AND {day('reward_gained_ts')} < {A}
      AND (reward_redm_ts IS NULL OR ({day('reward_redm_ts')} >= {LAUNCH} AND {day('reward_redm_ts')} < {A}))
      AND r.wallet_id <> {SCHEME.excluded_voucher_wallets[0]}""",
    "completion_v": f"""SELECT m.*, CAST(mission_value_pence AS DOUBLE) / 100 AS mission_value_pounds_new,
    CAST(value_pence AS DOUBLE) / 100 AS mission_value_pounds,
    CASE WHEN {day('cmpgn_cmplt_ts')} BETWEEN {A} - 7 AND {A} THEN m.wallet_id END AS cmplt_lst_wk,
    CASE WHEN {day('cmpgn_cmplt_ts')} BETWEEN {A} - 14 AND {A} - 8 THEN m.wallet_id END AS cmplt_prior_wk,
    CASE WHEN {day('cmpgn_cmplt_ts')} BETWEEN (SELECT start_dt FROM year_v) AND (SELECT end_dt FROM year_v) THEN 1 ELSE 0 END AS cmplt_ytd,
    CASE WHEN {day('cmpgn_cmplt_ts')} <= (SELECT end_date FROM last_week_v) THEN 1 ELSE 0 END AS last_week_flag,
    a.acct_status_id
    FROM (SELECT DISTINCT x.wallet_id, x.cmpgn_id, cmpgn_seen_ts, cmpgn_cmplt_ts,
            CASE WHEN activity_type IN ('ACCA', 'Mission') THEN 1 ELSE rdmpt_cnt END AS rdmpt_cnt,
            {MISSION_PENCE} AS mission_value_pence, value_pence, store_nbr, x.rec_status_ind, s.chnl_nm, activity_type
          FROM missions x JOIN scan_point_v s ON x.wallet_id = s.wallet_id AND x.cmpgn_cmplt_ts = s.event_ts
          LEFT JOIN setup_v c ON x.cmpgn_id = c.cmpgn_id
          WHERE TRY_CAST(store_nbr AS INT) IS NOT NULL AND {day('cmpgn_cmplt_ts')} >= {LAUNCH} AND {day('cmpgn_cmplt_ts')} < {A}
            AND (x.cmpgn_id IN ({ALWAYS_ON}) OR x.rec_status_ind = 'CURRENT')) m
    LEFT JOIN account_v a ON m.wallet_id = a.wallet_id""",
    "item_v": """SELECT DISTINCT all_links_item_nbr AS prime_win, item_nbr AS win, upc_nbr, cons_item_nbr, original_cin, dept_desc,
    catg_desc, vendor_nm FROM items WHERE obsolete_dt >= DATE '1996-01-01'""",
    "star_v": f"""SELECT DISTINCT win, prime_win, CASE WHEN cons_item_nbr = -1 THEN original_cin ELSE cons_item_nbr END AS cons_item_nbr,
    upc_nbr, dept_desc, catg_desc, upper(substr(vendor_nm, 1, 1)) || lower(substr(vendor_nm, 2)) AS vendor_nm, p.upc, p.cmpgn_id, cmpgn_nm,
    cmpgn_start_ts, cmpgn_end_ts, pound_value, value_pence, activity_type
    FROM (SELECT cmpgn_id, CASE WHEN length(cmpgn_prod_id) IN (8, 13) THEN left(cmpgn_prod_id, length(cmpgn_prod_id) - 1)
            ELSE cmpgn_prod_id END AS upc FROM campaign_products
          WHERE cmpgn_status_desc IN ('ACTIVE', 'EXPIRED') AND cmpgn_prod_level_nm = 'upc_nbr') p
    LEFT JOIN item_v i ON p.upc = i.upc_nbr JOIN setup_v c ON p.cmpgn_id = c.cmpgn_id
    WHERE activity_type IN ('Star Product', 'Super Star Product') AND {day('cmpgn_start_ts')} >= {TRADING}
      AND NOT (original_cin = -1 AND cons_item_nbr = -1)
      AND p.cmpgn_id NOT IN ({', '.join(map(str, SCHEME.excluded_star_campaigns))})""",
    "coupon_v": f"""SELECT DISTINCT c.cmpgn_tag_array, p.cmpgn_id, c.cmpgn_nm,
    CASE WHEN hour(c.cmpgn_start_ts) = 23 THEN c.cmpgn_start_ts + INTERVAL 1 HOUR ELSE c.cmpgn_start_ts END AS cmpgn_start_ts,
    c.cmpgn_end_ts, CAST(c.disc_amt AS DOUBLE) / 100 AS disc_amt, p.upc, i.upc_nbr, i.win,
    CASE WHEN cons_item_nbr = -1 THEN original_cin ELSE cons_item_nbr END AS cons_item_nbr, i.prime_win,
    upper(substr(dept_desc, 1, 1)) || lower(substr(dept_desc, 2)) AS dept_desc, catg_desc,
    upper(substr(vendor_nm, 1, 1)) || lower(substr(vendor_nm, 2)) AS supplier, COALESCE(t.coupon_type, 'Product Coupon') AS coupon_type
    FROM (SELECT cmpgn_id, CASE WHEN cmpgn_prod_level_nm = 'upc_nbr' THEN CASE WHEN length(cmpgn_prod_id) IN (8, 13)
            THEN left(cmpgn_prod_id, length(cmpgn_prod_id) - 1) ELSE cmpgn_prod_id END END AS upc FROM campaign_products
          WHERE cmpgn_status_desc IN ('ACTIVE', 'EXPIRED')) p
    JOIN (SELECT DISTINCT cmpgn_tag_array, cmpgn_id, cmpgn_nm, cmpgn_start_ts, cmpgn_end_ts, cmpgn_status_desc, disc_amt
          FROM campaign_versions WHERE upper(cmpgn_tag_array) LIKE '%COUPON%' AND cmpgn_start_ts >= {COUPONS}) c
      ON p.cmpgn_id = c.cmpgn_id
    LEFT JOIN item_v i ON p.upc = i.upc_nbr LEFT JOIN coupon_types t ON p.cmpgn_id = t.cmpgn_id""",
    "mission_campaign_v": f"""SELECT * FROM setup_v WHERE upper(activity_type) IN ('ACCA', 'MISSION')
    AND upper(cmpgn_status_desc) IN ('ACTIVE', 'EXPIRED') AND {day('cmpgn_start_ts')} >= {TRADING}""",
    "holder_v": f"""SELECT a.wallet_id, a.regtn_ts, {day('COALESCE(z.ts, a.status_id_last_upd_ts)')} AS status_upd_dt
    FROM accounts a LEFT JOIN (SELECT wallet_id, MIN(status_id_last_upd_ts) AS ts FROM archive
      WHERE status_id_last_upd_ts IS NOT NULL GROUP BY wallet_id) z ON a.wallet_id = z.wallet_id
    WHERE a.status_id_last_upd_ts IS NOT NULL""",
}


def _sources() -> dict[str, str]:
    return {**ROLES, **VIEWS}


def oracle(body: str) -> str:
    """``body`` (a SELECT, or ", cte AS (...) SELECT") preceded by the views it needs."""
    sources = _sources()
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in sources:
            if name not in needed and re.search(rf"\b(FROM|JOIN|,)\s*{name}\b", text):
                visit(sources[name])
                if name not in needed:
                    needed.append(name)

    visit(body)
    views = ",\n".join(f"{name} AS ({sources[name]})" for name in needed)
    if body.lstrip().startswith(","):
        return f"WITH {views}\n{body}" if views else f"WITH {body.lstrip()[1:]}"
    return f"WITH {views}\n{body}" if views else body
