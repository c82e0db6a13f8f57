"""Roles (scans, accounts, missions, ...) expressed over the TPC-H-like test tables.

Each role is one SELECT in the SQL that Spark and DuckDB share, so both sides
of the correctness check read the same rows; the reports themselves are
written twice, as DataFrame operators and as independent SQL. Roles of a kind of
row (orders that went through, app views, device files) hold the rows of that kind; all
others cover their source tables whole. Money is in pence unless a role says otherwise.
"""

from __future__ import annotations

import re
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stampbook.functions import retail_calendar
from stampbook.scheme import Scheme
from stampbook.sources import read_table

AS_OF = date(2001, 8, 2)
EVENTS_AS_OF = date(2024, 1, 31)
CALENDAR_START, CALENDAR_END = date(1994, 12, 31), date(2002, 1, 31)

SCHEME = Scheme(
    launch=date(1995, 2, 1),
    star_value_change=date(1998, 1, 1),
    series_start=date(1995, 3, 1),
    trading_start=date(1995, 6, 1),
    scanners_start=date(1995, 6, 1),
    campaign_end_floor=date(1995, 3, 1),
    coupon_start=date(1995, 4, 1),
    item_obsolete_floor=date(1996, 1, 1),
    coupon_item_obsolete_floor=date(1996, 1, 1),
    status_launch=date(1998, 6, 1),
    reference_prefix_change=date(1999, 1, 1),
    status_campaign=1833,
    club_campaign=635,
    earners_excluded_campaign=708,
    saver_scheme=7,
    deleted_item=-1,
    excluded_star_campaigns=(216, 1225),
    excluded_coupon_campaigns=(442, 1340),
    excluded_voucher_wallets=(66,),
    food_to_go_campaign=420,
)

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
)

_CMPGN = "(CAST(substr(p_brand, 7) AS INT) * 100 + p_size)"
_GUEST = "c_mktsegment IN ('HOUSEHOLD', 'MACHINERY')"
_REG = "(DATE '1995-01-01' + CAST(c_custkey * 7919 % 2410 AS INT))"
_CHANNEL = """CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'store'
    WHEN o_orderpriority = '3-MEDIUM' THEN 'ecom' ELSE 'pfs' END"""
_PENCE = "CAST(FLOOR({} * 100 + 0.5) AS BIGINT)"

ROLES: dict[str, str] = {
    "scans": f"""SELECT o_custkey AS wallet_id,
    CASE WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'P' THEN 'TST1'
         WHEN o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'O' THEN '-1'
         ELSE CAST(1 + o_orderkey % 40 AS STRING) END AS store_nbr,
    o_orderdate AS event_ts, CAST(o_orderdate AS DATE) AS visit_dt, {_CHANNEL} AS chnl_nm,
    CAST(o_orderkey AS STRING) AS trans_rcpt_nbr, CAST(o_orderkey % 9 AS INT) AS reg_nbr,
    CAST(o_orderkey % 1000 AS INT) AS trans_nbr, o_orderkey AS basket_id,
    CAST(FLOOR(o_totalprice * 100 + 0.5) AS BIGINT) AS sale_amt_inc_vat
    FROM orders""",
    "timed_scans": f"""SELECT o_custkey AS wallet_id, {_CHANNEL} AS chnl_nm,
    o_orderdate + INTERVAL '1' MINUTE * CAST(o_orderkey * 37 % 1440 AS INT) AS event_ts FROM orders""",
    "event_scans": """SELECT user_id AS wallet_id, ts AS event_ts, event_id AS basket_id,
    CASE event_type WHEN 'purchase' THEN 'store' WHEN 'view' THEN 'ecom' ELSE event_type END AS chnl_nm,
    CAST(FLOOR(value * 100 + 0.5) AS BIGINT) AS sale_amt_inc_vat
    FROM events""",
    "accounts": f"""SELECT c_custkey AS wallet_id,
    CASE WHEN {_GUEST} THEN NULL ELSE 'P' || CAST(c_custkey AS STRING) END AS singl_profl_id,
    CAST({_REG} AS TIMESTAMP) AS regtn_ts,
    CASE WHEN {_GUEST} THEN 'TEMP' ELSE 'DEFAULT' END AS acct_status_id,
    CASE WHEN {_GUEST} THEN NULL WHEN c_mktsegment = 'BUILDING' THEN CAST({_REG} AS TIMESTAMP)
         ELSE CAST({_REG} + 20 AS TIMESTAMP) END AS dt_cnvrt_to_full_acct_ts,
    CAST(FLOOR(ABS(c_acctbal) / 4) AS BIGINT) AS curr_cash_bnk_pnts_qty,
    CAST(FLOOR(ABS(c_acctbal)) AS BIGINT) AS lifetime_pnts_qty,
    CAST(1 + c_custkey % 40 AS STRING) AS last_shopped_store_id,
    CASE WHEN c_nationkey < 9 THEN 'S' || CAST(c_custkey AS STRING) END AS status_id,
    CASE WHEN c_nationkey < 9 THEN CAST(DATE '1998-03-01' + CAST(c_custkey % 500 AS INT) AS TIMESTAMP) END
        AS status_id_last_upd_ts,
    'L' || CAST(c_custkey AS STRING) AS loyalty_id,
    CAST({_REG} + 1 AS TIMESTAMP) AS src_modfd_ts
    FROM customer""",
    "archive": """SELECT c_custkey AS wallet_id,
    CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN CAST(DATE '1998-01-15' + CAST(c_custkey % 300 AS INT) AS TIMESTAMP) END
        AS status_id_last_upd_ts
    FROM customer""",
    "consents": """SELECT 'P' || CAST(c_custkey AS STRING) AS singl_profl_id,
    CASE WHEN c_nationkey < 12 THEN 'Y' ELSE 'N' END AS mktg_consent_email,
    CASE WHEN c_acctbal > 5000 THEN 'Y' WHEN c_acctbal > 0 THEN 'N' END AS push_notif_consent
    FROM customer""",
    "profiles": f"""SELECT 'P' || CAST(c_custkey AS STRING) AS singl_profl_id,
    CASE WHEN c_nationkey IN (1, 5, 9) THEN 'LOYALTY' ELSE 'WEB' END AS registration_channel,
    CAST({_REG} AS TIMESTAMP) AS registration_date,
    CAST({_REG} + CASE WHEN c_acctbal < 2500 THEN 0 ELSE 3 END AS TIMESTAMP) AS tnc_accepted_at_loyalty
    FROM customer""",
    "contactable": """SELECT 'P' || CAST(c_custkey AS STRING) AS single_profile_id,
    CASE WHEN c_acctbal < 4000 THEN 'Y' ELSE 'N' END AS is_email_contactable FROM customer""",
    "device_file": """SELECT 'P' || CAST(o_custkey AS STRING) AS named_user,
    CASE o_orderstatus WHEN 'F' THEN 'true' WHEN 'O' THEN 'false' END AS notification_opt_in
    FROM orders WHERE o_orderpriority = '1-URGENT'""",
    "campaign_versions": f"""SELECT {_CMPGN} AS cmpgn_id, p_name || ' ' || p_type AS cmpgn_nm,
    CAST(DATE '1995-02-01' + {_CMPGN} * 37 % 2300 AS TIMESTAMP) AS cmpgn_start_ts,
    CAST(DATE '1995-02-14' + ({_CMPGN} * 37 % 2300 + {_CMPGN} % 45) AS TIMESTAMP) AS cmpgn_end_ts,
    CAST(DATE '1995-01-01' + CAST(p_partkey % 25 AS INT) AS TIMESTAMP) AS upd_ts,
    CAST(DATE '1995-01-01' + CAST(p_partkey % 60 AS INT) AS TIMESTAMP) AS load_ts,
    CASE p_type WHEN 'PROMO' THEN 'FIXED_POINTS_PRODUCTS' WHEN 'SMALL' THEN 'FIXED_POINTS_BASKET'
         ELSE 'PERCENT_OFF' END AS offr_type_desc,
    CASE p_type WHEN 'PROMO' THEN 'POINTS_FIXED' WHEN 'ECONOMY' THEN 'DISCOUNT_BASKET' ELSE 'POINTS' END
        AS cmpgn_type_nm,
    CASE WHEN p_size <= 8 THEN '[MISSION]' WHEN p_size <= 13 THEN '[ACCA]' WHEN p_size <= 15 THEN 'freq_MISSION'
         WHEN p_size <= 23 THEN 'STARPRODUCT' WHEN p_size <= 29 THEN 'SuperStar'
         WHEN p_size <= 33 THEN 'X_ESSENTIAL_WORKER' WHEN p_size <= 36 THEN 'CLUB_BABY'
         WHEN p_size <= 44 THEN 'Coupon' WHEN p_size <= 46 THEN 'OPENSP' ELSE 'NONE' END AS cmpgn_tag_array,
    CASE p_type WHEN 'MEDIUM' THEN 'DRAFT' WHEN 'SMALL' THEN 'EXPIRED' ELSE 'ACTIVE' END AS cmpgn_status_desc,
    CASE WHEN p_name LIKE 'hot%' THEN 'HISTORIC' ELSE 'CURRENT' END AS rec_status_ind,
    CASE WHEN p_size % 2 = 0 THEN CAST(FLOOR(p_retailprice / 10) AS BIGINT) END AS reward_pnt_qty,
    CASE WHEN p_size % 2 = 1 THEN CAST(FLOOR(p_retailprice / 8) AS BIGINT) END AS disc_amt,
    CAST(FLOOR(p_retailprice) AS BIGINT) AS trans_needed_reward_pnt_qty,
    'PUSH' AS cmpgn_mode_nm, CASE WHEN p_size % 2 = 1 THEN 'COUPON' ELSE 'POINTS' END AS cmpgn_clsfctn_nm,
    'FIXED' AS coupn_exp_type_desc
    FROM part""",
    "campaign_products": f"""SELECT {_CMPGN} AS cmpgn_id,
    CAST(1000000 + p_partkey AS STRING) || CAST(p_partkey % 10 AS STRING) AS cmpgn_prod_id,
    CASE WHEN p_retailprice < 905 THEN 'dept' ELSE 'upc_nbr' END AS cmpgn_prod_level_nm,
    CASE p_type WHEN 'MEDIUM' THEN 'DRAFT' WHEN 'SMALL' THEN 'EXPIRED' ELSE 'ACTIVE' END AS cmpgn_status_desc
    FROM part""",
    "items": """SELECT p_partkey AS item_nbr, p_partkey - p_partkey % 2 AS all_links_item_nbr,
    CAST(1000000 + p_partkey AS STRING) AS upc_nbr,
    CASE WHEN p_type = 'SMALL' THEN CAST(-1 AS BIGINT) ELSE p_partkey END AS cons_item_nbr,
    CASE WHEN p_name LIKE 'red%' THEN CAST(-1 AS BIGINT) ELSE p_partkey END AS original_cin,
    upper(p_type) AS dept_desc, p_name AS catg_desc, upper(p_brand) AS vendor_nm,
    CASE WHEN p_type = 'LARGE' THEN DATE '1995-01-01' ELSE DATE '2099-01-01' END AS obsolete_dt
    FROM part""",
    "coupon_types": f"""SELECT DISTINCT {_CMPGN} AS cmpgn_id,
    CASE WHEN p_size = 37 THEN 'Game' ELSE 'Seasonal Coupon' END AS coupon_type
    FROM part WHERE p_size IN (37, 39)""",
    "missions": f"""SELECT o_custkey AS wallet_id, {_CMPGN} AS cmpgn_id,
    CASE WHEN l_linenumber <= 5 THEN CAST(CAST(o_orderdate AS DATE) - l_linenumber AS TIMESTAMP) END AS cmpgn_seen_ts,
    CASE WHEN l_returnflag <> 'N' THEN o_orderdate END AS cmpgn_cmplt_ts,
    l_linenumber AS rdmpt_cnt, CAST(FLOOR(l_extendedprice / 100) AS BIGINT) AS rdmpt_val,
    CASE l_linestatus WHEN 'F' THEN 'CURRENT' ELSE 'HISTORIC' END AS rec_status_ind,
    CASE WHEN l_discount >= 0.09 THEN 'CANCELLED' ELSE 'DONE' END AS mssn_status_desc,
    CASE WHEN l_tax > 0.02 THEN l_quantity END AS progress_qty,
    o_orderdate AS event_ts, l_shipdate AS upd_ts
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey""",
    "reward_wallets": """SELECT o_custkey AS wallet_id,
    CAST((1 + o_custkey % 25) * 100 + 1 + o_orderkey % 50 AS INT) AS cmpgn_id,
    o_orderdate - INTERVAL '37' MINUTE * CAST(o_orderkey % 300 AS INT) AS reward_gained_ts,
    CAST(CAST(o_orderdate AS DATE) + 60 AS TIMESTAMP) AS reward_end_ts,
    CASE WHEN o_orderstatus = 'F' THEN o_orderdate END AS reward_redm_ts,
    'V_' || o_orderpriority AS cmpgn_type_desc,
    CASE WHEN o_orderstatus = 'F' THEN 'USED' ELSE 'OPEN' END AS reward_status_desc,
    CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'P' THEN 'HISTORIC' ELSE 'CURRENT' END AS rec_status_ind
    FROM orders""",
    "coupons": f"""SELECT o_custkey AS wallet_id, o_custkey AS acct_id, {_CMPGN} AS cmpgn_id,
    CAST(CAST(o_orderdate AS DATE) - 10 AS TIMESTAMP) AS coupn_alloc_ts,
    CASE WHEN l_returnflag = 'A' THEN o_orderdate END AS coupn_redm_ts,
    CASE WHEN l_returnflag = 'A' THEN l_linenumber END AS rdmpt_cnt,
    CASE WHEN l_returnflag = 'A' THEN CAST(FLOOR(l_extendedprice / 50) AS BIGINT) END AS rdmpt_val,
    CASE l_linestatus WHEN 'F' THEN 'CURRENT' ELSE 'HISTORIC' END AS rec_status_ind, o_orderdate AS event_ts
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey""",
    "coupon_adjustments": f"""SELECT {_CMPGN} AS cmpgn_id, l_partkey AS item_nbr, p_name AS prod_disp_nm,
    l_shipdate AS coupn_redm_ts, CASE WHEN l_linenumber > 4 THEN 'ecom' ELSE 'store' END AS chnl_nm,
    l_linenumber AS rdmpt_cnt, CAST(FLOOR(l_extendedprice / 50) AS BIGINT) AS rdmpt_val,
    CAST(FLOOR(l_extendedprice * 100 + 0.5) AS BIGINT) AS vat_sell_price_amt, CAST(l_shipdate AS DATE) AS visit_dt,
    CASE l_linestatus WHEN 'F' THEN 1 ELSE 0 END AS supplier_bill_ind,
    CASE l_returnflag WHEN 'N' THEN 0 ELSE 1 END AS in_cmpgn_ind
    FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "basket_items": """SELECT l_partkey AS cons_item_nbr, CAST(l_shipdate AS DATE) AS visit_dt,
    l_orderkey AS basket_id, CAST(l_quantity AS INT) AS unmeasured_qty,
    CAST(FLOOR(l_extendedprice * 100 + 0.5) AS BIGINT) AS sale_amt_inc_vat,
    CASE l_returnflag WHEN 'A' THEN 2 ELSE 1 END AS channel_src_id FROM lineitem""",
    "stores": """SELECT CAST(s_suppkey AS INT) AS store_nbr,
    s_name || CASE WHEN s_acctbal < 0 THEN ' (north), x' WHEN s_acctbal < 5000 THEN ' (north)' ELSE '' END AS store_nm,
    s_acctbal / 100 AS latitude, CASE WHEN s_acctbal < 9000 THEN s_acctbal / 200 END AS longitude FROM supplier""",
    "store_regions": """SELECT CAST(s_suppkey AS INT) AS store_nbr, r_name AS region
    FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    WHERE r_name <> 'ASIA'""",
    "forced_stores": """SELECT CAST(s_suppkey AS INT) AS store_nbr, 'CENTRAL' AS region
    FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE n_name = 'NATION_2'""",
    "pot_balances_role": """SELECT c_custkey AS cashpot_id, c_custkey AS wallet_id, c_nationkey AS scheme_id,
    CAST(FLOOR(ABS(c_acctbal)) AS BIGINT) AS curr_cash_bnk_pnts_qty FROM customer""",
    "pot_setup": """SELECT n_nationkey AS scheme_id, n_name AS cashpot_nm,
    CASE WHEN n_regionkey = 4 THEN 'HISTORIC' ELSE 'CURRENT' END AS rec_status_ind FROM nation""",
    "pot_moves": f"""SELECT o_custkey AS cashpot_id_src, o_custkey % 17 AS cashpot_id_dest, o_custkey % 17 AS wallet_id_dest,
    o_orderdate AS trans_ts, {_PENCE.format('o_totalprice')} AS cashpot_val_dest,
    CASE WHEN o_orderpriority = '1-URGENT' THEN 'CLOSE' ELSE 'TRANSFER' END AS rsn_cd FROM orders""",
    "pot_expiries": f"""SELECT o_custkey + CASE WHEN o_orderstatus = 'P' THEN 1000000000 ELSE 0 END AS wallet_id,
    o_orderdate AS event_ts,
    CASE WHEN o_orderpriority <> '5-LOW' THEN {_PENCE.format('o_totalprice')} END AS cashpot_val_exp FROM orders""",
    "games": """SELECT user_id AS wallet_id, ts AS game_start_ts,
    CASE WHEN event_type IN ('purchase', 'signup') THEN ts END AS game_redm_ts,
    CAST(FLOOR(value) AS BIGINT) AS game_win_val,
    CASE event_type WHEN 'error' THEN 'HISTORIC' ELSE 'CURRENT' END AS rec_status_ind FROM events""",
    "order_games": """SELECT o_custkey AS wallet_id, o_orderdate AS game_start_ts,
    CASE WHEN o_orderstatus = 'O' THEN o_orderdate END AS game_redm_ts,
    CASE o_orderpriority WHEN '5-LOW' THEN 'HISTORIC' ELSE 'CURRENT' END AS rec_status_ind FROM orders""",
    "credits": f"""SELECT o_custkey AS wallet_id, o_orderdate AS event_ts, {_PENCE.format('o_totalprice')} AS cr_pnts_qty,
    CASE o_orderstatus WHEN 'F' THEN 'GOODWILL' ELSE 'OTHER' END AS event_nm FROM orders""",
    "external_credits": f"""SELECT o_custkey AS wallet_id, o_orderdate AS event_ts, o_orderdate AS trans_ts,
    {_PENCE.format('o_totalprice')} AS trans_amt,
    CASE o_orderstatus WHEN 'F' THEN 'Card' WHEN 'O' THEN 'Colleague' ELSE 'Partner' END AS chnl_nm,
    'REF-' || o_orderpriority || '-' || CAST(o_custkey % 7 AS STRING) AS ref_id FROM orders""",
    "online_orders": f"""SELECT CAST(o_orderkey AS STRING) AS web_order_id,
    'P' || CAST(o_custkey AS STRING) AS singl_profl_id, CAST(o_orderdate AS DATE) + CAST(o_orderkey % 5 AS INT) AS dlvr_dt,
    o_orderdate AS order_sbmtd_ts,
    CASE o_orderstatus WHEN 'P' THEN 'CANCELLED' ELSE 'NO_PENDING_ACTION' END AS order_status_nm,
    CAST(o_totalprice AS DECIMAL(12, 2)) AS pos_tot_amt, CAST(o_totalprice AS DECIMAL(12, 2)) AS web_order_tot_amt,
    CAST(1 + o_custkey % 40 AS STRING) AS outbase_store_id, CAST(1 + o_custkey % 40 AS STRING) AS store_nbr,
    CAST(FLOOR(o_totalprice / 100) AS BIGINT) AS evouch_tot_amt, o_orderdate AS src_create_ts FROM orders""",
    "order_scans": f"""SELECT CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN CAST(o_orderkey AS STRING)
         ELSE 'T' || CAST(o_orderkey AS STRING) END AS trans_rcpt_nbr, o_custkey AS wallet_id, o_orderdate AS event_ts,
    {_CHANNEL} AS chnl_nm FROM orders""",
    "order_promos": """SELECT CAST(l_orderkey AS STRING) AS web_order_id, l_partkey AS promo_id, l_linenumber AS seq_nbr,
    CASE WHEN l_discount > 0 THEN 'C' || CAST(l_suppkey AS STRING) END AS disc_coupn_cd,
    'PROMO ' || l_returnflag AS promo_nm FROM lineitem""",
    "refunds": """SELECT CAST(l_orderkey AS STRING) AS order_id, l_orderkey AS singl_profl_userid,
    CAST(l_shipdate AS DATE) AS order_dlvr_dt, l_shipdate AS upd_ts,
    CAST(l_extendedprice * 4 AS DECIMAL(14, 2)) AS rfnd_amt,
    CASE l_returnflag WHEN 'N' THEN 'OPEN' WHEN 'R' THEN 'COMPLETE' END AS rfnd_status_cd FROM lineitem""",
    "sends": """SELECT date_trunc('quarter', o_orderdate) AS eventdate,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'Abandoned basket' ELSE 'J ' || o_orderpriority END AS campaignname,
    CASE WHEN o_custkey % 4 = 0 THEN 'Control' ELSE 'Send' END AS sendtype,
    o_custkey AS walletid, 'P' || CAST(o_custkey AS STRING) AS spid FROM orders""",
    "fashion_orders": """SELECT o_custkey AS walletid, 'P' || CAST(o_custkey AS STRING) AS spid, o_orderdate AS creation_date, o_orderkey AS order_id,
    CAST(o_orderkey % 6 AS INT) + 1 AS sum_order_quantity, CAST(FLOOR(o_totalprice * 100 + 0.5) AS BIGINT) AS total_order_value
    FROM (SELECT * FROM orders UNION ALL SELECT * FROM orders WHERE o_orderkey % 9 = 0) WHERE o_orderstatus = 'F'""",
    "fashion_weeks": f"""SELECT CAST(o_orderkey AS STRING) AS order_id, 'P' || CAST(o_custkey AS STRING) AS spid,
    {_PENCE.format('o_totalprice / 2')} AS sales, CAST(o_orderdate AS DATE) AS order_day FROM orders""",
    "grocery_orders": """SELECT o_custkey AS walletid, 'P' || CAST(o_custkey AS STRING) AS spid, o_orderdate AS order_sbmtd_ts,
    o_orderkey AS web_order_id, CAST(SUM(l_quantity) AS INT) AS item_qty,
    CAST(FLOOR(o_totalprice * 100 + 0.5) AS BIGINT) AS pos_tot_amt
    FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey WHERE o_orderstatus <> 'P'
    GROUP BY o_custkey, o_orderdate, o_orderkey, o_totalprice""",
    "control_population": """SELECT 'master1996-01-01' AS control_group, c_mktsegment AS segment,
    'P' || CAST(c_custkey AS STRING) AS spid FROM customer""",
    "week_orders": """SELECT CAST(o_orderkey AS STRING) AS order_id, 'P' || CAST(o_custkey AS STRING) AS spid,
    CAST(FLOOR(o_totalprice * 100 + 0.5) AS BIGINT) AS sales, CAST(o_orderdate AS DATE) AS order_day
    FROM orders WHERE o_orderstatus <> 'P'""",
    "fuel_lines": """SELECT CAST(o_orderdate AS DATE) AS visit_dt, CAST(o_orderkey % 1000 AS INT) AS trans_nbr,
    '7' AS store_nbr, CAST(o_orderkey % 9 AS INT) AS reg_nbr, 'PFS' AS store_type,
    CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS wallet_id,
    CASE WHEN l_linenumber <= 4 THEN 'FUEL' || CAST(l_linenumber - 1 AS STRING) ELSE 'SHOP' END AS upc_nbr,
    CAST(FLOOR(l_extendedprice * 100 + 0.5) AS BIGINT) AS sale_amt_inc_vat, CAST(l_quantity AS INT) AS qty,
    CASE WHEN l_tax = 0 THEN 'x' ELSE CAST(CAST(-l_quantity AS INT) AS STRING) END AS sales_adj
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "forecourt_scans": """SELECT o_custkey AS wallet_id, '7' AS store_nbr, CAST(o_orderdate AS DATE) AS visit_dt,
    CASE WHEN o_orderpriority = '1-URGENT' THEN 'pfs' ELSE 'store' END AS chnl_nm,
    CASE WHEN o_orderpriority = '5-LOW' THEN 'ZD' ELSE '' END || CAST(o_orderkey AS STRING) AS trans_rcpt_nbr,
    CAST(o_orderkey % 9 AS INT) AS reg_nbr, CAST(o_orderkey % 1000 AS INT) AS trans_nbr FROM orders""",
    "store_visits": """SELECT '7' AS store_nbr, CAST(o_orderdate AS DATE) AS visit_dt,
    CAST(o_orderkey % 9 AS INT) AS reg_nbr, CAST(o_orderkey % 1000 AS INT) AS trans_nbr,
    SUM(CAST(FLOOR(o_totalprice * 100 + 0.5) AS BIGINT)) AS tot_visit_amt, CAST(COUNT(*) AS INT) + 3 AS tot_scan_cnt
    FROM orders GROUP BY CAST(o_orderdate AS DATE), CAST(o_orderkey % 9 AS INT), CAST(o_orderkey % 1000 AS INT)""",
    "supplier_bill": f"""SELECT {_CMPGN} AS cmpgn_id, p_name AS cmpgn_nm, p_type AS offr_type_desc,
    p_brand AS offr_group_desc, l_shipdate AS cmpgn_start_ts, l_shipdate AS cmpgn_end_ts,
    l_linenumber AS cmpgn_rdmpt_cnt, CAST(FLOOR(l_extendedprice) AS BIGINT) AS cmpgn_rdmpt_val,
    l_linenumber + 1 AS coupon_alloc_cnt, l_partkey AS item_nbr, l_partkey AS prime_item_nbr,
    p_name AS prime_item_desc, CAST(p_size AS STRING) AS prime_size_desc, p_brand AS prime_brand_nm,
    l_suppkey AS prime_vendor_nbr, s_name AS prime_vendor_nm, s_nationkey AS prime_dept_nbr,
    p_type AS prime_dept_desc, p_name AS prime_catg_desc, p_type AS prime_product_variant,
    CAST(l_quantity AS INT) AS item_qty, l_extendedprice AS vat_sell_price_amt, l_extendedprice AS scan_rtl_amt,
    l_returnflag AS chnl_nm, CAST(l_shipdate AS DATE) AS visit_dt, l_orderkey AS md_process_id,
    l_shipdate AS md_source_ts, l_shipdate AS md_created_ts, l_linestatus AS md_source_path
    FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey""",
    "baskets": """SELECT 'P' || CAST(o_custkey AS STRING) AS spid, o_orderdate AS timestamp,
    o_orderstatus <> 'P' AS is_spid_connected, o_orderpriority <> '5-LOW' AS is_active,
    o_totalprice > 50000 AS is_spid_connected_direct FROM orders""",
    "ratings": """SELECT CAST(p_size % 6 AS INT) AS rating FROM part""",
    "app_opens": """SELECT CAST(ts AS DATE) AS date, CAST(COUNT(*) AS BIGINT) AS opens,
    CAST(COUNT(DISTINCT user_id) AS BIGINT) AS active_users FROM events WHERE event_type = 'view' GROUP BY CAST(ts AS DATE)""",
    "app_engagement": """SELECT CAST(ts AS DATE) AS date, CAST(COUNT(*) AS BIGINT) AS clicks FROM events
    WHERE event_type = 'click' GROUP BY CAST(ts AS DATE)""",
    "app_removes": """SELECT CAST(ts AS DATE) AS date, CAST(COUNT(*) AS BIGINT) AS removes FROM events
    WHERE event_type = 'error' GROUP BY CAST(ts AS DATE)""",
    "check_log": """SELECT CAST(user_id % 69 + 1 AS INT) AS check_id, 'check ' || CAST(user_id % 69 + 1 AS STRING) AS definition,
    event_type <> 'error' AS status, ts AS dts, event_id FROM events""",
    "check_mapping": """SELECT DISTINCT CAST(user_id % 69 + 1 AS INT) AS check_id,
    CAST(user_id % 69 % 7 AS INT) AS dependency_id,
    CASE WHEN user_id % 69 % 3 = 0 THEN 'High' ELSE 'Low' END AS severity FROM events""",
    "dependency_definitions": """SELECT DISTINCT CAST(user_id % 69 % 7 AS INT) AS dependency_id,
    'dependency ' || CAST(user_id % 69 % 7 AS STRING) AS name,
    CASE WHEN user_id % 69 % 7 < 4 THEN 'Report' ELSE 'Workflow' END AS type,
    CASE WHEN user_id % 69 % 7 % 2 = 0 THEN '{"schedule type": "Daily"}' ELSE '{"schedule type": "Weekly"}' END AS parameter
    FROM events""",
    "dependency_info": """SELECT CAST(user_id % 69 % 7 AS INT) AS dependency_id, ts AS dts,
    CASE WHEN user_id % 69 % 7 < 4
    THEN '{"refresh_id": "' || CAST(event_id AS STRING) || '", "refresh_status": "' ||
         CASE event_type WHEN 'error' THEN 'Failed' WHEN 'view' THEN 'Unknown' ELSE 'Completed' END ||
         '", "refresh_start_time": "2024-01-30 05:00:00", "refresh_end_time": "2024-01-30 05:10:00", "refresh_duration_in_seconds": 600}'
    ELSE '{"run_id": "' || CAST(event_id AS STRING) || '", "state": {"life_cycle_state": "TERMINATED", "result_state": "' ||
         CASE event_type WHEN 'error' THEN 'FAILED' ELSE 'SUCCESS' END ||
         '"}, "start_time": 1706594400000, "end_time": 1706594460500}' END AS info FROM events""",
    "store_days_role": """SELECT CAST(o_custkey % 12 AS STRING) AS store_nbr, o_orderdate AS event_ts FROM orders""",
}

# the calendar is generated; the DuckDB side of the same rule
CALENDAR_SQL = f"""SELECT day_date, CAST(year(friday) * 100 + CAST(ceil(dayofyear(friday) / 7.0) AS INT) AS INT) AS retail_week,
    CAST(year(friday) AS INT) AS retail_year
    FROM (SELECT CAST(d AS DATE) AS day_date, CAST(d AS DATE) + CAST((12 - dayofweek(d)) % 7 AS INT) AS friday
          FROM generate_series(TIMESTAMP '{CALENDAR_START}', TIMESTAMP '{CALENDAR_END}', INTERVAL 1 DAY) AS g(d))"""


class Roles:
    """Roles of one data folder as lazy DataFrames: ``roles.scans``, ``roles.accounts``, ..."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._built: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        key = f"table {name}"
        if key not in self._built:
            self._built[key] = read_table(self.spark, self.folder, name)
        return self._built[key]

    def __getattr__(self, name: str) -> DataFrame:
        if name not in ROLES:
            raise AttributeError(name)
        if name in self._built:
            return self._built[name]
        sql = ROLES[name]
        used = [t for t in TABLES if re.search(rf"\b(FROM|JOIN) {t}\b", sql)]
        sql = sql.replace("{", "{{").replace("}", "}}")
        for t in used:
            sql = re.sub(rf"\b(FROM|JOIN) {t}\b", rf"\1 {{{t}}}", sql)
        self._built[name] = self.spark.sql(sql, **{t: self.table(t) for t in used})
        return self._built[name]

    def select(self, sql: str) -> DataFrame:
        """A SELECT over roles and the calendar."""
        used = [name for name in (*ROLES, "calendar") if re.search(rf"\b(FROM|JOIN) {name}\b", sql)]
        for name in used:
            sql = re.sub(rf"\b(FROM|JOIN) {name}\b", rf"\1 {{{name}}}", sql)
        return self.spark.sql(sql, **{name: getattr(self, name) for name in used})

    @property
    def calendar(self) -> DataFrame:
        return retail_calendar(self.spark, CALENDAR_START, CALENDAR_END)

    @property
    def missions_with_progress(self) -> DataFrame:
        return self.missions.withColumn("mssn_prgrss_struct", F.struct("progress_qty")).drop("progress_qty")
