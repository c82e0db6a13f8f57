"""Vouchers, pots, credits, games and the monthly liability ledger."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stampbook.functions import Band, band_label, band_order, bands_from_edges, minor_to_major, month_key, on_days, ratio
from stampbook.functions.bands import band_payload
from stampbook.operators import first_per_key
from stampbook.scheme import Scheme

# --- vouchers ----------------------------------------------------------------


def expired_vouchers(voucher_rows: DataFrame, as_of: date) -> DataFrame:
    """Unredeemed vouchers past their end, per campaign, end day, channel and status."""
    return (
        voucher_rows.filter(F.col("reward_redm_ts").isNull() & on_days("reward_end_ts", None, as_of))
        .groupBy("cmpgn_id", F.to_date("reward_end_ts").alias("reward_end_dt"), "store_nbr", "chnl_nm", "acct_status_id")
        .agg(
            F.count(F.lit(1)).alias("vouchers_expired"),
            minor_to_major(F.sum(F.coalesce("value_pence", F.lit(0)))).alias("voucher_value_pounds_expired"),
        )
        # the report has no store for an unredeemed voucher
        .withColumn("store_nbr", F.lit(None).cast("string"))
    )


def vouchers_daily(voucher_rows: DataFrame) -> DataFrame:
    """Vouchers created and redeemed per campaign, gained day, redeemed day, store and channel."""
    redeemed = F.col("reward_redm_ts").isNotNull()
    return (
        voucher_rows.groupBy(
            "cmpgn_id",
            F.to_date("reward_gained_ts").alias("reward_gained_dt"),
            F.to_date("reward_redm_ts").alias("reward_redm_dt"),
            "store_nbr",
            "chnl_nm",
            "acct_status_id",
        )
        .agg(
            F.count_if(redeemed).alias("vouchers_redeemed"),
            minor_to_major(F.sum(F.when(redeemed, F.col("value_pence")).otherwise(0))).alias(
                "voucher_value_pounds_redeemed"
            ),
            F.count("cmpgn_id").alias("vouchers_created"),
            minor_to_major(F.sum("value_pence")).alias("voucher_value_pounds_created"),
        )
        .withColumn("vouchers_expired", F.lit(None).cast("long"))
        .withColumn("voucher_value_pounds_expired", F.lit(None).cast("double"))
    )


def vouchers_by_value(voucher_rows: DataFrame) -> DataFrame:
    """Vouchers created and redeemed per pound value, for values with at least one redemption."""
    return (
        voucher_rows.filter("voucher_value_pounds is not null")
        .groupBy("voucher_value_pounds")
        .agg(
            F.count("wallet_id").alias("num_ppl_create"),
            F.count(F.when(F.col("reward_redm_ts").isNotNull(), F.col("wallet_id"))).alias("num_ppl_redeemed"),
            F.count_if(F.col("reward_redm_ts").isNotNull()).alias("_redeemed"),
        )
        .filter("_redeemed > 0")
        .drop("_redeemed")
    )


def vouchers_by_size(voucher_rows: DataFrame, cap: int = 15) -> DataFrame:
    """Redeemed vouchers per pound value, with one row for everything above ``cap``."""
    value = F.col("voucher_value_pounds")
    size = F.when(value <= cap, value.cast("string")).when(value > cap, F.lit(f"{cap}+"))
    return (
        voucher_rows.filter("reward_redm_ts is not null")
        .groupBy(size.alias("voucher_value_pounds"))
        .agg(F.count("wallet_id").alias("num_ppl"))
    )


# fixed values: hold-time bands in minutes
HOLD_BANDS = [
    Band("Less than 5 minutes", None, 5, 1),
    *bands_from_edges(
        [5, 30, 60, 300, 1440, 2880, 7200],
        ["5-29 minutes", "30 minutes -59 minutes", "1-5 hours", "5-24 hours", "1-2 days", "2-5 days", "5 days +"],
        first_order=2,
    ),
]


def voucher_hold_time(voucher_rows: DataFrame) -> DataFrame:
    """Redeemed vouchers by the time between gain and redemption."""
    minutes = F.timestamp_diff("SECOND", F.col("reward_gained_ts"), F.col("reward_redm_ts")) / F.lit(60.0)
    return (
        voucher_rows.filter("reward_redm_ts is not null")
        .groupBy(
            band_label(minutes, HOLD_BANDS).alias("time_held_category"),
            band_order(minutes, HOLD_BANDS).alias("time_held_category_order"),
        )
        .agg(F.count("wallet_id").alias("num_vouchers"))
    )


def voucher_orders(order_promos: DataFrame, orders: DataFrame) -> DataFrame:
    """Orders with a coupon code, first promotion record of each only."""
    promos = order_promos.filter("disc_coupn_cd is not null and seq_nbr = 1").select(
        "web_order_id", "promo_id", "disc_coupn_cd", "promo_nm"
    )
    return promos.join(orders, "web_order_id").select(
        "singl_profl_id",
        "promo_id",
        "web_order_id",
        "disc_coupn_cd",
        "order_status_nm",
        "evouch_tot_amt",
        "dlvr_dt",
        "src_create_ts",
        "promo_nm",
        "pos_tot_amt",
    )


def voucher_shortfall(
    scans: DataFrame,
    refunds: DataFrame,
    orders: DataFrame,
    reward_wallets: DataFrame,
    versions: DataFrame,
    accounts: DataFrame,
    as_of: date,
    delivered_after: date,
) -> DataFrame:
    """Online orders paid with vouchers whose refund exceeds the order total."""
    refunded = (
        refunds.filter("rfnd_status_cd is null or rfnd_status_cd = 'COMPLETE'")
        .groupBy("order_id", "singl_profl_userid", "order_dlvr_dt", F.to_date("upd_ts").alias("rfnd_dt"))
        .agg(F.sum("rfnd_amt").alias("total_rfnd_amt"))
        .select(F.col("order_id").alias("web_order_id"), "rfnd_dt", "total_rfnd_amt")
    )
    placed = orders.filter(
        (F.col("order_status_nm") != "CANCELLED") & (F.col("dlvr_dt") > F.lit(delivered_after))
    ).select("web_order_id", "web_order_tot_amt", "singl_profl_id")
    online = scans.filter("chnl_nm = 'ecom'").select(
        F.col("trans_rcpt_nbr").alias("web_order_id"), "wallet_id", "event_ts"
    )
    used = reward_wallets.filter("reward_status_desc = 'USED' and rec_status_ind = 'CURRENT'").select(
        "wallet_id", "cmpgn_id", F.col("reward_redm_ts").alias("event_ts")
    )
    value = versions.filter(
        "cmpgn_clsfctn_nm = 'COUPON' and cmpgn_status_desc = 'ACTIVE' and rec_status_ind = 'CURRENT' and disc_amt > 0"
    ).select("cmpgn_id", "disc_amt")
    ids = accounts.select("wallet_id", "loyalty_id")
    # vouchers used at one instant are one sum before they meet the orders
    paid = used.join(value, "cmpgn_id").groupBy("wallet_id", "event_ts").agg(F.sum("disc_amt").alias("disc_amt"))
    return (
        online.join(placed, "web_order_id")
        .join(refunded, "web_order_id")
        .join(paid, ["wallet_id", "event_ts"])
        .join(ids, "wallet_id", "left")
        .groupBy(
            "wallet_id",
            F.col("singl_profl_id").alias("spid"),
            "loyalty_id",
            "web_order_id",
            "event_ts",
            "web_order_tot_amt",
            "total_rfnd_amt",
            "rfnd_dt",
        )
        .agg(F.sum("disc_amt").alias("_pence"))
        .filter("total_rfnd_amt > 0 and total_rfnd_amt > web_order_tot_amt")
        .withColumn("credit_amt", (F.col("total_rfnd_amt") - F.col("web_order_tot_amt")).cast("double"))
        .select(
            "wallet_id",
            "spid",
            "loyalty_id",
            F.col("web_order_id").alias("order_id"),
            F.to_date("event_ts").alias("delivery_date"),
            F.col("rfnd_dt").alias("refund_date"),
            minor_to_major("_pence").alias("rewards_voucher_val"),
            "credit_amt",
            F.lit(as_of).alias("today_date"),
            F.when(F.col("credit_amt") < minor_to_major("_pence"), 1).otherwise(0).alias("credit_indicator"),
        )
    )


# --- external credits, goodwill, games ---------------------------------------


def bulk_upload(external_credits: DataFrame, scheme: Scheme = Scheme()) -> DataFrame:
    """Non-card credits per load day and reference prefix."""
    short = F.left("ref_id", F.lit(10))
    long = F.left("ref_id", F.lit(20))
    return (
        external_credits.filter(F.col("chnl_nm") != scheme.card_channel)
        .groupBy(
            F.to_date("event_ts").alias("load_dt"),
            F.when(on_days("event_ts", None, scheme.reference_prefix_change), short).otherwise(long).alias("ref_camp"),
        )
        .agg(F.count("wallet_id").alias("volume"), minor_to_major(F.sum("trans_amt")).alias("amount"))
    )


def _daily_pounds(rows: DataFrame, ts: str, amount: str, day_alias: str, alias: str) -> DataFrame:
    return rows.groupBy(F.to_date(ts).alias(day_alias)).agg(F.round(minor_to_major(F.sum(amount)), 2).alias(alias))


def card_credits(external_credits: DataFrame, scheme: Scheme = Scheme()) -> DataFrame:
    rows = external_credits.filter(F.col("chnl_nm").startswith(scheme.card_channel_prefix))
    return _daily_pounds(rows, "trans_ts", "trans_amt", "trans_dt", "sum_trans_amt")


def goodwill(credits: DataFrame) -> DataFrame:
    return _daily_pounds(credits.filter("event_nm = 'GOODWILL'"), "event_ts", "cr_pnts_qty", "event_dt", "goodwill_amt")


def game_giveaway(games: DataFrame, as_of: date) -> DataFrame:
    """Winners and pounds given away per day and prize."""
    return (
        games.filter((F.col("rec_status_ind") == "CURRENT") & on_days("game_redm_ts", None, as_of))
        .groupBy(F.to_date("game_redm_ts").alias("game_redm_dt"), "game_win_val")
        .agg(F.count(F.lit(1)).alias("customer_count"))
        .select(
            "game_redm_dt",
            F.round(minor_to_major("game_win_val"), 2).alias("game_win_pounds"),
            "customer_count",
            minor_to_major(F.col("game_win_val") * F.col("customer_count")).alias("giveaway"),
        )
    )


def game_spins(games: DataFrame, as_of: date) -> DataFrame:
    return (
        games.filter((F.col("rec_status_ind") == "CURRENT") & on_days("game_start_ts", None, as_of))
        .groupBy(F.to_date("game_start_ts").alias("game_start_dt"))
        .agg(F.count(F.lit(1)).alias("customer_count"))
    )


# fixed values: columns of the supplier bill that pass through unchanged
BILL_COLUMNS = (
    "cmpgn_id", "cmpgn_nm", "offr_type_desc", "offr_group_desc", "cmpgn_start_ts", "cmpgn_end_ts",
    "cmpgn_rdmpt_cnt", "cmpgn_rdmpt_val", "coupon_alloc_cnt", "item_nbr", "prime_item_desc", "prime_size_desc",
    "prime_brand_nm", "prime_vendor_nbr", "prime_vendor_nm", "prime_dept_nbr", "prime_dept_desc", "prime_catg_desc",
    "item_qty", "vat_sell_price_amt", "scan_rtl_amt", "chnl_nm", "visit_dt",
    "md_process_id", "md_source_ts", "md_created_ts", "md_source_path",
)


def supplier_billing(bill: DataFrame) -> DataFrame:
    """Supplier bill with dates, pounds and two columns kept empty for the report model."""
    return bill.select(
        *BILL_COLUMNS,
        minor_to_major("cmpgn_rdmpt_val").alias("coupon_cashpot_given"),
        F.col("prime_item_nbr").cast("string").alias("prime_item_nbr"),
        F.initcap("prime_product_variant").alias("prime_product_variant"),
        F.to_date("cmpgn_start_ts").alias("cmpgn_start_dt"),
        F.to_date("cmpgn_end_ts").alias("cmpgn_end_ds"),
        F.lit(None).cast("double").alias("funding"),
        F.lit(None).cast("double").alias("owed"),
    )


# --- pots --------------------------------------------------------------------


def _current_pots(pot_setup: DataFrame) -> DataFrame:
    return pot_setup.filter("rec_status_ind = 'CURRENT'").select("scheme_id", "cashpot_nm")


def _named_transfers(transfers: DataFrame, balances: DataFrame, pot_setup: DataFrame) -> DataFrame:
    pots = balances.select("cashpot_id", "scheme_id").join(_current_pots(pot_setup), "scheme_id")

    def side(prefix: str) -> DataFrame:
        return pots.select(
            F.col("cashpot_id").alias(f"cashpot_id_{prefix}"),
            F.col("scheme_id").alias(f"{prefix}_scheme_id"),
            F.col("cashpot_nm").alias(f"{prefix}_cashpot_nm"),
        )

    return (
        transfers.filter("rsn_cd = 'TRANSFER'")
        .withColumn("trans_dt", F.to_date("trans_ts"))
        .join(side("src"), "cashpot_id_src")
        .join(side("dest"), "cashpot_id_dest")
    )


TRANSFER_KEYS = ("trans_dt", "src_scheme_id", "src_cashpot_nm", "dest_scheme_id", "dest_cashpot_nm")


def pot_transfers(transfers: DataFrame, balances: DataFrame, pot_setup: DataFrame, as_of: date) -> DataFrame:
    """Pounds, transfers and people per day and pair of pots."""
    rows = transfers.filter(on_days("trans_ts", None, as_of))
    return (
        _named_transfers(rows, balances, pot_setup)
        .groupBy(*TRANSFER_KEYS)
        .agg(
            minor_to_major(F.sum("cashpot_val_dest")).alias("amt_transfered"),
            F.count("wallet_id_dest").alias("num_transfers"),
            F.countDistinct("wallet_id_dest").alias("num_people"),
        )
    )


def pot_first_users(transfers: DataFrame, balances: DataFrame, pot_setup: DataFrame, as_of: date) -> DataFrame:
    """Wallets whose first transfer falls on the day, per pair of pots."""
    firsts = first_per_key(
        _named_transfers(transfers, balances, pot_setup),
        ["wallet_id_dest"],
        [F.col(c).asc() for c in ("trans_ts", "src_scheme_id", "dest_scheme_id")],
    )
    return (
        firsts.filter(F.col("trans_dt") < F.lit(as_of))
        .groupBy(*TRANSFER_KEYS)
        .agg(F.countDistinct("wallet_id_dest").alias("num_first_users"))
    )


def pot_balances(balances: DataFrame, pot_setup: DataFrame) -> DataFrame:
    """Pounds and users per pot, empty balances left out."""
    per_scheme = (
        balances.filter("curr_cash_bnk_pnts_qty != 0")
        .groupBy("scheme_id")
        .agg(
            minor_to_major(F.sum("curr_cash_bnk_pnts_qty")).alias("total_cashpot"),
            F.countDistinct("wallet_id").alias("users"),
        )
    )
    return per_scheme.join(_current_pots(pot_setup), "scheme_id").select(
        "scheme_id", "cashpot_nm", "total_cashpot", "users"
    )


def pot_thresholds(
    accounts: DataFrame, as_of: date, pounds: tuple[int, ...] = (10, 20), scheme: Scheme = Scheme()
) -> DataFrame:
    """Live wallets at or above each balance: count, share and pounds."""
    balance = F.col("curr_cash_bnk_pnts_qty")
    live_guest = (F.col("acct_status_id") == "TEMP") & on_days(
        "regtn_ts", as_of - timedelta(days=scheme.guest_expiry_days), None
    )
    totals = accounts.filter((F.col("acct_status_id") == "DEFAULT") | live_guest).agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(balance >= p * 100).alias(f"n{p}") for p in pounds],
        *[F.sum(F.when(balance >= p * 100, balance).otherwise(0)).alias(f"v{p}") for p in pounds],
    )
    rows = [
        F.struct(
            F.lit(f"Current cashpot greater than (or equal to) £{p}").alias("desc"),
            F.col(f"n{p}").alias("num_wallets"),
            ratio(f"n{p}", "total").alias("percentage_of_total"),
            minor_to_major(f"v{p}").alias("curr_cashpot"),
        )
        for p in pounds
    ]
    return totals.select(F.inline(F.array(*rows)))


# fixed values: saver bands in pence with index and boost in pounds
SAVER_BANDS = [
    Band("<£10", None, 1000, "1", 0),
    Band("£10-£19.99", 1000, 2000, "2", 1),
    Band("£20-£24.99", 2000, 2500, "3", 2),
    Band("£25-£39.99", 2500, 4000, "4", 3),
    Band("£40-£49.99", 4000, 5000, "5", 5),
    Band("£50-£59.99", 5000, 6000, "6", 5),
    Band("£60-£69.99", 6000, 7000, "7", 5),
    Band(">=£70", 7000, None, "8", 5),
]


def saver_bands(balances: DataFrame, scheme: Scheme = Scheme()) -> DataFrame:
    """Savers per balance band with the boost they earn and its cost."""
    balance = F.col("curr_cash_bnk_pnts_qty")
    return (
        balances.filter((F.col("scheme_id") == scheme.saver_scheme) & (balance != 0))
        .groupBy(
            band_order(balance, SAVER_BANDS).alias("index"),
            band_label(balance, SAVER_BANDS).alias("cashpot"),
            band_payload(balance, SAVER_BANDS).alias("boost"),
        )
        .agg(F.countDistinct("wallet_id").alias("customer_count"))
        .withColumn("boost_cost", F.col("customer_count") * F.col("boost"))
    )


# --- liability ---------------------------------------------------------------


def liability(
    completions: DataFrame,
    credits: DataFrame,
    external_credits: DataFrame,
    movements: DataFrame,
    account_rows: DataFrame,
    voucher_rows: DataFrame,
    as_of: date,
    scheme: Scheme = Scheme(),
) -> DataFrame:
    """Monthly ledger of ten lines, and the liability left as line 11.

    Amounts are summed in pence; each month's ledger is a handful of rows. Completions and
    vouchers may hold the values of their campaign's tied versions summed, in one row.
    """
    status = scheme.status_campaign

    def line(rows: DataFrame, index: Column | int, ts: str, pence: Column) -> DataFrame:
        number = F.lit(index) if isinstance(index, int) else index
        return rows.groupBy(number.alias("index"), month_key(F.to_date(ts)).alias("dt")).agg(F.sum(pence).alias("pence"))

    card = F.col("chnl_nm").startswith(scheme.card_channel_prefix)
    moved = movements.join(account_rows.select("wallet_id", "acct_status_id"), "wallet_id", "left")
    voucher_value = F.col("value_pence")
    redeemed = F.col("reward_redm_ts").isNotNull()
    expired = ~redeemed & on_days("reward_end_ts", None, as_of)

    def entry(index: int, ts: str, value: Column) -> Column:
        return F.struct(F.lit(index).alias("index"), F.col(ts).alias("ts"), value.alias("value"))

    # a voucher is created and then expires or is redeemed: up to two entries from one read
    entries = F.array(
        entry(8, "reward_gained_ts", voucher_value),
        F.when(expired, entry(9, "reward_end_ts", -F.coalesce(voucher_value, F.lit(0)))).when(
            redeemed, entry(10, "reward_redm_ts", -voucher_value)
        ),
    )
    voucher_lines = voucher_rows.select(F.inline(F.array_compact(entries)))
    lines = [
        line(
            completions,
            F.when(F.col("cmpgn_id") == status, 2).otherwise(1),
            "cmpgn_cmplt_ts",
            F.col("mission_value_pence"),
        ),
        line(credits.filter("event_nm = 'GOODWILL'"), 3, "event_ts", F.col("cr_pnts_qty")),
        line(external_credits.filter("chnl_nm is not null"), F.when(card, 4).otherwise(5), "event_ts", F.col("trans_amt")),
        line(
            moved,
            F.when(F.col("acct_status_id") == "DEFAULT", 6).otherwise(7),
            "event_ts",
            F.coalesce(F.col("cashpot_val_exp"), F.lit(0)),
        ),
        line(voucher_lines, F.col("index"), "ts", F.col("value")),
    ]
    ledger = lines[0]
    for more in lines[1:]:
        ledger = ledger.unionByName(more)
    # line 11 repeats the rows it sums under its own index, so the ledger is built once
    in_liability = F.col("index").between(1, 7) | F.col("index").isin(9, 10)
    with_total = ledger.select(
        "dt",
        "pence",
        F.explode(F.array_compact(F.array(F.col("index"), F.when(in_liability, F.lit(11))))).alias("index"),
    )
    # fixed values: names of the ledger lines
    names = {
        1: f"total cashpot from campaigns (excl. {scheme.status_label}) (historic)",
        2: f"total cashpot from {scheme.status_label} (historic)",
        3: "goodwill (historic)",
        4: "credit cards",
        5: "colleague incentive (historic)",
        6: "Expired from cashpots (Default)",
        7: "Expired from cashpots (TEMP)",
        8: "vouchers created (historic)",
        9: "vouchers expired (historic)",
        10: "vouchers redeemed (historic)",
        11: "Liability remaining",
    }
    labels = F.element_at(F.array(*[F.lit(names[i]) for i in range(1, 12)]), F.col("index"))
    return (
        with_total.groupBy("index", "dt")
        .agg(F.sum("pence").alias("pence"))
        .select("index", labels.alias("type"), minor_to_major("pence").alias("val"), "dt")
    )
