"""Activity, retention and registered-not-scanned reports."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stampbook.functions import Band, band_label, band_order, on_days, profile_or_wallet, ratio
from stampbook.operators import exact_median, first_days, metric_grid, rolling_distinct, running_totals
from stampbook.scheme import Scheme


def scan_days(scans: DataFrame, start: date | None, end: date | None) -> DataFrame:
    """Distinct (wallet, day) pairs of scans in ``[start, end)``."""
    return scans.filter(on_days("event_ts", start, end)).select(
        "wallet_id", F.to_date("event_ts").alias("scan_day")
    ).distinct()


# --- first scans and cumulative series --------------------------------------


def first_scans(scans: DataFrame, accounts: DataFrame, as_of: date) -> DataFrame:
    """People scanning for the first time per day, and the running total."""
    firsts = first_days(scans, "wallet_id", "event_ts", "first_scan_dt")
    daily = (
        firsts.filter(F.col("first_scan_dt") < F.lit(as_of))
        .join(accounts.select("wallet_id").distinct(), "wallet_id", "left_semi")
        .groupBy("first_scan_dt")
        .agg(F.count(F.lit(1)).alias("num_people"))
    )
    running = Window.orderBy("first_scan_dt")
    return daily.withColumn("cumu_people", F.sum("num_people").over(running))


def scans_daily(scan_rows: DataFrame) -> DataFrame:
    """Transactions per day and store, with the day's users and cumulative users."""
    day = F.to_date("event_ts").alias("event_dt")
    per_store = scan_rows.groupBy(day, "store_nbr").agg(F.count("wallet_id").alias("num_transactions"))
    per_day = scan_rows.groupBy(day).agg(F.countDistinct("wallet_id").alias("num_users_scanning"))
    newcomers = (
        first_days(scan_rows, "wallet_id", "event_ts", "event_dt")
        .groupBy("event_dt")
        .agg(F.count(F.lit(1)).alias("active_cum"))
    )
    # the running total exists on days that brought at least one new wallet
    cumulative = running_totals(newcomers, "event_dt", ["active_cum"])
    return (
        per_store.join(per_day, "event_dt", "left")
        .join(cumulative, "event_dt", "left")
        .withColumn("acct_status_id", F.lit(None).cast("string"))
    )


def active_time_series(
    sign_up_days: DataFrame, scan_rows: DataFrame, calendar_days: DataFrame, as_of: date, scheme: Scheme = Scheme()
) -> DataFrame:
    """Cumulative scanners, cumulative sign-ups and their ratio per sign-up day."""
    spine = calendar_days.filter(
        (F.col("day_date") >= F.lit(scheme.series_start)) & (F.col("day_date") < F.lit(as_of))
    ).select(F.col("day_date").alias("event_dt"))
    newcomers = (
        first_days(scan_rows, "wallet_id", "event_ts", "event_dt")
        .groupBy("event_dt")
        .agg(F.count(F.lit(1)).alias("active_cum"))
        .filter(F.col("event_dt") >= F.lit(scheme.series_start))
    )
    active = running_totals(newcomers, "event_dt", ["active_cum"], spine, "event_dt")
    registered = running_totals(
        sign_up_days.select(F.col("signup_dt").alias("event_dt"), F.col("num_sign_ups").alias("sign_ups_cum")),
        "event_dt",
        ["sign_ups_cum"],
    )
    return (
        active.join(registered, "event_dt")
        .filter(F.col("event_dt") >= F.lit(scheme.launch))
        .withColumn("active_cum", F.when(F.col("active_cum") > 0, F.col("active_cum")))
        .withColumn("percenta", ratio("active_cum", "sign_ups_cum"))
    )


# --- rolling distinct counts -------------------------------------------------


def activity_time_series(
    scans: DataFrame, spine: DataFrame, spine_day: str = "full_date", first: date | None = None, as_of: date | None = None
) -> DataFrame:
    """Distinct active wallets in the 1, 7, 30 and 91 days before each spine day.

    With the spine's ``first`` day and ``as_of``, scans are read from 91 days before it to the day before ``as_of``.
    """
    windows = {
        "active_prev_d": (1, 1),
        "active_prev_7d": (7, 1),
        "active_prev_30d": (30, 1),
        "active_prev_91d": (91, 1),
    }
    since = None if first is None else first - timedelta(days=91)
    read = scans if since is None and as_of is None else scans.filter(on_days("event_ts", since, as_of))
    days = read.select("wallet_id", F.to_date("event_ts").alias("scan_day"))
    return rolling_distinct(days, "wallet_id", "scan_day", windows, spine, spine_day)


def rolling_quarter_active(
    scans: DataFrame, calendar_days: DataFrame, as_of: date, start: date, days: int = 91
) -> DataFrame:
    """Distinct wallets in the ``days`` days ending at each month end."""
    month_ends = (
        calendar_days.filter(F.col("day_date") >= F.lit(start))
        .groupBy(F.trunc("day_date", "month").alias("_month"))
        .agg(F.max("day_date").alias("month_end"))
        .filter(F.col("month_end") <= F.lit(as_of))
        .select("month_end")
    )
    # the last month end may be as_of itself
    read = scans.filter(on_days("event_ts", start - timedelta(days=days), as_of + timedelta(days=1)))
    seen = read.select("wallet_id", F.to_date("event_ts").alias("scan_day"))
    return rolling_distinct(
        seen, "wallet_id", "scan_day", {"active_quarter": (days - 1, 0)}, month_ends, "month_end"
    ).filter("active_quarter > 0")


def active_segments(scans: DataFrame, as_of: date, scheme: Scheme, period: str, alias: str) -> DataFrame:
    """Distinct active wallets per calendar period ('month' or 'week')."""
    start = F.to_date(F.date_trunc(period, "event_ts")).alias(alias)
    return (
        scans.filter(on_days("event_ts", scheme.launch, as_of))
        .groupBy(start)
        .agg(F.countDistinct("wallet_id").alias("active_wallets"))
    )


def active_earners(
    missions: DataFrame, games: DataFrame, scans: DataFrame, spine: DataFrame, as_of: date, scheme: Scheme = Scheme()
) -> DataFrame:
    """Distinct earners and scanners in the seven days ending on each day, and their ratio."""
    completed = missions.filter(
        on_days("cmpgn_cmplt_ts", scheme.launch, as_of)
        & (F.col("rec_status_ind") == "CURRENT")
        & (F.col("cmpgn_id") != scheme.earners_excluded_campaign)
    ).select("wallet_id", F.to_date("cmpgn_cmplt_ts").alias("day"))
    won = games.filter(on_days("game_redm_ts", None, as_of) & (F.col("rec_status_ind") == "CURRENT")).select(
        "wallet_id", F.to_date("game_redm_ts").alias("day")
    )
    scanned = scans.filter(on_days("event_ts", scheme.launch, as_of)).select(
        "wallet_id", F.to_date("event_ts").alias("day")
    )
    earning = rolling_distinct(
        completed.unionByName(won), "wallet_id", "day", {"earning_7d": (6, 0)}, spine, "full_date"
    )
    active = rolling_distinct(scanned, "wallet_id", "day", {"active_7d": (6, 0)}, spine, "full_date")
    return (
        earning.join(active, "full_date")
        .filter("earning_7d > 0 and active_7d > 0")
        .withColumn("percentage", ratio("earning_7d", "active_7d"))
    )


def active_earning_ratio(missions: DataFrame, scans: DataFrame, as_of: date) -> DataFrame:
    """Distinct earners over distinct scanners, last 365 and last 7 days (one row)."""
    year_ago, week_ago = as_of - timedelta(days=365), as_of - timedelta(days=7)

    def reach(rows: DataFrame, ts: str, prefix: str) -> DataFrame:
        # latest day per wallet answers both windows with one plain aggregate
        return (
            rows.filter(on_days(ts, year_ago, as_of))
            .groupBy("wallet_id")
            .agg(F.max(ts).alias("last"))
            .agg(
                F.count(F.lit(1)).alias(f"{prefix}_year"),
                F.count_if(on_days(F.col("last"), week_ago, None)).alias(f"{prefix}_week"),
            )
        )

    earners, scanners = reach(missions, "cmpgn_cmplt_ts", "earn"), reach(scans, "event_ts", "scan")
    return earners.select(
        ratio("earn_year", scanners.select("scan_year").scalar()).alias("active_earning_ytd"),
        ratio("earn_week", scanners.select("scan_week").scalar()).alias("active_earning_7days"),
    )


# --- funnels -----------------------------------------------------------------


def _gaps(days: DataFrame) -> DataFrame:
    """Previous distinct scan day per wallet and day."""
    return days.withColumn("prev_day", F.lag("scan_day").over(Window.partitionBy("wallet_id").orderBy("scan_day")))


FUNNEL_COUNTS = ("total", "new_one_scanners", "new_active", "reactive_active", "recycling_active")


def active_funnel(
    scans: DataFrame, accounts: DataFrame, as_of: date, expiry_cutoff: date, scheme: Scheme = Scheme()
) -> DataFrame:
    """Wallets by weeks since their last scan, split into new, reactivated and retained.

    ``expiry_cutoff`` is the registration day before which a temporary account
    counts as expired.
    """
    last = (
        _gaps(scan_days(scans, None, as_of))
        .groupBy("wallet_id")
        .agg(
            F.max("scan_day").alias("last_day"),
            F.min("scan_day").alias("first_day"),
            F.max_by("prev_day", "scan_day").alias("prev_day"),
        )
    )
    age = F.datediff(F.lit(as_of), "first_day")
    span = F.datediff("last_day", "first_day")
    gap = F.datediff("last_day", "prev_day")
    weeks = F.ceil(F.datediff(F.lit(as_of), "last_day") / F.lit(7)).cast("int")
    expired = (F.to_date("regtn_ts") < F.lit(expiry_cutoff)) & (F.col("acct_status_id") == "TEMP")
    conditions = {
        "total": F.lit(True),
        "new_one_scanners": age <= 7,
        "new_active": (age > 7) & (span <= scheme.active_days),
        "reactive_active": (span > scheme.active_days) & (gap > scheme.lapse_gap_days),
        "recycling_active": (span > scheme.active_days) & (gap <= scheme.lapse_gap_days),
    }
    return (
        last.join(accounts.select("wallet_id", "regtn_ts", "acct_status_id"), "wallet_id")
        .withColumn(
            "week_cat",
            F.when(weeks < 14, weeks.cast("string")).when(~F.coalesce(expired, F.lit(False)), F.lit("Lapsed")),
        )
        .filter("week_cat is not null")
        .groupBy("week_cat")
        .agg(*[F.count_if(c).alias(name) for name, c in conditions.items()])
    )


def active_breakdown(current: DataFrame, previous: DataFrame) -> DataFrame:
    """Funnel of this week beside the change from last week."""
    changes = {
        "total_wk_chng": "total",
        "first_week_wk_chng": "new_one_scanners",
        "new_wk_chng": "new_active",
        "retained_wk_chng": "recycling_active",
        "reactive_wk_chng": "reactive_active",
    }
    before = previous.select("week_cat", *[F.col(c).alias(f"_{c}") for c in FUNNEL_COUNTS])
    week = F.col("week_cat").try_cast("int")
    return current.join(before, "week_cat").select(
        F.coalesce(week, F.lit(14)).alias("index"),
        F.when(week.isNull(), F.col("week_cat"))
        .otherwise(F.concat_ws(" ", (week - 1).cast("string"), F.lit("-"), week.cast("string"), F.lit("Weeks Ago")))
        .alias("heading"),
        "week_cat",
        *FUNNEL_COUNTS,
        *[(F.col(c) - F.col(f"_{c}")).alias(name) for name, c in changes.items()],
    )


def nursery_time_series(
    scans: DataFrame, spine: DataFrame, scheme: Scheme = Scheme(), as_of: date | None = None
) -> DataFrame:
    """Reactivated, lapsed and nursery wallets per day.

    A row for day D looks at scans up to D+1: lapsed when the last scan is more
    than 92 days back, nursery with fewer than four scans and the last at most
    30 days back, reactivated when D itself follows a gap of more than 92 days.
    """
    return nursery_from_days(scan_counts(scans, scheme.launch, as_of), spine, scheme)


def scan_counts(scans: DataFrame, first: date | None, before: date | None) -> DataFrame:
    """wallet_id, scan_day and n, the scans of a wallet on a day."""
    per_day = scans.filter(on_days("event_ts", first, before)).groupBy("wallet_id", F.to_date("event_ts").alias("scan_day"))
    return per_day.agg(F.count(F.lit(1)).alias("n"))


def last_scans(state: DataFrame | None, counts: DataFrame) -> DataFrame:
    """The state of each wallet, its last scan_day and its number of scans so far (n), moved on by later ``scan_counts``.

    The state has the columns of ``scan_counts``: a wallet's past is one day with all its scans.
    """
    rows = counts if state is None else state.select(*counts.columns).unionByName(counts)
    return rows.groupBy("wallet_id").agg(F.max("scan_day").alias("scan_day"), F.sum("n").alias("n"))


def nursery_from_days(per_day: DataFrame, spine: DataFrame, scheme: Scheme = Scheme()) -> DataFrame:
    """``nursery_time_series`` from ``scan_counts``, or from a wallets' state (``last_scans``) and the counts after it.

    With a state, the days of ``spine`` must lie after the day before the state's last.
    """
    history = Window.partitionBy("wallet_id").orderBy("scan_day")
    days = per_day.select(
        "scan_day",
        F.lag("scan_day").over(history).alias("prev_day"),
        F.coalesce(F.lead("scan_day").over(history), F.lit(date(9999, 1, 1))).alias("next_day"),
        F.sum("n").over(history.rowsBetween(Window.unboundedPreceding, 0)).alias("so_far"),
    )
    gap = scheme.lapse_gap_days

    def step(day: Column, column: str, delta: int, condition: Column) -> Column:
        values = [F.lit(delta if c == column else 0).alias(c) for c in ("lapsed", "nursery")]
        return F.when(condition, F.struct(F.date_sub(day, 1).alias("full_date"), *values))

    lapse_from = F.date_add("scan_day", gap + 1)
    nursery_to = F.least(F.date_add("scan_day", 31), F.col("next_day"))
    goes_quiet = F.col("next_day") > lapse_from
    young = F.col("so_far") < 4
    steps = F.array_compact(
        F.array(
            step(lapse_from, "lapsed", 1, goes_quiet),
            step(F.col("next_day"), "lapsed", -1, goes_quiet),
            step(F.col("scan_day"), "nursery", 1, young),
            step(nursery_to, "nursery", -1, young),
        )
    )
    stocks = running_totals(
        days.select(F.inline(steps)), "full_date", ["lapsed", "nursery"], spine.select("full_date"), "full_date"
    )
    back = (
        days.filter(F.datediff("scan_day", "prev_day") > gap)
        .groupBy(F.col("scan_day").alias("full_date"))
        .agg(F.count(F.lit(1)).alias("reactivated"))
    )
    return (
        stocks.join(back, "full_date", "left")
        .select(
            "full_date",
            "reactivated",
            F.nullif("lapsed", F.lit(0).cast("long")).alias("lapsed"),
            F.nullif("nursery", F.lit(0).cast("long")).alias("nursery"),
        )
        .filter("reactivated is not null or lapsed is not null or nursery is not null")
    )


# --- registered, not scanned -------------------------------------------------


def rns_series(
    sign_up_rows: DataFrame,
    account_rows: DataFrame,
    scan_rows: DataFrame,
    calendar_rows: DataFrame,
    scheme: Scheme = Scheme(),
) -> DataFrame:
    """Cumulative sign-ups, first uses and expired guests per day."""
    firsts = first_days(scan_rows, "wallet_id", "event_ts", "first_use")
    # accounts meet the scans first, so that sign-ups without an account carry no NULL wallet into a join
    wallets = account_rows.select("singl_profl_id", "wallet_id", "reg_dt", "acct_status_id").join(
        firsts, "wallet_id", "left"
    )
    people = sign_up_rows.select("singl_profl_id", "signup_dt").join(wallets, "singl_profl_id", "left")
    expiry = F.when(F.col("acct_status_id") == "TEMP", F.date_add("reg_dt", scheme.guest_expiry_days))
    names = ("sign_ups", "first_uses", "ct")
    marks = [
        F.struct(day.alias("full_date"), *[F.lit(int(n == name)).alias(n) for n in names])
        for name, day in zip(names, (F.col("signup_dt"), F.col("first_use"), expiry))
    ]
    steps = people.select(F.inline(F.array(*marks))).filter("full_date is not null")
    return (
        running_totals(steps, "full_date", names, calendar_rows, "full_date")
        .filter("sign_ups > 0 and first_uses > 0")
        .withColumn("ct", F.nullif("ct", F.lit(0).cast("long")))
    )


def rns_excl_expired(
    account_rows: DataFrame, scan_rows: DataFrame, calendar_days: DataFrame, as_of: date, scheme: Scheme = Scheme()
) -> DataFrame:
    """Wallets registered, not yet scanned and not expired, per day."""
    spine = calendar_days.filter(F.col("day_date").between(F.lit(scheme.series_start), F.lit(as_of))).select(
        F.col("day_date").alias("full_date")
    )
    firsts = first_days(scan_rows, "wallet_id", "event_ts", "first_scan")
    opens = F.date_add("reg_dt", 1)
    scanned_after = F.date_add("first_scan", 1)
    expired_after = F.when(F.col("acct_del_ind_1") == 1, F.date_add("reg_dt", scheme.guest_expiry_days + 1))
    closes = F.coalesce(F.least(scanned_after, expired_after), F.lit(date(9999, 1, 1)))
    waiting = (
        account_rows.select("wallet_id", "reg_dt", "acct_del_ind_1")
        .join(firsts, "wallet_id", "left")
        .select(opens.alias("opens"), closes.alias("closes"))
        .filter("closes > opens")
    )
    steps = waiting.select(
        F.inline(
            F.array(
                F.struct(F.col("opens").alias("full_date"), F.lit(1).alias("wallet_id")),
                F.struct(F.col("closes").alias("full_date"), F.lit(-1).alias("wallet_id")),
            )
        )
    )
    return running_totals(steps, "full_date", ["wallet_id"], spine, "full_date")


# --- one-row measures and expiring balances ----------------------------------


def measures_row(
    sign_up_rows: DataFrame,
    account_rows: DataFrame,
    scan_rows: DataFrame,
    vouchers: DataFrame,
    last_week: DataFrame,
) -> DataFrame:
    """Headline measures as one row; the thresholds are scalar subqueries."""
    week_end = last_week.select("end_date").scalar()
    newest = sign_up_rows.agg(F.max("signup_dt").alias("d")).scalar()
    first_ts = scan_rows.groupBy("wallet_id").agg(F.min("event_ts").alias("first_ts"))
    scanned_profiles = (
        account_rows.select("singl_profl_id", "wallet_id").join(first_ts, "wallet_id", "left_semi").select("singl_profl_id")
    )
    wallets = first_ts.agg(
        F.count(F.lit(1)).alias("num_wallet_id"),
        F.count_if(F.col("first_ts") <= week_end).alias("num_wallet_id_last_wk"),
    )
    permanent = F.col("acct_status_id") == "DEFAULT"
    opt_in_rate = sign_up_rows.agg(
        ratio(
            F.count_if(permanent & (F.col("opt_in_flag") == 1)), F.count_if(permanent & (F.col("new_ind") == 1))
        ).alias("rate")
    )
    held = vouchers.filter("reward_redm_ts is not null").select(
        F.timestamp_diff("SECOND", F.col("reward_gained_ts"), F.col("reward_redm_ts")).alias("seconds")
    )
    unscanned = sign_up_rows.join(scanned_profiles, "singl_profl_id", "left_anti")
    day = F.col("signup_dt")
    waiting = unscanned.agg(
        F.count_if(day == newest).alias("register_never_scanned_24_hrs"),
        F.count_if(day.between(F.date_sub(newest, 6), newest)).alias("register_never_scanned_7_days"),
        F.count_if(day == week_end).alias("register_never_scanned_24_hrs_last_wk"),
        F.count_if(day.between(F.date_sub(week_end, 6), week_end)).alias("register_never_scanned_7_days_last_wk"),
    )
    return waiting.select(
        "register_never_scanned_24_hrs",
        "register_never_scanned_7_days",
        (exact_median(held, "seconds").scalar() / F.lit(60.0)).alias("avg_time_voucher_held_mins"),
        wallets.select("num_wallet_id").scalar().alias("num_wallet_id"),
        opt_in_rate.scalar().alias("new_spid_opt_in"),
        wallets.select("num_wallet_id_last_wk").scalar().alias("num_wallet_id_last_wk"),
        "register_never_scanned_24_hrs_last_wk",
        "register_never_scanned_7_days_last_wk",
    )


# bands of one pound in pence; the order is a letter
EXPIRING_BANDS = [
    Band("£0.00", 0, 1, "a"),
    Band("£0.01-£0.99", 1, 100, "b"),
    *[Band(f"£{p}-£{p}.99", p * 100, (p + 1) * 100, chr(ord("b") + p)) for p in range(1, 19)],
]


def expiring_balances(
    account_rows: DataFrame, as_of: date, horizons: tuple[int, ...] = (7, 14), scheme: Scheme = Scheme()
) -> DataFrame:
    """People and mean balance of guest accounts expiring within each horizon, by band."""
    balance = F.col("curr_cash_bnk_pnts_qty")
    days_left = F.datediff(F.date_add("reg_dt", scheme.guest_expiry_days), F.lit(as_of))
    expires = F.timestamp_add("DAY", F.lit(scheme.guest_expiry_days), F.col("regtn_ts"))
    inside = [
        F.when(expires.between(F.lit(as_of), F.lit(as_of + timedelta(days=h))), F.lit(str(h))) for h in horizons
    ]
    return (
        account_rows.filter(F.col("singl_profl_id").startswith("no") & (days_left >= -1))
        .select(
            "singl_profl_id",
            balance.alias("pence"),
            band_label(balance, EXPIRING_BANDS).alias("cshbnk_category"),
            band_order(balance, EXPIRING_BANDS).alias("cshbnk_category_order"),
            F.explode(F.array_compact(F.array(*inside))).alias("expiry_category"),
        )
        .groupBy("cshbnk_category", "cshbnk_category_order", "expiry_category")
        .agg(
            F.countDistinct("singl_profl_id").alias("num_people"),
            (F.avg("pence") / 100.0).alias("average"),
        )
    )


# --- account funnel grid -----------------------------------------------------


def _funnel_metrics(as_of: date, scheme: Scheme) -> list[tuple[str, Mapping[str, Column | None]]]:
    """The thirteen metrics as row conditions, built from three reference points.

    Each point is ``as_of`` moved back by 0, 1 or 7 days together with the last
    scan before it and the grace it gives to accounts that have expired since.
    """
    reg, first = F.col("reg_dt"), F.col("first_scan")
    guest, perm = F.col("acct_status_id") == "TEMP", F.col("acct_status_id") == "DEFAULT"
    opted = (F.col("email_opt_in") == 1) | (F.col("push_opt_in") == 1)
    live = F.col("acct_del_ind_1") == 0
    points = {"Total": 0, "Total_yday": 1, "Total_last_wk": 7}
    last_scan = {0: F.col("last_scan_0"), 1: F.col("last_scan_1"), 7: F.col("last_scan_7")}

    def at(shift: int) -> Column:
        return F.lit(as_of - timedelta(days=shift))

    def alive(shift: int) -> Column:
        if shift == 0:
            return live
        return live | (reg >= at(scheme.guest_expiry_days + shift))

    def registered(s: int) -> Column:
        return reg < at(s)

    def current(s: int) -> Column:
        return registered(s) & alive(s)

    def expired(s: int) -> Column:
        return (reg < (at(0) if s == 0 else at(scheme.guest_expiry_days + s))) & ~live

    def scanned(s: int) -> Column:
        return last_scan[s] < at(s)

    def active(length: int):
        return lambda s: (last_scan[s] >= at(length + s)) & (last_scan[s] < at(s))

    def scanned_alive(s: int) -> Column:
        return scanned(s) & alive(s) & (registered(0) if s == 0 else F.lit(True))

    def lapsed(s: int) -> Column:
        return alive(s) & (last_scan[s] < at(scheme.active_days + s))

    def not_scanned(s: int) -> Column:
        return alive(s) & registered(s) & ((first >= at(s)) | first.isNull())

    def split(rule, guests=True, perms=True, only: Column | None = None) -> dict[str, Column | None]:
        cells = {name: rule(s) if only is None else rule(s) & only for name, s in points.items()}
        base = rule(0)
        return {
            "Total": cells["Total"],
            "Guests": base & guest if guests else None,
            "Perms": base & perm if perms else None,
            "Perms_opted_in": base & perm & opted if perms else None,
            "Total_yday": cells["Total_yday"],
            "Total_last_wk": cells["Total_last_wk"],
        }

    # fixed values: metric names in report order
    return [
        ("registered", split(registered)),
        ("current accounts", split(current)),
        ("expired accounts", split(expired, perms=False)),
        ("current perms", split(current, guests=False, only=perm)),
        ("current guests", split(current, perms=False, only=guest)),
        ("distinct_wallet_scans", split(scanned)),
        ("non expired wallet scans", split(scanned_alive)),
        ("wallets, active in last 13 weeks", split(active(scheme.active_days))),
        ("wallets, lapsed", split(lapsed)),
        ("wallets, active in last 30 days", split(active(30))),
        ("wallets, active in last 7 days", split(active(7))),
        ("wallets, active in last 1 days", split(active(1))),
        ("RNS - excluding expired guests", split(not_scanned)),
    ]


def activity_funnel(
    scans: DataFrame, accounts: DataFrame, consents: DataFrame, as_of: date, scheme: Scheme = Scheme()
) -> DataFrame:
    """Thirteen account metrics by six columns, from one pass over the accounts.

    Scans are first reduced to four days per wallet, so the join with the
    accounts carries one row per wallet whatever the number of scans.
    """
    day = F.to_date("event_ts")

    def before(shift: int) -> Column:
        return F.max(F.when(day < F.lit(as_of - timedelta(days=shift)), day)).alias(f"last_scan_{shift}")

    per_wallet = (
        scans.filter(on_days("event_ts", scheme.launch, as_of))
        .groupBy("wallet_id")
        .agg(F.min(day).alias("first_scan"), before(0), before(1), before(7))
    )
    expired = (F.to_date("regtn_ts") < F.lit(as_of - timedelta(days=scheme.guest_expiry_days))) & (
        F.col("acct_status_id") == "TEMP"
    )
    base = (
        accounts.filter(on_days("regtn_ts", scheme.launch, as_of))
        .select(
            "wallet_id",
            profile_or_wallet().alias("singl_profl_id"),
            F.to_date("regtn_ts").alias("reg_dt"),
            "acct_status_id",
            "regtn_ts",
            F.when(expired, 1).otherwise(0).alias("acct_del_ind_1"),
        )
        .distinct()
        .join(per_wallet, "wallet_id", "left")
        .join(
            consents.select(
                "singl_profl_id",
                F.when(F.col("mktg_consent_email") == "Y", 1).otherwise(0).alias("email_opt_in"),
                F.when(F.col("push_notif_consent") == "Y", 1).otherwise(0).alias("push_opt_in"),
            ),
            "singl_profl_id",
            "left",
        )
    )
    return metric_grid(base, _funnel_metrics(as_of, scheme))


def saturday_after_last_friday(today: date) -> date:
    """Report day of the weekly funnel: the day after the most recent complete Friday."""
    since_friday = (today.weekday() - 4) % 7 or 7
    return today - timedelta(days=since_friday) + timedelta(days=1)
