"""Business constants of a loyalty scheme, as one immutable parameter object."""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import date


@dataclass(frozen=True)
class Scheme:
    """Dates, lags and campaign ids a report depends on.

    The defaults are fixed values of the scheme the reports were first written
    for; pass your own for another scheme.
    """

    # fixed values: dates
    launch: date = date(2021, 9, 5)
    series_start: date = date(2022, 8, 1)
    trading_start: date = date(2022, 6, 1)
    scanners_start: date = date(2022, 11, 1)
    campaign_end_floor: date = date(2021, 10, 21)
    coupon_start: date = date(2023, 10, 1)
    item_obsolete_floor: date = date(2022, 6, 1)
    coupon_item_obsolete_floor: date = date(2022, 8, 1)
    star_value_change: date = date(2022, 5, 19)
    status_launch: date = date(2023, 5, 3)
    reference_prefix_change: date = date(2023, 6, 1)
    evergreen_end_floor: date = date(2031, 12, 31)
    # fixed values: lags in days
    guest_expiry_days: int = 37
    active_days: int = 91
    lapse_gap_days: int = 92
    # fixed values: ids and names
    status_campaign: int = 508017
    club_campaign: int = 533567
    earners_excluded_campaign: int = 522467
    saver_scheme: int = 531227
    deleted_item: int = 4681141
    excluded_star_campaigns: tuple[int, ...] = (492819, 503151, 505773)
    excluded_coupon_campaigns: tuple[int, ...] = (522461, 524842, 524843)
    food_to_go_campaign: int = 494401
    evergreen_voucher_name: str = "Rewards Voucher"
    excluded_voucher_wallets: tuple[int, ...] = ()
    card_channel_prefix: str = "Card"
    card_channel: str = "Card"
    status_label: str = "Status Group"
    club_label: str = "Baby Club"

    @property
    def always_on_campaigns(self) -> tuple[int, ...]:
        return (self.status_campaign, self.club_campaign)

    def with_(self, **changes: object) -> "Scheme":
        return replace(self, **changes)
