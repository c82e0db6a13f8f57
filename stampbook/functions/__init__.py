from stampbook.functions.bands import Band, band_label, band_order, bands_from_edges
from stampbook.functions.dates import day_window, month_key, on_days, retail_calendar
from stampbook.functions.values import (
    first_match,
    is_numeric_store,
    minor_to_major,
    profile_or_wallet,
    ratio,
    strip_check_digit,
)

__all__ = [
    "Band",
    "band_label",
    "band_order",
    "bands_from_edges",
    "day_window",
    "first_match",
    "is_numeric_store",
    "minor_to_major",
    "month_key",
    "on_days",
    "profile_or_wallet",
    "ratio",
    "retail_calendar",
    "strip_check_digit",
]
