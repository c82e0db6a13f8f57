"""Small expression helpers shared by the reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

UNASSIGNED_PROFILE_PREFIX = "no_assgnd_spid_"


def ratio(numerator: str | Column, denominator: str | Column) -> Column:
    """Division in double precision; NULL instead of an error on a zero denominator."""
    top = F.col(numerator) if isinstance(numerator, str) else numerator
    bottom = F.col(denominator) if isinstance(denominator, str) else denominator
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def minor_to_major(minor: str | Column) -> Column:
    """Pence or points to pounds, divided once at the edge of a report."""
    column = F.col(minor) if isinstance(minor, str) else minor
    return column.cast("double") / F.lit(100.0)


def profile_or_wallet(profile: str = "singl_profl_id", wallet: str = "wallet_id") -> Column:
    return F.coalesce(F.col(profile), F.concat(F.lit(UNASSIGNED_PROFILE_PREFIX), F.col(wallet).cast("string")))


def is_numeric_store(store: str = "store_nbr") -> Column:
    """Test stores carry letters in their number."""
    return F.col(store).cast("string").rlike(r"^-?\d+$")


def strip_check_digit(code: str | Column) -> Column:
    """Barcodes of 8 or 13 digits end in a check digit that the item table leaves out."""
    column = F.col(code) if isinstance(code, str) else code
    return F.when(F.length(column).isin(8, 13), column.substr(F.lit(1), F.length(column) - 1)).otherwise(column)


def first_match(rules: Sequence[tuple[Column, object]], otherwise: object = None) -> Column:
    """Ordered classifier: the value of the first rule that holds."""
    condition, value = rules[0]
    chosen = F.when(condition, value if isinstance(value, Column) else F.lit(value))
    for condition, value in rules[1:]:
        chosen = chosen.when(condition, value if isinstance(value, Column) else F.lit(value))
    return chosen.otherwise(otherwise if isinstance(otherwise, Column) else F.lit(otherwise))
