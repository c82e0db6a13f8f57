"""Query registry and the derived inputs that several queries share."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from rolebook.oracle import oracle
from rolebook.roles import AS_OF, SCHEME, Roles
from stampbook.plans import bases, campaigns, trading

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Bound(Roles):
    """Roles plus the conformed bases built from them, each built once per query."""

    @cached_property
    def account_rows(self) -> DataFrame:
        return bases.account_base(self.accounts, self.scans, AS_OF, SCHEME)

    @cached_property
    def sign_up_rows(self) -> DataFrame:
        return bases.sign_ups(self.accounts, self.consents, self.profiles, AS_OF, SCHEME)

    @cached_property
    def scan_rows(self) -> DataFrame:
        return bases.scan_base(self.scans, AS_OF, SCHEME)

    @cached_property
    def calendar_rows(self) -> DataFrame:
        return bases.calendar(self.calendar, AS_OF, SCHEME)

    @cached_property
    def last_week(self) -> DataFrame:
        return bases.last_complete_week(self.calendar, AS_OF, SCHEME)

    @cached_property
    def setup(self) -> DataFrame:
        return campaigns.campaign_setup(self.campaign_versions, AS_OF, SCHEME)

    @cached_property
    def voucher_rows(self) -> DataFrame:
        return campaigns.vouchers(self.reward_wallets, self.scans, self.setup, self.account_rows, AS_OF, SCHEME)

    @cached_property
    def completions(self) -> DataFrame:
        return campaigns.mission_completions(
            self.missions, self.scans, self.setup, self.calendar, self.last_week, self.account_rows, AS_OF, SCHEME
        )

    @cached_property
    def voucher_totals(self) -> DataFrame:
        return campaigns.vouchers(
            self.reward_wallets, self.scans, campaigns.summed_setup(self.setup), self.account_rows, AS_OF, SCHEME
        )

    @cached_property
    def completion_totals(self) -> DataFrame:
        return campaigns.mission_completions(
            self.missions,
            self.scans,
            self.setup,
            self.calendar,
            self.last_week,
            self.account_rows,
            AS_OF,
            SCHEME,
            per_value=False,
        )

    @cached_property
    def star_products(self) -> DataFrame:
        return trading.star_product_list(self.campaign_products, self.items, self.setup, SCHEME)

    @cached_property
    def coupon_sides(self) -> campaigns.CouponSides:
        return campaigns.coupon_sides(
            self.campaign_versions, self.campaign_products, self.items, self.coupon_types, SCHEME
        )

    @cached_property
    def coupon_details(self) -> DataFrame:
        return campaigns.coupon_details(
            self.campaign_versions, self.campaign_products, self.items, self.coupon_types, SCHEME
        )


def query(name: str, sql: str | None = None):
    """Register ``build(roles) -> DataFrame`` under ``name`` with its reference SQL."""

    def decorate(build: Callable[[Bound], DataFrame]):
        QUERIES[name] = lambda spark, folder: build(Bound(spark, folder))
        if sql is not None:
            ORACLES[name] = oracle(sql)
        return build

    return decorate
