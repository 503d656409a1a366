"""How the models build on each other, from raw inputs to the marts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame

from revlattice.functions.dates import AsOf
from revlattice.operators import staging
from revlattice.operators.health import account_health
from revlattice.operators.identity import account_identity
from revlattice.operators.overview import account_overview
from revlattice.operators.pql import product_qualified_leads
from revlattice.operators.subscription import account_subscription
from revlattice.operators.usage import attribute_usage, domain_daily_usage
from revlattice.session import store

Raw = dict[str, Callable[[], DataFrame]]


class Models:
    """Every model, made when first asked for.

    `raw` gives the inputs by name: the six object tables, `usage_events` and `plans`, and
    `domain_usage` where daily facts per domain are already kept up to date.
    Models named in `written` are computed once, stored in the shared folder and read back
    by all that build on them: right for what is read several times. The others stay part
    of the plan of whoever asks.
    """

    def __init__(
        self,
        raw: Raw,
        as_of: AsOf,
        refreshed_at: dt.datetime | str | None = None,
        written: tuple[str, ...] = (),
        write: Callable[[str, DataFrame], DataFrame] | None = None,
    ) -> None:
        self.raw, self.as_of, self.refreshed_at, self.written = raw, as_of, refreshed_at, written
        self.write = write or (lambda name, df: store(df, name))

    def _keep(self, name: str, df: DataFrame) -> DataFrame:
        return self.write(name, df) if name in self.written else df

    # staging

    @cached_property
    def companies(self) -> DataFrame:
        return self._keep("companies", staging.stg_companies(self.raw["companies"]()))

    @cached_property
    def contacts(self) -> DataFrame:
        return self._keep("contacts", staging.stg_contacts(self.raw["contacts"]()))

    @cached_property
    def deals(self) -> DataFrame:
        return self._keep("deals", staging.stg_deals(self.raw["deals"]()))

    @cached_property
    def customers(self) -> DataFrame:
        return self._keep("customers", staging.stg_customers(self.raw["customers"]()))

    @cached_property
    def subscriptions(self) -> DataFrame:
        return self._keep("subscriptions", staging.stg_subscriptions(self.raw["subscriptions"]()))

    @cached_property
    def invoices(self) -> DataFrame:
        return self._keep("invoices", staging.stg_invoices(self.raw["invoices"]()))

    @cached_property
    def usage_events(self) -> DataFrame:
        return self._keep("usage_events", staging.stg_usage_events(self.raw["usage_events"]()))

    @cached_property
    def plans(self) -> DataFrame:
        return self.raw["plans"]()

    # intermediate

    @cached_property
    def identity(self) -> DataFrame:
        return self._keep("identity", account_identity(self.companies, self.customers))

    @cached_property
    def daily_usage(self) -> DataFrame:
        kept = self.raw.get("domain_usage")
        facts = kept() if kept else domain_daily_usage(self.usage_events)
        return self._keep("daily_usage", attribute_usage(facts, self.identity))

    @cached_property
    def account_subscriptions(self) -> DataFrame:
        found = account_subscription(self.identity, self.subscriptions, self.plans)
        return self._keep("account_subscriptions", found)

    # marts

    @cached_property
    def health(self) -> DataFrame:
        scored = account_health(self.account_subscriptions, self.daily_usage, self.as_of)
        return self._keep("health", scored)

    @cached_property
    def leads(self) -> DataFrame:
        found = product_qualified_leads(
            self.identity, self.account_subscriptions, self.daily_usage, self.as_of
        )
        return self._keep("leads", found)

    @cached_property
    def overview(self) -> DataFrame:
        wide = account_overview(
            self.identity,
            self.account_subscriptions,
            self.daily_usage,
            self.health,
            self.leads,
            self.invoices,
            self.contacts,
            self.as_of,
            self.refreshed_at,
        )
        return self._keep("overview", wide)
