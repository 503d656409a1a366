"""Product-qualified leads: accounts whose use says they are ready to buy more."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlattice.functions.dates import AsOf
from revlattice.functions.skew import attach_unique
from revlattice.functions.values import percent
from revlattice.operators.usage import recent_usage_14d

# The lead rules.
MIN_EMPLOYEES = 50
PLANS_TO_GROW = ("free", "pro", "team")
MIN_USERS, MIN_CREDIT_SHARE, MIN_INVITES, MIN_SIGNALS = 3, 0.8, 1, 2


def pql_signals(
    identity: DataFrame,
    account_subscriptions: DataFrame,
    daily_usage: DataFrame,
    as_of: AsOf = None,
) -> DataFrame:
    """Every candidate with its three 0/1 signals, their count and the credit share."""
    large = identity.where(F.col("total_employees") >= MIN_EMPLOYEES).select(
        "hubspot_company_id", "company_name", "company_domain", "total_employees", "customer_id"
    )
    growable = account_subscriptions.where(
        F.col("plan_name").isin(*PLANS_TO_GROW) & F.col("is_active")
    ).select(
        F.col("hubspot_company_id").alias("account"),
        F.col("customer_id").alias("payer"),
        "plan_name",
        "monthly_credits",
        "monthly_amount_usd",
    )
    # Both sides have a row per customer of the company: on the company alone they would pair
    # every customer with every other.
    own = (F.col("hubspot_company_id") == F.col("account")) & F.col("customer_id").eqNullSafe(F.col("payer"))
    candidates = large.join(growable, own).drop("account", "customer_id", "payer")
    used = attach_unique(
        candidates,
        "hubspot_company_id",
        recent_usage_14d(daily_usage, as_of),
        "hubspot_company_id",
    )

    def flag(condition):
        return F.when(condition, F.lit(1)).otherwise(F.lit(0)).cast("bigint")

    users = F.coalesce("peak_active_users", F.lit(0))
    invites = F.coalesce("teammates_invited", F.lit(0))
    share = F.coalesce(F.try_divide("credits_used", "monthly_credits"), F.lit(0.0))
    return (
        used.select(
            "hubspot_company_id",
            "company_name",
            "company_domain",
            "total_employees",
            "plan_name",
            "monthly_credits",
            "monthly_amount_usd",
            F.coalesce("credits_used", F.lit(0)).alias("credits_used_14d"),
            users.alias("active_users"),
            invites.alias("teammates_invited_14d"),
            "last_active_date",
            flag(users >= MIN_USERS).alias("signal_active_users"),
            flag(share >= MIN_CREDIT_SHARE).alias("signal_credit_usage"),
            flag(invites >= MIN_INVITES).alias("signal_invite"),
        )
        .withColumn(
            "signal_count",
            F.col("signal_active_users") + F.col("signal_credit_usage") + F.col("signal_invite"),
        )
        .withColumn("credit_usage_pct", percent(F.col("credits_used_14d"), F.col("monthly_credits")))
    )


def product_qualified_leads(
    identity: DataFrame,
    account_subscriptions: DataFrame,
    daily_usage: DataFrame,
    as_of: AsOf = None,
) -> DataFrame:
    """Candidates with at least two signals."""
    signals = pql_signals(identity, account_subscriptions, daily_usage, as_of)
    return signals.where(F.col("signal_count") >= MIN_SIGNALS)


def ranked_leads(leads: DataFrame) -> DataFrame:
    """Read order: strongest signal first. Sorting is for readers, not for the stored table."""
    return leads.orderBy(F.desc("signal_count"), F.desc("credits_used_14d"))
