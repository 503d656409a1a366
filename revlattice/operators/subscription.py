"""Accounts with their subscription and plan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlattice.functions.skew import keep_unmatched

# Columns of a subscription.
SUBSCRIPTION = [
    "subscription_id",
    "price_id",
    "monthly_amount_usd",
    "subscription_status",
    "created_at",
    "canceled_at",
]


def account_subscription(
    identity: DataFrame, subscriptions: DataFrame, plans: DataFrame
) -> DataFrame:
    """Every account with its subscriptions; accounts without one keep a row of NULLs.

    Written as inner join plus the accounts left over, so that a customer with very many
    subscriptions can be split. `is_active` is NULL without a subscription.
    """
    accounts = identity.select("hubspot_company_id", "customer_id", "company_name")
    held = subscriptions.select(F.col("customer_id").alias("payer"), *SUBSCRIPTION)
    billed = accounts.join(held, F.col("customer_id") == F.col("payer")).drop("payer")
    unbilled = keep_unmatched(accounts, "customer_id", held, "payer")
    everyone = billed.unionByName(unbilled, allowMissingColumns=True)
    limits = plans.select(
        F.col("price_id").alias("plan_price"), "plan_name", "plan_rank", "seat_limit", "monthly_credits"
    )
    return everyone.join(limits, F.col("price_id") == F.col("plan_price"), "left").select(
        "hubspot_company_id",
        "customer_id",
        "company_name",
        "subscription_id",
        "plan_name",
        "plan_rank",
        "seat_limit",
        "monthly_credits",
        "monthly_amount_usd",
        "subscription_status",
        "created_at",
        "canceled_at",
        (F.col("subscription_status") == "active").alias("is_active"),
    )


def plan_summary_of_prices(subscriptions: DataFrame, plans: DataFrame) -> DataFrame:
    """The price list with the number of subscriptions on each price."""
    on_price = subscriptions.groupBy(F.col("price_id").alias("on_price")).agg(
        F.count("*").alias("subscriptions")
    )
    return plans.join(on_price, F.col("price_id") == F.col("on_price"), "left").select(
        *plans.columns, F.coalesce("subscriptions", F.lit(0)).alias("subscriptions")
    )
