"""Health of paying accounts: red, yellow or green, by plain rules on credit use."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlattice.functions.dates import AsOf, days_before
from revlattice.functions.skew import attach_unique
from revlattice.functions.values import sum_usd
from revlattice.operators.usage import usage_two_windows

# Share of the previous window below which an account is red or yellow.
RED_BELOW, YELLOW_BELOW = 0.5, 0.75
# Fixed value: share of the monthly allowance below which a plan counts as hardly used.
LOW_USAGE = 0.15


def _paying_with_usage(account_subscriptions: DataFrame, windows: DataFrame) -> DataFrame:
    paying = account_subscriptions.where(F.col("is_active") & (F.col("plan_name") != "free")).select(
        "hubspot_company_id",
        "company_name",
        "plan_name",
        "monthly_amount_usd",
        "subscription_status",
        "is_active",
    )
    joined = attach_unique(paying, "hubspot_company_id", windows, "hubspot_company_id")
    return joined.fillna(0, ["credits_recent", "credits_previous"])


def health_status() -> Column:
    recent, previous = F.col("credits_recent"), F.col("credits_previous")
    return (
        F.when((recent == 0) | (recent < previous * RED_BELOW), "red")
        .when(recent < previous * YELLOW_BELOW, "yellow")
        .otherwise("green")
    )


def account_health(
    account_subscriptions: DataFrame, daily_usage: DataFrame, as_of: AsOf = None
) -> DataFrame:
    """One scored row per paying subscription; accounts that never used anything are red."""
    windows = usage_two_windows(daily_usage, as_of)
    scored = _paying_with_usage(account_subscriptions, windows)
    return scored.withColumn("health_status", health_status())


def health_reason(health: DataFrame) -> DataFrame:
    """Why an account has its status: silent, or dropped by how much."""
    recent, previous = F.col("credits_recent"), F.col("credits_previous")
    reason = (
        F.when(recent == 0, "silent")
        .when(recent < previous * RED_BELOW, "dropped by more than half")
        .when(recent < previous * YELLOW_BELOW, "dropped by more than a quarter")
        .otherwise("steady")
    )
    return health.withColumn("health_reason", reason)


def equal_health_windows(
    account_subscriptions: DataFrame, daily_usage: DataFrame, as_of: AsOf = None
) -> DataFrame:
    """Extension: health over two windows of exactly 14 days, the later one ending at `as_of`."""
    day = F.col("usage_date")
    recent = (day > days_before(as_of, 14)) & (day <= days_before(as_of, 0))
    previous = (day > days_before(as_of, 28)) & (day <= days_before(as_of, 14))
    credits = F.col("total_credits_used")
    windows = (
        daily_usage.where(recent | previous)
        .groupBy("hubspot_company_id")
        .agg(
            F.sum(F.when(recent, credits).otherwise(0)).alias("credits_recent"),
            F.sum(F.when(previous, credits).otherwise(0)).alias("credits_previous"),
        )
    )
    scored = _paying_with_usage(account_subscriptions, windows)
    return scored.withColumn("health_status", health_status())


def health_low_usage_rule(overview: DataFrame, threshold: float = LOW_USAGE) -> DataFrame:
    """Extension: paying accounts that were always quiet, which a drop rule cannot see."""
    share = F.try_divide("credits_used_30d", "monthly_credits")
    return overview.where(F.col("health_status") != "not_scored").select(
        "hubspot_company_id",
        "plan_name",
        "health_status",
        "credits_used_30d",
        "monthly_credits",
        (F.coalesce(share, F.lit(0.0)) < threshold).alias("low_usage"),
        F.when(
            (F.col("health_status") == "green") & (F.coalesce(share, F.lit(0.0)) < threshold), "yellow"
        )
        .otherwise(F.col("health_status"))
        .alias("health_with_low_usage"),
    )


def short_history_flag(overview: DataFrame, days: int = 28) -> DataFrame:
    """Extension: scored accounts too young to fill both windows."""
    return overview.where(F.col("health_status") != "not_scored").select(
        "hubspot_company_id",
        "health_status",
        "tenure_days",
        F.coalesce(F.col("tenure_days") < days, F.lit(False)).alias("short_history"),
    )


def failed_payment_signal(
    account_subscriptions: DataFrame, invoices: DataFrame, unpaid: tuple = ("open", "uncollectible")
) -> DataFrame:
    """Extension: paying accounts with invoices that were due and not paid.

    Invoices are reduced to one row per customer before the join.
    """
    owed = (
        invoices.where(F.col("payment_status").isin(*unpaid) & (F.col("amount_due_usd") > 0))
        .groupBy("customer_id")
        .agg(F.count("*").alias("unpaid_invoices"), sum_usd(F.col("amount_due_usd")).alias("unpaid_usd"))
    )
    paying = account_subscriptions.where(F.col("is_active") & (F.col("plan_name") != "free")).select(
        "hubspot_company_id", "customer_id", "plan_name"
    )
    return attach_unique(paying, "customer_id", owed, "customer_id").select(
        "hubspot_company_id",
        "plan_name",
        F.coalesce("unpaid_invoices", F.lit(0)).alias("unpaid_invoices"),
        F.coalesce("unpaid_usd", F.lit(0.0)).alias("unpaid_usd"),
        F.col("unpaid_invoices").isNotNull().alias("has_failed_payment"),
    )
