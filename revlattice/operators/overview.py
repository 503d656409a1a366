"""The wide account overview and its parts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlattice.functions.dates import AsOf, as_day, days_between
from revlattice.functions.skew import attach_unique
from revlattice.functions.values import percent, sum_usd
from revlattice.operators.usage import usage_windows


def lifetime_revenue(invoices: DataFrame) -> DataFrame:
    """Cash collected per customer; unpaid and zero invoices do not count."""
    return (
        invoices.where((F.col("payment_status") == "paid") & (F.col("amount_paid_usd") > 0))
        .groupBy("customer_id")
        .agg(
            sum_usd(F.col("amount_paid_usd")).alias("lifetime_revenue_usd"),
            F.count("*").alias("invoices_paid"),
        )
    )


def primary_contact(contacts: DataFrame) -> DataFrame:
    """Earliest contact per e-mail domain, unknown dates first, ties by contact id.

    A minimum rather than a ranking: a shared mail domain is reduced before the shuffle.
    """
    order = F.struct(F.col("created_at").isNotNull(), "created_at", "contact_id")
    who = F.struct("email", F.concat("first_name", F.lit(" "), "last_name").alias("contact_name"))
    return (
        contacts.groupBy("email_domain")
        .agg(F.min_by(who, order).alias("who"))
        .select("who.email", "email_domain", "who.contact_name")
    )


def account_limits_usage(accounts: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Adds share of credits and seats used, tenure and days since last use."""
    today = as_day(as_of)
    return accounts.withColumns(
        {
            "tenure_days": days_between(today, F.to_date("subscription_started_at")),
            "days_since_last_active": days_between(today, F.col("last_active_date")),
            "credit_usage_pct": percent(F.col("credits_used_30d"), F.col("monthly_credits")),
            "seat_usage_pct": percent(F.col("active_users_14d"), F.col("seat_limit")),
        }
    )


def segment() -> Column:
    """What to do about an account; the first rule that holds decides."""
    free = F.col("plan_name") == "free"
    return (
        F.when(~F.coalesce("is_active", F.lit(False)), "churned")
        .when(F.col("is_pql"), "sales opportunity")
        .when(F.col("health_status") == "red", "at risk")
        .when(F.col("health_status") == "yellow", "watch")
        .when(free & (F.col("credits_used_14d") == 0), "dormant free")
        .when(free, "active free")
        .otherwise("healthy paying")
    )


def account_segment(accounts: DataFrame) -> DataFrame:
    return accounts.withColumn("account_segment", segment())


# Columns of the overview.
OVERVIEW_COLUMNS = [
    "hubspot_company_id",
    "company_name",
    "company_domain",
    "total_employees",
    "billing_match_type",
    "customer_id",
    "subscription_id",
    "plan_name",
    "plan_rank",
    "monthly_amount_usd",
    "current_mrr_usd",
    "annual_run_rate_usd",
    "subscription_status",
    "is_active",
    "subscription_started_at",
    "canceled_at",
    "seat_limit",
    "monthly_credits",
    "tenure_days",
    "credits_used_14d",
    "credits_previous_14d",
    "prompt_runs_14d",
    "sessions_14d",
    "teammates_invited_14d",
    "active_users_14d",
    "credits_used_all_time",
    "last_active_date",
    "days_since_last_active",
    "credits_used_30d",
    "credit_usage_pct",
    "seat_usage_pct",
    "lifetime_revenue_usd",
    "invoices_paid",
    "health_status",
    "is_pql",
    "pql_signal_count",
    "contact_email",
    "contact_name",
    "account_segment",
    "refreshed_at",
]


WORST_FIRST = ["red", "yellow", "green"]


def _accounts_with_subscription(identity: DataFrame, account_subscriptions: DataFrame) -> DataFrame:
    who = identity.select(
        "hubspot_company_id",
        "company_name",
        "company_domain",
        "total_employees",
        F.col("match_type").alias("billing_match_type"),
        F.col("customer_id").alias("payer"),
    )
    held = account_subscriptions.select(
        F.col("hubspot_company_id").alias("account"),
        "customer_id",
        "subscription_id",
        "plan_name",
        "plan_rank",
        "monthly_amount_usd",
        "subscription_status",
        "is_active",
        F.col("created_at").alias("subscription_started_at"),
        "canceled_at",
        "seat_limit",
        "monthly_credits",
    )
    # Every account id also occurs in `held` with the same customer, so only accounts without an
    # id can stay unmatched; an inner join can be split on both sides. Both sides have a row per
    # customer, hence the second key.
    return (
        who.join(
            held,
            (F.col("hubspot_company_id") == F.col("account")) & F.col("payer").eqNullSafe(F.col("customer_id")),
        )
        .drop("account", "payer")
        .unionByName(
            who.where(F.col("hubspot_company_id").isNull()).drop("payer"), allowMissingColumns=True
        )
    )


def account_overview(
    identity: DataFrame,
    account_subscriptions: DataFrame,
    daily_usage: DataFrame,
    health: DataFrame,
    leads: DataFrame,
    invoices: DataFrame,
    contacts: DataFrame,
    as_of: AsOf = None,
    refreshed_at: dt.datetime | str | None = None,
) -> DataFrame:
    """One wide row per account, all inputs reduced to their key before they are joined."""
    # An account with several subscriptions counts as its worst one, and as its strongest lead.
    worst = F.min_by("health_status", F.array_position(F.array(*map(F.lit, WORST_FIRST)), F.col("health_status")))
    scored = health.groupBy(F.col("hubspot_company_id").alias("scored")).agg(worst.alias("health_status"))
    lead = leads.groupBy(F.col("hubspot_company_id").alias("lead")).agg(F.max("signal_count").alias("signal_count"))
    contact = primary_contact(contacts).withColumnRenamed("email", "contact_email")
    account = F.col("hubspot_company_id")

    # The account-keyed joins share one partitioning; customer and domain follow.
    wide = _accounts_with_subscription(identity, account_subscriptions)
    used = usage_windows(daily_usage, as_of)
    wide = attach_unique(wide, "hubspot_company_id", used, "hubspot_company_id")
    wide = wide.join(scored, account == F.col("scored"), "left").join(
        lead, account == F.col("lead"), "left"
    )
    wide = attach_unique(wide, "customer_id", lifetime_revenue(invoices), "customer_id")
    wide = attach_unique(wide, "company_domain", contact, "email_domain")

    zero_filled = [
        "credits_used_14d",
        "credits_previous_14d",
        "prompt_runs_14d",
        "sessions_14d",
        "teammates_invited_14d",
        "active_users_14d",
        "credits_used_all_time",
        "credits_used_30d",
        "lifetime_revenue_usd",
        "invoices_paid",
    ]
    price = F.col("monthly_amount_usd")
    filled = wide.withColumns(
        {
            **{c: F.coalesce(F.col(c), F.lit(0)) for c in zero_filled},
            "current_mrr_usd": F.when(F.col("is_active"), price).otherwise(0),
            "annual_run_rate_usd": F.when(F.col("is_active"), price * 12).otherwise(0),
            "health_status": F.coalesce("health_status", F.lit("not_scored")),
            "is_pql": F.col("lead").isNotNull(),
            "pql_signal_count": F.coalesce("signal_count", F.lit(0)),
            "refreshed_at": (
                F.current_timestamp() if refreshed_at is None else F.lit(refreshed_at).cast("timestamp")
            ),
        }
    )
    return account_segment(account_limits_usage(filled, as_of)).select(*OVERVIEW_COLUMNS)
