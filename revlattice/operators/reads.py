"""Read queries behind the account and revenue pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlattice.functions.dates import AsOf, as_day, days_before, days_between
from revlattice.functions.skew import attach_unique
from revlattice.functions.values import sum_usd
from revlattice.operators.usage import usage_chart_30d

# What the account page shows, by section.
DETAIL_SECTIONS = {
    "header": ["company_name", "health_status", "plan_name", "current_mrr_usd", "account_segment"],
    "contact": ["contact_name", "contact_email"],
    "limits": ["seat_limit", "seat_usage_pct", "monthly_credits", "credit_usage_pct"],
    "sales": ["is_pql", "pql_signal_count"],
    "usage": ["credits_used_14d", "active_users_14d", "sessions_14d", "last_active_date", "days_since_last_active"],
    "revenue": ["monthly_amount_usd", "annual_run_rate_usd", "lifetime_revenue_usd", "invoices_paid", "tenure_days"],
    "company": ["company_domain", "total_employees", "customer_id", "billing_match_type"],
}


def kpi_cards(overview: DataFrame) -> DataFrame:
    """MRR, ARR, active paying accounts, leads and accounts at risk."""
    paying = F.col("is_active") & (F.col("monthly_amount_usd") > 0)
    return overview.agg(
        F.coalesce(sum_usd(F.col("current_mrr_usd")), F.lit(0.0)).alias("mrr_usd"),
        F.coalesce(sum_usd(F.col("annual_run_rate_usd")), F.lit(0.0)).alias("arr_usd"),
        F.count_if(paying).alias("active_paying_accounts"),
        F.count_if("is_pql").alias("pqls"),
        F.count_if(F.col("account_segment") == "at risk").alias("accounts_at_risk"),
    )


def _rolled_up(overview: DataFrame, by: str) -> DataFrame:
    return overview.groupBy(by).agg(
        F.count("*").alias("accounts"), sum_usd(F.col("current_mrr_usd")).alias("current_mrr_usd")
    )


def segment_summary(overview: DataFrame) -> DataFrame:
    return _rolled_up(overview, "account_segment")


def plan_summary(overview: DataFrame) -> DataFrame:
    return _rolled_up(overview, "plan_name")


def account_filter(
    overview: DataFrame,
    as_of: AsOf = None,
    search: str | None = None,
    segment: str | None = None,
    health: str | None = None,
    plan: str | None = None,
    pql_only: bool = False,
    active_within_days: int | None = None,
) -> DataFrame:
    """The account table with any of its filters; days since last use are worked out at read time."""
    found = overview
    if search is not None:
        # `contains` keeps % and _ literal.
        text = F.lit(search.lower())
        hit = F.lower("company_name").contains(text) | F.lower("company_domain").contains(text)
        found = found.where(hit)
    for column, wanted in (("account_segment", segment), ("health_status", health), ("plan_name", plan)):
        if wanted is not None:
            found = found.where(F.col(column) == wanted)
    if pql_only:
        found = found.where("is_pql")
    if active_within_days is not None:
        found = found.where(F.col("last_active_date") >= days_before(as_of, active_within_days))
    return found.select(
        "hubspot_company_id",
        "company_name",
        "company_domain",
        "plan_name",
        "health_status",
        "account_segment",
        "is_pql",
        "current_mrr_usd",
        "credit_usage_pct",
        "contact_email",
        "last_active_date",
        days_between(as_day(as_of), F.col("last_active_date")).alias("days_since_last_active"),
    )


def account_detail(
    overview: DataFrame,
    daily_usage: DataFrame,
    as_of: AsOf = None,
    account_id: str | None = None,
    days: int = 30,
) -> DataFrame:
    """The account page: a struct per section, and the daily series as an array of at most `days`.

    With `account_id` only that account is read, of both inputs; the filter reaches their scans.
    An account with several overview rows has a row for each.

    The series are many times as large as the columns that they come from, which Spark's estimate
    does not see. They are merged, as a broadcast would take all of them through the driver.
    """
    found, used = overview, daily_usage
    if account_id is not None:
        found, used = (df.where(F.col("hubspot_company_id") == account_id) for df in (found, used))
    day = F.struct("usage_date", "credits", "prompt_runs", "sessions", "is_partial")
    series = (
        usage_chart_30d(used, found, as_of, days, mark_partial=True)
        .groupBy("hubspot_company_id")
        .agg(F.array_sort(F.collect_list(day)).alias("daily"))
    )
    sections = [F.struct(*columns).alias(name) for name, columns in DETAIL_SECTIONS.items()]
    pages, key = found.select("hubspot_company_id", *sections), "hubspot_company_id"
    return attach_unique(pages, key, series.hint("merge"), key)
