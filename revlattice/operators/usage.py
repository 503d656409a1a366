"""Daily usage facts and the windows taken over them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlattice.functions.dates import AsOf, as_day, days_before
from revlattice.functions.skew import attach_unique

# Event type -> daily count column.
EVENT_COUNTS = {
    "session_started": "sessions",
    "prompt_run": "prompt_runs",
    "project_created": "projects_created",
    "teammate_invited": "teammates_invited",
    "project_published": "projects_published",
}


def event_counts() -> list[Column]:
    return [
        F.count_if(F.col("event_type") == kind).alias(name) for kind, name in EVENT_COUNTS.items()
    ]


def domain_daily_usage(events: DataFrame) -> DataFrame:
    """Sparse facts per product domain and event date.

    Spark shuffles first on (domain, date, user) and only then on (domain, date), so a
    domain with a large share of the events is spread over its users.
    """
    return (
        events.where(F.col("account_domain").isNotNull())
        .groupBy("account_domain", F.to_date("occurred_at").alias("usage_date"))
        .agg(
            F.sum("credits_used").alias("total_credits_used"),
            F.count_distinct("user_email").alias("active_users"),
            *event_counts(),
            F.count("*").alias("total_events"),
        )
    )


def attribute_usage(domain_usage: DataFrame, identity: DataFrame) -> DataFrame:
    """Domain facts to account-day facts; domains without a known account drop out.

    An account listed several times in `identity` counts its events as many times, as
    joining before aggregating would; distinct users do not change.
    """
    owners = (
        identity.where(F.col("company_domain").isNotNull())
        .groupBy("hubspot_company_id", "company_domain")
        .agg(F.count("*").alias("listed"))
    )
    sums = ["total_credits_used", *EVENT_COUNTS.values(), "total_events"]
    return domain_usage.join(owners, F.col("account_domain") == F.col("company_domain")).select(
        "hubspot_company_id",
        "account_domain",
        "usage_date",
        "active_users",
        *[(F.col(c) * F.col("listed")).alias(c) for c in sums],
    )


def account_daily_usage(events: DataFrame, identity: DataFrame) -> DataFrame:
    """Sparse account-day facts. Events are aggregated before they meet the accounts."""
    return attribute_usage(domain_daily_usage(events), identity)


def within(as_of: AsOf, days: int) -> Column:
    """From `days` ago on, today included, no upper bound."""
    return F.col("usage_date") >= days_before(as_of, days)


def previous_fortnight(as_of: AsOf) -> Column:
    return within(as_of, 28) & (F.col("usage_date") < days_before(as_of, 14))


def sum_where(condition: Column, measure: str) -> Column:
    return F.sum(F.when(condition, F.col(measure)).otherwise(0))


def usage_two_windows(daily_usage: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Credits of the recent and the previous window, for accounts with usage in either.

    Older days cannot contribute, so they are filtered out, down to the scan.
    """
    return (
        daily_usage.where(within(as_of, 28))
        .groupBy("hubspot_company_id")
        .agg(
            sum_where(within(as_of, 14), "total_credits_used").alias("credits_recent"),
            sum_where(previous_fortnight(as_of), "total_credits_used").alias("credits_previous"),
        )
    )


def recent_usage_14d(daily_usage: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Credits, peak daily users and invites of the last 14 days."""
    return (
        daily_usage.where(within(as_of, 14))
        .groupBy("hubspot_company_id")
        .agg(
            F.sum("total_credits_used").alias("credits_used"),
            F.max("active_users").alias("peak_active_users"),
            F.sum("teammates_invited").alias("teammates_invited"),
            F.max("usage_date").alias("last_active_date"),
        )
    )


def usage_windows(daily_usage: DataFrame, as_of: AsOf = None) -> DataFrame:
    """30-day, 14-day, previous and all-time usage per account."""
    last14 = within(as_of, 14)
    return daily_usage.groupBy("hubspot_company_id").agg(
        sum_where(within(as_of, 30), "total_credits_used").alias("credits_used_30d"),
        sum_where(last14, "total_credits_used").alias("credits_used_14d"),
        sum_where(previous_fortnight(as_of), "total_credits_used").alias("credits_previous_14d"),
        sum_where(last14, "prompt_runs").alias("prompt_runs_14d"),
        sum_where(last14, "sessions").alias("sessions_14d"),
        sum_where(last14, "teammates_invited").alias("teammates_invited_14d"),
        F.max(F.when(last14, F.col("active_users")).otherwise(0)).alias("active_users_14d"),
        F.max("usage_date").alias("last_active_date"),
        F.sum("total_credits_used").alias("credits_used_all_time"),
    )


def since(events: DataFrame, day: Column) -> DataFrame:
    """Events from a UTC day on; of the usage log only those date partitions are read."""
    dated = "occurred_date" in events.columns
    return events.where((F.col("occurred_date") if dated else F.to_date("occurred_at")) >= day)


def active_users_exact(events: DataFrame, identity: DataFrame, as_of: AsOf = None, days: int = 14) -> DataFrame:
    """Distinct users over a whole window, from the events themselves: hubspot_company_id,
    account_domain, active_users."""
    users = (
        since(events, days_before(as_of, days))
        .where(F.col("account_domain").isNotNull())
        .groupBy("account_domain")
        .agg(F.count_distinct("user_email").alias("active_users"))
    )
    owners = identity.select("hubspot_company_id", "company_domain").distinct()
    return users.join(owners, F.col("account_domain") == F.col("company_domain")).select(
        "hubspot_company_id", "account_domain", "active_users"
    )


def active_users_exact_14d(events: DataFrame, identity: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Extension: distinct users over the 14-day window."""
    return active_users_exact(events, identity, as_of).withColumnRenamed("active_users", "active_users_14d_exact")


def active_users_by_window(
    user_sets: DataFrame, identity: DataFrame, as_of: AsOf = None, days: tuple[int, ...] = (7, 14, 30)
) -> DataFrame:
    """Distinct users of windows of any length, from daily sets of users; no event is read.

    `user_sets` (account_domain, usage_date, bucket, users) are bitmaps, see `read_user_sets`. They are
    merged within their bucket, so a domain of very many users is spread over its buckets.
    A window begins as many days ago and has no end. Accounts without users in a window have no row.
    """
    users = [F.bitmap_count(F.bitmap_or_agg(F.when(within(as_of, n), F.col("users")))) for n in days]
    merged = (
        user_sets.where(within(as_of, max(days)))
        .groupBy("account_domain", "bucket")
        .agg(*[u.alias(f"w{n}") for n, u in zip(days, users, strict=True)])
        .groupBy("account_domain")
        .agg(*[F.sum(f"w{n}").alias(f"w{n}") for n in days])
    )
    counts = F.explode(F.array(*[F.struct(F.lit(n).alias("window_days"), F.col(f"w{n}").alias("active_users")) for n in days]))
    owners = identity.select("hubspot_company_id", "company_domain").distinct()
    return (
        merged.select("account_domain", counts.alias("c"))
        .where("c.active_users > 0")
        .join(owners, F.col("account_domain") == F.col("company_domain"))
        .select("hubspot_company_id", "account_domain", "c.window_days", "c.active_users")
    )


def account_usage_state(
    account_subscriptions: DataFrame, daily_usage: DataFrame, active_users: DataFrame, as_of: AsOf = None
) -> DataFrame:
    """Each account's subscriptions beside its use of 30 days and its seats (1 + invites ever).

    Credits, invites and the last day of use are one aggregate of the daily facts. `active_users`
    (hubspot_company_id, active_users) are the distinct users of the same window, from the
    events (`active_users_exact`) or the kept sets (`active_users_by_window`). An account of several domains
    has the users of the one with most. Accounts without use have zeros, one seat and no last day.
    """
    used = daily_usage.groupBy("hubspot_company_id").agg(
        F.sum(F.when(within(as_of, 30), F.col("total_credits_used"))).alias("credits"),
        F.sum("teammates_invited").alias("invites"),
        F.max("usage_date").alias("last_used_on"),
    )
    people = active_users.groupBy("hubspot_company_id").agg(F.max("active_users").alias("people"))
    accounts = account_subscriptions.select(
        "hubspot_company_id", "company_name", "subscription_id", "plan_name", "subscription_status"
    )
    key = "hubspot_company_id"
    return attach_unique(attach_unique(accounts, key, used, key), key, people, key).select(
        *accounts.columns,
        F.coalesce("credits", F.lit(0)).alias("credits_30d"),
        F.coalesce("people", F.lit(0)).alias("active_users"),
        (F.coalesce("invites", F.lit(0)) + 1).alias("seats"),
        "last_used_on",
    )


def usage_chart_30d(
    daily_usage: DataFrame, accounts: DataFrame, as_of: AsOf = None, days: int = 30, mark_partial: bool = False
) -> DataFrame:
    """Dense daily series per account: the `days` days up to and including `as_of`.

    With `mark_partial` a column `is_partial` tells the day `as_of` itself, which is not over.

    An account's days travel as one map of at most `days` entries, so accounts are
    shuffled once each and the zero days are only made afterwards. The maps are merged, never
    broadcast: Spark takes a map for one of a single entry.
    """
    today = as_day(as_of)
    first = F.date_sub(today, days - 1)
    by_day = (
        daily_usage.where(F.col("usage_date").between(first, today))
        .groupBy("hubspot_company_id", "usage_date")
        .agg(
            F.sum("total_credits_used").alias("credits"),
            F.sum("prompt_runs").alias("prompt_runs"),
            F.sum("sessions").alias("sessions"),
        )
        .groupBy(F.col("hubspot_company_id").alias("used_by"))
        .agg(
            F.map_from_entries(
                F.collect_list(F.struct("usage_date", F.struct("credits", "prompt_runs", "sessions")))
            ).alias("by_day")
        )
    )
    listed = accounts.select("hubspot_company_id").distinct()
    dense = listed.join(by_day.hint("merge"), F.col("hubspot_company_id") == F.col("used_by"), "left").select(
        "hubspot_company_id",
        "by_day",
        F.explode(F.sequence(first, today)).alias("usage_date"),
    )
    that_day = F.try_element_at("by_day", F.col("usage_date"))
    return dense.select(
        "hubspot_company_id",
        "usage_date",
        *[F.coalesce(that_day[c], F.lit(0)).alias(c) for c in ("credits", "prompt_runs", "sessions")],
        *([(F.col("usage_date") == today).alias("is_partial")] if mark_partial else []),
    )
