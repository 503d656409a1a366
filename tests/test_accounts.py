"""Identity, usage and subscriptions."""

import random

from pyspark.sql import functions as F

from revlattice.operators import identity, subscription, usage
from revlattice.sources.seeds import PLANS, seed_plans
from tests.conftest import day, rows, ts

COMPANY = "company_id string, company_name string, domain string, employees bigint"
CUSTOMER = "customer_id string, customer_name string, hubspot_company_id string"


def matched(spark, companies, customers, match=identity.account_identity):
    companies = [(i, n, f"{i}.com", 10) for i, n in companies]
    df = match(spark.createDataFrame(companies, COMPANY), spark.createDataFrame(customers, CUSTOMER))
    return rows(df, "hubspot_company_id", "customer_id", "match_type")


def test_three_tiers_and_their_quirks(spark):
    got = matched(
        spark,
        [("1", "Acme"), ("2", "Acme"), ("3", "acme"), ("4", None), ("5", "Solo"), ("6", "Twice")],
        [("c1", "Acme", "1"), ("c5", "Solo", None), ("c6", "Twice", "6"), ("c7", "Other", "6"), ("c8", None, None)],
    )
    assert got == [
        ("1", "c1", "direct"),
        ("2", "c1", "name"),  # takes another company's linked customer
        ("3", None, "unmatched"),  # names are case-sensitive
        ("4", None, "unmatched"),  # NULL never matches NULL
        ("5", "c5", "name"),
        ("6", "c6", "direct"),  # two customers: two rows
        ("6", "c7", "direct"),
    ]


def test_normalised_names(spark):
    got = matched(
        spark,
        [("1", "Ember Works AB"), ("2", "  "), ("3", "Co")],
        [("c1", "emberworks, Inc.", None), ("c2", "...", None)],
        identity.identity_normalised_name,
    )
    assert got == [("1", "c1", "name"), ("2", None, "unmatched"), ("3", None, "unmatched")]


def brute_identity(companies, customers):
    direct = [(i, c, "direct") for i, n in companies for c, m, h in customers if h == i]
    linked = {r[0] for r in direct}
    by_name = [
        (i, c, "name") for i, n in companies if i not in linked for c, m, h in customers if n is not None and n == m
    ]
    named = {r[0] for r in by_name}
    return direct + by_name + [(i, None, "unmatched") for i, _ in companies if i not in linked | named]


def test_identity_equals_brute_force_with_hot_keys(spark):
    rng = random.Random(3)
    companies = [(str(i), rng.choice(["hot", "hot", f"n{i % 7}", None])) for i in range(60)]
    customers = [
        (f"c{j}", rng.choice([f"n{j % 9}", "cold", None]), rng.choice(["7", None, str(j)])) for j in range(60)
    ]
    expected = sorted(brute_identity(companies, customers), key=lambda r: [(v is not None, str(v)) for v in r])
    assert matched(spark, companies, customers) == expected


EVENT = "account_domain string, user_email string, event_type string, credits_used bigint, occurred_at timestamp"
IDENTITY = "hubspot_company_id string, company_name string, company_domain string, total_employees bigint, customer_id string, match_type string"


def test_daily_usage_counts_listed_accounts_as_a_join_would(spark):
    events = spark.createDataFrame(
        [
            ("a.com", "u1", "prompt_run", 2, ts("2024-01-01 23:59:59")),
            ("a.com", "u1", "prompt_run", 3, ts("2024-01-02 00:00:00")),
            ("a.com", "u2", "session_started", 0, ts("2024-01-02 10:00:00")),
            (None, "u2", "prompt_run", 9, ts("2024-01-02 10:00:00")),
            ("nobody.com", "u2", "prompt_run", 9, ts("2024-01-02 10:00:00")),
        ],
        EVENT,
    )
    who = spark.createDataFrame(
        [("1", "A", "a.com", 1, "c1", "direct"), ("1", "A", "a.com", 1, "c2", "direct"), ("2", "B", "a.com", 1, None, "unmatched"), ("3", "N", None, 1, None, "unmatched")],
        IDENTITY,
    )
    got = rows(
        usage.account_daily_usage(events, who),
        "hubspot_company_id", "usage_date", "total_credits_used", "active_users", "prompt_runs", "total_events",
    )
    assert got == [
        ("1", day("2024-01-01"), 4, 1, 2, 2),
        ("1", day("2024-01-02"), 6, 2, 2, 4),
        ("2", day("2024-01-01"), 2, 1, 1, 1),
        ("2", day("2024-01-02"), 3, 2, 1, 2),
    ]


DAILY = "hubspot_company_id string, usage_date date, total_credits_used bigint, active_users bigint, sessions bigint, prompt_runs bigint, teammates_invited bigint"


def test_window_edges(spark):
    days = {"2024-01-17": 1, "2024-01-16": 2, "2024-01-03": 4, "2024-01-02": 8, "2024-02-15": 16}
    daily = spark.createDataFrame([("1", day(d), v, 1, 1, 1, 0) for d, v in days.items()], DAILY)
    two = rows(usage.usage_two_windows(daily, "2024-01-31"))
    # 14 days back and the future are recent; 28 days back still counts, 29 does not.
    assert two == [("1", 17, 6)]
    wide = usage.usage_windows(daily, "2024-01-31").first()
    assert (wide.credits_used_30d, wide.credits_used_14d, wide.credits_previous_14d, wide.credits_used_all_time) == (31, 17, 6, 31)
    assert usage.recent_usage_14d(daily, "2024-01-31").first().last_active_date == day("2024-02-15")


def test_chart_is_dense(spark):
    daily = spark.createDataFrame([("1", day("2024-01-31"), 5, 1, 2, 3, 0), ("1", day("2024-01-01"), 7, 1, 1, 1, 0)], DAILY)
    accounts = spark.createDataFrame([("1",), ("2",)], "hubspot_company_id string")
    chart = usage.usage_chart_30d(daily, accounts, "2024-01-31")
    assert chart.count() == 60
    assert rows(chart.where("credits > 0"), "usage_date", "credits", "prompt_runs", "sessions") == [(day("2024-01-31"), 5, 3, 2)]


def test_usage_state(spark):
    subs = spark.createDataFrame(
        [("1", "A", "s1", "pro", "active"), ("1", "A", "s2", "free", "canceled"), ("2", "B", None, None, None), (None, "C", "s3", "pro", "active")],
        "hubspot_company_id string, company_name string, subscription_id string, plan_name string, subscription_status string",
    )
    daily = spark.createDataFrame(
        [("1", day("2024-01-01"), 4, 1), ("1", day("2023-12-31"), 8, 2), ("1", day("2024-02-02"), 16, 0)],
        "hubspot_company_id string, usage_date date, total_credits_used bigint, teammates_invited bigint",
    )
    users = spark.createDataFrame([("1", "a.com", 3), ("1", "b.com", 5)], "hubspot_company_id string, account_domain string, active_users bigint")
    state = usage.account_usage_state(subs, daily, users, "2024-01-31")
    # Counted from 30 days back on, days to come included; invites count whenever they were.
    got = rows(state, "company_name", "subscription_id", "credits_30d", "active_users", "seats", "last_used_on")
    last = day("2024-02-02")
    assert got == [("A", "s1", 20, 5, 4, last), ("A", "s2", 20, 5, 4, last), ("B", None, 0, 0, 1, None), ("C", "s3", 0, 0, 1, None)]


def test_users_of_a_window(spark):
    who = spark.createDataFrame([("1", "a.com"), ("1", "a.com"), ("2", None)], "hubspot_company_id string, company_domain string")
    events = spark.createDataFrame(
        [("a.com", u, "prompt_run", 1, ts(t)) for u, t in (("u1", "2024-01-01 00:00:00"), ("u1", "2024-01-30 00:00:00"), ("u2", "2023-12-31 23:59:59"))]
        + [(None, "u3", "prompt_run", 1, ts("2024-01-30 00:00:00"))],
        EVENT,
    )
    assert rows(usage.active_users_exact(events, who, "2024-01-31", days=30)) == [("1", "a.com", 1)]
    assert rows(usage.active_users_exact(events, who, "2024-01-31", days=31)) == [("1", "a.com", 2)]


def test_account_subscription_keeps_everyone(spark):
    who = spark.createDataFrame(
        [("1", "A", "a", 1, "c1", "direct"), ("2", "B", "b", 1, "c2", "direct"), ("3", "C", "c", 1, None, "unmatched")],
        IDENTITY,
    )
    price = {p[1]: p[0] for p in PLANS}
    subs = spark.createDataFrame(
        [("s1", "c1", price["pro"], 20.0, "active", None, None), ("s2", "c1", "gone", 5.0, "canceled", None, None), ("s3", "lost", price["team"], 1.0, "active", None, None), ("s4", None, price["team"], 1.0, "active", None, None)],
        "subscription_id string, customer_id string, price_id string, monthly_amount_usd double, subscription_status string, created_at timestamp, canceled_at timestamp",
    )
    got = rows(
        subscription.account_subscription(who, subs, seed_plans(spark)),
        "hubspot_company_id", "subscription_id", "plan_name", "is_active",
    )
    assert got == [("1", "s1", "pro", True), ("1", "s2", None, False), ("2", None, None, None), ("3", None, None, None)]
