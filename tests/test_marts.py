"""Health, leads, overview and the pages' queries."""

import pytest

from revlattice.operators import health, overview, pql, reads
from tests.conftest import day, rows, ts

SUB = (
    "hubspot_company_id string, customer_id string, company_name string, subscription_id string, plan_name string, "
    "plan_rank bigint, seat_limit bigint, monthly_credits bigint, monthly_amount_usd double, "
    "subscription_status string, created_at timestamp, canceled_at timestamp, is_active boolean"
)
DAILY = (
    "hubspot_company_id string, usage_date date, total_credits_used bigint, active_users bigint, sessions bigint, "
    "prompt_runs bigint, teammates_invited bigint"
)
IDENTITY = "hubspot_company_id string, company_name string, company_domain string, total_employees bigint, customer_id string, match_type string"
TODAY = "2024-01-31"
RECENT, PREVIOUS = day("2024-01-20"), day("2024-01-10")


def sub(account, plan="pro", active=True, price=20.0, credits=500, seats=3, customer="auto", n=1, started="2023-12-01"):
    customer = f"c{account}" if customer == "auto" else customer
    return (
        account, customer, f"N{account}", f"s{account}_{n}", plan, 2, seats, credits, price,
        "active" if active else "canceled", ts(started), None, active,
    )


def used(account, when, credits, users=1, invites=0):
    return (account, when, credits, users, 1, 1, invites)


def frames(spark, subs, daily):
    return spark.createDataFrame(subs, SUB), spark.createDataFrame(daily, DAILY)


def test_health_rules(spark):
    pairs = {"1": (50, 100), "2": (49, 100), "3": (75, 100), "4": (74, 100), "5": (1, 0), "6": (0, 9)}
    daily = [used(a, RECENT, r) for a, (r, _) in pairs.items() if r] + [used(a, PREVIOUS, p) for a, (_, p) in pairs.items() if p]
    subs = [sub(a) for a in [*pairs, "7"]] + [
        sub("8", plan="free"), sub("9", active=False), sub("10", plan=None), (*sub("11")[:-1], None),
    ]
    scored = health.account_health(*frames(spark, subs, daily), TODAY)
    assert rows(scored, "hubspot_company_id", "health_status") == [
        ("1", "yellow"), ("2", "red"), ("3", "green"), ("4", "yellow"), ("5", "green"), ("6", "red"), ("7", "red"),
    ]
    reasons = dict(rows(health.health_reason(scored), "hubspot_company_id", "health_reason"))
    assert reasons["2"] == "dropped by more than half" and reasons["6"] == reasons["7"] == "silent"
    assert reasons["1"] == "dropped by more than a quarter" and reasons["5"] == "steady"


def test_equal_windows_leave_the_fifteenth_day_out(spark):
    daily = [used("1", day("2024-01-17"), 5), used("1", day("2024-01-18"), 1), used("1", day("2024-02-01"), 50)]
    frame = frames(spark, [sub("1")], daily)
    equal = health.equal_health_windows(*frame, TODAY).first()
    usual = health.account_health(*frame, TODAY).first()
    assert (equal.credits_recent, equal.credits_previous) == (1, 5)
    assert (usual.credits_recent, usual.credits_previous) == (56, 0)


def test_lead_rules(spark):
    cases = {
        # account: employees, plan, active, credits allowed, credits used, users, invites -> signals
        "users+invite": (50, "pro", True, 500, 0, 3, 1, 2),
        "credits+invite": (50, "free", True, 50, 40, 2, 1, 2),
        "all": (90, "team", True, 100, 100, 5, 2, 3),
        "almost credits": (50, "pro", True, 1000, 799, 2, 1, 1),
        "two users": (50, "pro", True, 500, 0, 2, 1, 1),
        "no allowance": (50, "pro", True, 0, 10, 3, 0, 1),
        "unknown allowance": (50, "pro", True, None, 10, 3, 1, 2),
        "small": (49, "pro", True, 10, 100, 5, 5, None),
        "enterprise": (500, "enterprise", True, 10, 100, 5, 5, None),
        "stopped": (500, "pro", False, 10, 100, 5, 5, None),
        "silent": (500, "pro", True, 10, None, 0, 0, 0),
    }
    who = [(a, a, f"{a}.com", c[0], "c", "direct") for a, c in cases.items()]
    subs = [sub(a, customer="c", plan=c[1], active=c[2], credits=c[3]) for a, c in cases.items()]
    daily = [used(a, RECENT, c[4], c[5], c[6]) for a, c in cases.items() if c[4] is not None]
    args = spark.createDataFrame(who, IDENTITY), *frames(spark, subs, daily), TODAY
    signals = dict(rows(pql.pql_signals(*args), "hubspot_company_id", "signal_count"))
    assert signals == {a: c[7] for a, c in cases.items() if c[7] is not None}
    leads = rows(pql.product_qualified_leads(*args), "hubspot_company_id", "credit_usage_pct")
    assert leads == [("all", 100.0), ("credits+invite", 80.0), ("unknown allowance", None), ("users+invite", 0.0)]
    ranked = pql.ranked_leads(pql.product_qualified_leads(*args)).collect()
    assert [r.signal_count for r in ranked] == [3, 2, 2, 2] and ranked[1].credits_used_14d == 40


def test_primary_contact(spark):
    people = [
        ("p1", "b@x", "x", "B", "Z", ts("2024-01-02")),
        ("p2", "a@x", "x", "A", "Z", ts("2024-01-01")),
        ("p3", "c@x", "x", "C", "Z", ts("2024-01-01")),
        ("p4", "d@y", "y", "D", None, ts("2024-01-01")),
        ("p5", "e@z", "z", "E", "Z", ts("2020-01-01")),
        ("p6", "f@z", "z", "F", "Z", None),
    ]
    schema = "contact_id string, email string, email_domain string, first_name string, last_name string, created_at timestamp"
    got = rows(overview.primary_contact(spark.createDataFrame(people, schema)))
    assert got == [("a@x", "x", "A Z"), ("d@y", "y", None), ("f@z", "z", "F Z")]


INVOICE = "invoice_id string, customer_id string, payment_status string, amount_due_usd double, amount_paid_usd double"
CONTACT = "contact_id string, email string, email_domain string, first_name string, last_name string, created_at timestamp"


@pytest.fixture(scope="module")
def wide(spark):
    who = spark.createDataFrame(
        [(a, f"N{a}", f"{a}.com", 100, None if a == "never" else f"c{a}", "direct") for a in
         ("never", "stopped", "lead", "red", "watch", "dormant", "active", "healthy")],
        IDENTITY,
    )
    none = ("never", None, "Nnever", None, None, None, None, None, None, None, None, None, None)
    subs = [
        none, sub("stopped", active=False, price=100.0), sub("lead"), sub("red"), sub("watch"),
        sub("dormant", plan="free", price=0.0, credits=50, seats=0), sub("active", plan="free", price=0.0, credits=50),
        sub("healthy", plan="enterprise", started="2024-01-21"),
    ]
    daily = [
        used("lead", PREVIOUS, 50), used("lead", RECENT, 10, 3, 1), used("watch", PREVIOUS, 100), used("watch", RECENT, 60),
        used("active", RECENT, 7, 2), used("healthy", RECENT, 7, 1), used("dormant", day("2023-06-01"), 9),
    ]
    subscriptions, usage = frames(spark, subs, daily)
    invoices = spark.createDataFrame(
        [("i1", "clead", "paid", 20.0, 20.0), ("i2", "clead", "paid", 0.0, 0.0), ("i3", "clead", "open", 20.0, 0.0), ("i4", "clead", "open", 20.0, 20.0), ("i5", "cred", "open", 9.0, 0.0)],
        INVOICE,
    )
    contacts = spark.createDataFrame([("p", "a@lead.com", "lead.com", "A", "B", None)], CONTACT)
    scored = health.account_health(subscriptions, usage, TODAY)
    leads = pql.product_qualified_leads(who, subscriptions, usage, TODAY)
    out = overview.account_overview(who, subscriptions, usage, scored, leads, invoices, contacts, TODAY, "2024-01-31 06:00:00")
    return out.cache(), subscriptions, invoices


def test_segments_in_their_order(wide):
    assert dict(rows(wide[0], "hubspot_company_id", "account_segment")) == {
        "never": "churned", "stopped": "churned",
        "lead": "sales opportunity",  # although it is red
        "red": "at risk", "watch": "watch", "dormant": "dormant free", "active": "active free", "healthy": "healthy paying",
    }


def test_overview_columns(wide):
    by = {r.hubspot_company_id: r for r in wide[0].collect()}
    assert wide[0].columns == overview.OVERVIEW_COLUMNS and len(wide[0].columns) == 40
    assert (by["stopped"].monthly_amount_usd, by["stopped"].current_mrr_usd, by["stopped"].annual_run_rate_usd) == (100.0, 0.0, 0.0)
    assert (by["lead"].current_mrr_usd, by["lead"].annual_run_rate_usd) == (20.0, 240.0)
    assert by["lead"].is_pql and by["lead"].health_status == "red" and not by["red"].is_pql
    assert (by["lead"].lifetime_revenue_usd, by["lead"].invoices_paid, by["red"].invoices_paid) == (20.0, 1, 0)
    assert (by["lead"].contact_email, by["lead"].contact_name, by["red"].contact_email) == ("a@lead.com", "A B", None)
    assert by["never"].is_active is None and by["never"].tenure_days is None and by["never"].health_status == "not_scored"
    assert (by["healthy"].tenure_days, by["healthy"].days_since_last_active) == (10, 11)
    # 30 days against the monthly allowance, and no division by a zero seat limit.
    assert (by["lead"].credit_usage_pct, by["active"].seat_usage_pct, by["dormant"].seat_usage_pct) == (12.0, 66.7, None)
    assert by["dormant"].credits_used_all_time == 9 and by["dormant"].days_since_last_active == 244


def test_an_account_with_two_subscriptions_has_a_row_for_each(spark):
    who = spark.createDataFrame([("1", "N", "1.com", 9, "c1", "direct")], IDENTITY)
    subscriptions, usage = frames(spark, [sub("1", n=1, customer="c1"), sub("1", n=2, customer="c1")], [used("1", RECENT, 3)])
    scored = health.account_health(subscriptions, usage, TODAY)
    leads = pql.product_qualified_leads(who, subscriptions, usage, TODAY)
    empty = spark.createDataFrame([], INVOICE), spark.createDataFrame([], CONTACT)
    out = overview.account_overview(who, subscriptions, usage, scored, leads, *empty, TODAY)
    assert out.count() == 2  # the two health rows are reduced to the account's worst


def test_extension_flags(wide):
    low = dict(rows(health.health_low_usage_rule(wide[0]), "hubspot_company_id", "health_with_low_usage"))
    assert low["healthy"] == "yellow" and low["red"] == "red"
    young = dict(rows(health.short_history_flag(wide[0]), "hubspot_company_id", "short_history"))
    assert young["healthy"] and not young["red"]
    unpaid = dict(rows(health.failed_payment_signal(wide[1], wide[2]), "hubspot_company_id", "unpaid_invoices"))
    assert unpaid == {"lead": 2, "red": 1, "watch": 0, "healthy": 0}


def test_pages(wide):
    cards = reads.kpi_cards(wide[0]).first()
    assert cards.asDict() == {"mrr_usd": 80.0, "arr_usd": 960.0, "active_paying_accounts": 4, "pqls": 1, "accounts_at_risk": 1}
    assert dict(rows(reads.segment_summary(wide[0]), "account_segment", "accounts"))["churned"] == 2
    assert (None, 1) in rows(reads.plan_summary(wide[0]), "plan_name", "accounts")
    pick = lambda **kw: [r[0] for r in rows(reads.account_filter(wide[0], TODAY, **kw), "hubspot_company_id")]
    assert len(pick()) == 8
    assert pick(search="LEAD") == ["lead"] and pick(search="%") == [] and pick(pql_only=True) == ["lead"]
    assert pick(segment="churned") == ["never", "stopped"] and pick(health="red") == ["lead", "red"]
    assert pick(plan="free", active_within_days=14) == ["active"]


def test_account_detail_of_one_account(spark, tmp_path):
    """Dense days with the last one marked; the account's id reaches the scans of both inputs."""
    from pyspark.sql import functions as F

    from revlattice.operators import reads
    from revlattice.operators.overview import OVERVIEW_COLUMNS

    wide = spark.sql("SELECT explode(array('1', '2', null)) AS hubspot_company_id").select(
        "hubspot_company_id", *[F.lit("x").alias(c) for c in OVERVIEW_COLUMNS[1:]]
    )
    wide.write.parquet(str(tmp_path / "overview"))
    used = spark.sql("SELECT '1' AS hubspot_company_id, date'2024-01-30' AS usage_date, 5L AS total_credits_used, 2L AS prompt_runs, 1L AS sessions")
    used.write.parquet(str(tmp_path / "daily"))
    overview, daily = (spark.read.parquet(str(tmp_path / n)) for n in ("overview", "daily"))
    one = reads.account_detail(overview, daily, "2024-01-31", account_id="1", days=3)
    (got,) = one.collect()
    assert [(str(d.usage_date), d.credits, d.is_partial) for d in got.daily] == [
        ("2024-01-29", 0, False), ("2024-01-30", 5, False), ("2024-01-31", 0, True),
    ]
    assert (got.header.plan_name, got.company.company_domain) == ("x", "x")
    assert one._jdf.queryExecution().executedPlan().toString().count("EqualTo(hubspot_company_id,1)") >= 2
    every = {r.hubspot_company_id: r.daily for r in reads.account_detail(overview, daily, "2024-01-31").collect()}
    assert len(every["2"]) == 30 and every[None] is None and len(every) == 3


def test_account_pages_and_charts_are_not_broadcast(spark, tmp_path):
    """Small files hold series of any size, so Spark's estimate of them must not decide."""
    from pyspark.sql import functions as F

    from revlattice.operators import reads, usage
    from revlattice.operators.overview import OVERVIEW_COLUMNS

    accounts = spark.range(40).select((F.col("id") % 35).cast("string").alias("hubspot_company_id"))
    accounts = accounts.union(spark.sql("SELECT CAST(null AS string)"))
    accounts.select("*", *[F.lit("x").alias(c) for c in OVERVIEW_COLUMNS[1:]]).write.parquet(str(tmp_path / "overview"))
    spark.range(300).selectExpr(
        "cast(id % 20 as string) AS hubspot_company_id", "date_sub(date'2024-01-31', cast(id % 40 as int)) AS usage_date",
        "id AS total_credits_used", "1L AS prompt_runs", "2L AS sessions",
    ).write.parquet(str(tmp_path / "daily"))
    overview, daily = (spark.read.parquet(str(tmp_path / n)) for n in ("overview", "daily"))
    pages = reads.account_detail(overview, daily, "2024-01-31")
    for df in (pages, usage.usage_chart_30d(daily, overview, "2024-01-31")):
        found = df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Broadcast" not in plan and "SortMergeJoin" in plan and found
    got = pages.collect()
    assert len(got) == 41 and sum(r.hubspot_company_id == "3" for r in got) == 2
    assert all((r.daily is None) if r.hubspot_company_id is None else len(r.daily) == 30 for r in got)
    assert sum(d.credits for r in {r.hubspot_company_id: r for r in got if r.daily}.values() for d in r.daily) == sum(i for i in range(300) if i % 40 < 30)
