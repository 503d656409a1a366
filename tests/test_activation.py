import json

import pytest
from pyspark.sql import functions as F

from revlattice.operators import activation, pressure, quality
from revlattice.sources.seeds import seed_plans
from tests.conftest import day, rows, ts

OVERVIEW = (
    "hubspot_company_id string, health_status string, account_segment string, days_since_last_active bigint, "
    "active_users_14d bigint, plan_name string, credit_usage_pct double, seat_usage_pct double, credits_used_14d bigint, "
    "current_mrr_usd double, lifetime_revenue_usd double, tenure_days bigint, pql_signal_count bigint, is_pql boolean"
)


def account(key, pct=24.0, cash=12345678.9, is_pql=None):
    return (key, "red", "at risk", None, 3, None, pct, float("nan"), 0, 20.0, cash, 9, 2, is_pql)


def test_payload_is_all_text(spark):
    df = activation.company_property_payload(
        spark.createDataFrame([account("7"), account(None)], OVERVIEW), "2024-01-31 06:00:00", prefix="p_"
    )
    assert df.count() == 1
    assert json.loads(df.select(F.to_json("properties")).first()[0]) == {
        "p_health_status": "red", "p_account_segment": "at risk", "p_days_since_active": "", "p_active_users_14d": "3",
        "p_plan": "", "p_credit_usage_pct": "24.0", "p_seat_usage_pct": "", "p_credits_used_14d": "0",
        "p_current_mrr": "20.0", "p_lifetime_revenue": "12345678.9", "p_tenure_days": "9", "p_pql_signals": "2",
        "p_is_pql": "No", "p_synced_at": "2024-01-31T06:00:00+00:00",
    }


def test_stamp_is_utc_in_any_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        df = activation.company_property_payload(
            spark.createDataFrame([account("7")], OVERVIEW), "2024-01-31 06:00:00", prefix="p_"
        )
        assert df.select("properties.p_synced_at").first()[0] == "2024-01-30T21:00:00+00:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


@pytest.mark.parametrize("n", [0, 1, 100, 101, 1234])
def test_batches_are_full_and_complete(spark, n):
    payload = spark.range(n).select(F.col("id").cast("string").alias("id"), F.struct(F.lit("x").alias("a")).alias("properties"))
    got = activation.payload_batches(payload).collect()
    assert sorted(r["size"] for r in got) == sorted([100] * (n // 100) + ([n % 100] if n % 100 else []))
    assert sorted(i.id for r in got for i in r.inputs) == sorted(str(i) for i in range(n))
    assert sorted(r.batch_no for r in got) == list(range(len(got)))


def test_batches_with_one_company_a_third_of_all(spark):
    hot = spark.range(400).select(F.lit("hot").alias("id"), F.struct(F.lit("x").alias("a")).alias("properties"))
    rest = spark.range(800).select(F.col("id").cast("string").alias("id"), F.struct(F.lit("y").alias("a")).alias("properties"))
    first = activation.payload_batches(hot.unionByName(rest)).collect()
    again = activation.payload_batches(rest.unionByName(hot).repartition(7)).collect()
    assert [r["size"] for r in first] == [100] * 12
    assert sum(i.id == "hot" for r in first for i in r.inputs) == 400
    # Whatever the order of arrival, the batches are the same.
    assert sorted(first) == sorted(again)


LEAD = (
    "hubspot_company_id string, company_name string, total_employees bigint, plan_name string, monthly_amount_usd double, "
    "credits_used_14d bigint, signal_count bigint, credit_usage_pct double, active_users bigint"
)


def leads(spark):
    def lead(key, employees, signals=2, credits=5):
        return (key, f"N{key}", employees, "pro", 20.0, credits, signals, None, 3)

    return spark.createDataFrame(
        [lead("1", 99), lead("2", 100), lead("3", 249), lead("4", 250), lead("5", None), lead("5", None, 3), lead("has", 9), lead("has", 9)], LEAD
    )


def test_deals(spark):
    known = spark.createDataFrame([("d1", "has"), ("d2", "has"), ("d3", None), ("d4", "")], "deal_id string, hubspot_company_id string")
    deals = activation.new_pql_deals(leads(spark), known, prefix="p_")
    assert rows(deals, "p_company_id", "amount", "p_pql_signals") == [
        ("1", "12000.0", "2"), ("2", "18000.0", "2"), ("3", "18000.0", "2"), ("4", "24000.0", "2"), ("5", "12000.0", "3"),
    ]
    first = deals.where("p_company_id = '1'").first()
    assert (first.dealname, first.dealstage, first.p_credit_usage_pct, first.p_active_users) == (
        "N1 - Enterprise (PQL)", "appointmentscheduled", "", "3",
    )
    links = activation.deal_associations(deals, prefix="p_")
    assert rows(links)[0] == ("deals", "N1 - Enterprise (PQL)", "companies", "1") and links.count() == 5
    counts = activation.deal_sync_counts(spark.range(7), activation.deal_decisions(leads(spark), known))
    assert rows(counts) == [("company updated", 7), ("deal already existed", 1), ("deal created", 5)]


def test_deals_to_follow_up(spark):
    stages = [("d1", "appointmentscheduled"), ("d2", "closedlost"), ("d3", "closedlost"), ("d4", "closedlost"), ("d5", "closedwon"), ("d6", None), ("d7", "qualifiedtobuy"), ("d8", "closedlost"), ("d9", "closedlost"), ("x", "closedlost")]
    of = [("d1", "gone"), ("d2", "1"), ("d3", "1"), ("d4", "2"), ("d5", "2"), ("d6", "gone"), ("d7", "3"), ("d8", "gone"), ("d9", None), ("d0", "4"), ("x", "")]
    deals = spark.createDataFrame(stages, "deal_id string, deal_stage string").withColumn("hubspot_company_id", F.lit("clash"))
    known = spark.createDataFrame(of, "deal_id string, hubspot_company_id string")
    got = rows(activation.deal_follow_up(leads(spark), deals, known), "action", "deal_id", "hubspot_company_id")
    # A win or an open deal beside lost ones is enough; deals the CRM no longer has count for nothing.
    assert got == [("close", "d1", "gone"), ("close", "d6", "gone"), ("open anew", None, "1")]
    assert activation.deal_follow_up(leads(spark).limit(0), deals, known.limit(0)).count() == 0


def test_pressure(spark):
    state = spark.createDataFrame(
        [("a", "a", "free", 40, 1), ("b", "b", "pro", 75, 4), ("c", "c", "team", 2400, 1), ("d", "d", "enterprise", 3000, 1), ("e", "e", "enterprise", 2999, 1), ("f", "f", "free", 0, 1), ("g", "g", "pro", 74, 4)],
        "hubspot_company_id string, subscription_id string, plan_name string, credits_30d bigint, seats bigint",
    )
    got = rows(pressure.plan_pressure(state, seed_plans(spark)), "subscription_id", "is_pushing", "next_plan", "is_quiet", "lower_plan")
    assert got == [
        ("a", True, "pro", False, None),
        ("b", True, "team", False, None),  # over its seats
        ("c", True, None, False, None),  # self-serve ends at team
        ("d", False, None, False, None),
        ("e", False, None, True, "team"),
        ("f", False, None, False, None),  # free is never quiet
        ("g", True, "team", True, "free"),  # both at once
    ]


def test_quality_checks(spark):
    df = spark.createDataFrame([("a", None), ("b", 1), ("b", 2), (None, 3), (None, 4)], "k string, v int")
    assert rows(quality.null_profile(df, "t")) == [("t", "k", 5, 3), ("t", "v", 5, 4)]
    assert rows(quality.key_uniqueness(df, "k", "t")) == [("t", "b", 2)]

    events = spark.createDataFrame(
        [("x", None, 1, ts("2024-01-01"), ts("2024-01-03 10:00:00")), ("x", "a.com", 0, ts("2024-01-01"), ts("2024-01-01 00:00:30")), ("y", "a.com", 0, ts("2024-01-02"), ts("2024-01-03"))],
        "event_type string, account_domain string, credits_used bigint, occurred_at timestamp, ingested_at timestamp",
    )
    late = quality.unattributed_and_late_events(events).first()
    assert (late.events, late.without_domain, late.late, late.late_pct, late.max_delay_seconds) == (3, 1, 2, 66.7, 208800)
    assert rows(quality.dq_unattributed_report(events)) == [(day("2024-01-01"), "x", 2, 1, 1)]
    assert rows(quality.event_type_counts(events)) == [("x", 2), ("y", 1)]

    people = spark.createDataFrame([("j.s@a",), ("js@a",), ("js@a",), ("js@b",), ("none",), (None,)], "email string")
    assert rows(quality.duplicate_contacts(people)) == [("a", "js", 2, "j.s@a", "js@a")]

    firms = spark.createDataFrame(
        [("1", "Hansen, Miller and Co", "hansenmillerandco.com"), ("2", "X", None), ("3", "A" * 30, "a" * 24 + ".com"), ("4", "Åsa 1", "åsa.com")],
        "company_id string, company_name string, domain string",
    )
    assert rows(quality.domain_from_name_check(firms), "company_id", "expected_domain") == [("2", "x.com"), ("4", "åsa1.com")]


def test_orphans_and_collisions(spark):
    subs = spark.createDataFrame([("c1",), ("c9",), ("c9",), (None,)], "customer_id string")
    bills = spark.createDataFrame([("c9", 2.0), ("c8", 3.0), ("c1", 1.0)], "customer_id string, amount_due_usd double")
    known = spark.createDataFrame([("c1",), ("c2",)], "customer_id string")
    assert rows(quality.orphan_billing(subs, bills, known)) == [(None, 1, 0, 0.0), ("c8", 0, 1, 3.0), ("c9", 2, 1, 2.0)]
    a = spark.createDataFrame([("x",), ("x",), ("y",), (None,)], "company_name string")
    b = spark.createDataFrame([("x",), ("x",), ("x",), ("y",)], "customer_name string")
    assert rows(quality.name_collisions(a, b)) == [("x", 2, 3, 6)]
