import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from revlattice.operators import history as h
from tests.conftest import rows, ts

STATE = "subscription_id string, plan_name string, monthly_amount_usd double, subscription_status string, is_active boolean, note string"
VERSION = STATE + ", dbt_valid_from timestamp, dbt_valid_to timestamp"
D = [ts(f"2024-01-0{n}") for n in range(1, 8)]


def state(key, plan="pro", price=20.0, active=True, note="n"):
    return (key, plan, price, "active" if active else "canceled", active, note)


def test_one_run_of_every_kind(spark):
    before = [
        (*state("same"), D[0], None),
        (*state("price"), D[0], None),
        (*state("status"), D[0], None),
        (*state("unchecked"), D[0], None),
        (*state("gone"), D[0], None),
        (*state("back"), D[0], D[1]),
        (*state("nullplan", plan=None), D[0], None),
    ]
    now = [
        state("same"),
        state("price", price=30.0),
        state("status", active=False),
        state("unchecked", note="changed"),
        state("back"),
        state("new"),
        state("nullplan", plan=None),
    ]
    got = rows(
        h.scd2_snapshot_apply(spark.createDataFrame(before, VERSION), spark.createDataFrame(now, STATE), "2024-01-03"),
        "subscription_id", "monthly_amount_usd", "is_active", "note", "dbt_valid_from", "dbt_valid_to",
    )
    assert got == sorted(
        [
            ("same", 20.0, True, "n", D[0], None),
            ("price", 20.0, True, "n", D[0], D[2]),
            ("price", 30.0, True, "n", D[2], None),
            ("status", 20.0, True, "n", D[0], D[2]),
            ("status", 20.0, False, "n", D[2], None),
            ("unchecked", 20.0, True, "n", D[0], None),
            ("gone", 20.0, True, "n", D[0], D[2]),
            ("back", 20.0, True, "n", D[0], D[1]),
            ("back", 20.0, True, "n", D[2], None),
            ("new", 20.0, True, "n", D[2], None),
            ("nullplan", 20.0, True, "n", D[0], None),
        ],
        key=lambda r: [(v is not None, str(v)) for v in r],
    )


def test_a_repeated_key_fails_the_run(spark):
    now = spark.createDataFrame([state("a"), state("a", price=1.0)], STATE)
    with pytest.raises(Exception, match="more than once: a"):
        h.scd2_snapshot_apply(h.empty_history(now), now, "2024-01-03").collect()


def replay(spark, runs):
    """`scd2_snapshot_apply` day by day, each result collected to keep plans short."""
    out = []
    for at, states in runs:
        before = spark.createDataFrame(out, VERSION)
        now = spark.createDataFrame(states, STATE)
        out = [tuple(r) for r in h.scd2_snapshot_apply(before, now, F.lit(at)).collect()]
    return sorted(out, key=lambda r: [(v is not None, str(v)) for v in r])


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.dictionaries(st.sampled_from("abcd"), st.tuples(st.sampled_from([None, "free", "pro"]), st.booleans()), max_size=4),
        min_size=2,
        max_size=6,
    )
)
def test_replay_equals_one_pass(spark, days):
    # A run without any row leaves no date in the states, so every run keeps one key.
    runs = [
        (D[n], [state("keep")] + [state(k, plan=p, active=a) for k, (p, a) in one.items()])
        for n, one in enumerate(days)
    ]
    states = [(*s, at) for at, ss in runs for s in ss]
    once = h.scd2_from_daily_states(spark.createDataFrame(states, STATE + ", state_at timestamp"))
    columns = spark.createDataFrame([], VERSION).columns
    assert rows(once, *columns) == replay(spark, runs)


def test_stored_runs_can_be_repeated(spark, tmp_path):
    root = str(tmp_path / "snap")
    now = [[state("a"), state("b")], [state("a", price=5.0)], [state("a", price=5.0), state("b")]]
    labels = ["2024-01-01", "2024-01-02", "2024-01-03"]
    previous = None
    for label, states in zip(labels, now):
        for _ in range(2):
            df = h.run_snapshot(spark.createDataFrame(states, STATE), root, label, f"{label} 00:00:00", previous)
            result = rows(df, "subscription_id", "monthly_amount_usd", "dbt_valid_from", "dbt_valid_to")
        previous = label
    assert result == sorted(
        [
            ("a", 20.0, D[0], D[1]),
            ("a", 5.0, D[1], None),
            ("b", 20.0, D[0], D[1]),
            ("b", 20.0, D[2], None),
        ],
        key=lambda r: [(v is not None, str(v)) for v in r],
    )


def test_as_of_edges(spark):
    versions = spark.createDataFrame([(*state("a"), D[0], D[2]), (*state("a", price=1.0), D[2], None)], VERSION)
    at = lambda t: [r.monthly_amount_usd for r in h.scd2_as_of(versions, t).collect()]
    assert at("2023-12-31") == [] and at("2024-01-01") == [20.0] and at("2024-01-03") == [1.0]


@pytest.mark.parametrize("period", ["year", "quarter", "month"])
def test_as_of_join_equals_brute_force(spark, period):
    versions = [
        (*state("a", price=1.0), ts("2023-11-15"), ts("2024-01-31")),
        (*state("a", price=2.0), ts("2024-01-31"), ts("2024-02-01")),
        (*state("a", price=3.0), ts("2024-03-10"), None),  # after a gap, open
        (*state("b", price=4.0), ts("2024-06-01"), None),  # starts after as_of
        (*state("c", price=5.0), ts("2024-02-10"), ts("2024-09-01")),  # ends after as_of
    ]
    facts = [
        (f"{k}{n}", k, ts("2023-11-01") + dt.timedelta(days=n * 5, hours=n % 3)) for k in "abcz" for n in range(90)
    ] + [("null", None, D[0]), ("notime", "a", None)]
    joined = h.scd2_as_of_join(
        spark.createDataFrame(facts, "fact string, subscription_id string, at timestamp"),
        "at",
        spark.createDataFrame(versions, VERSION),
        ["monthly_amount_usd"],
        as_of="2024-04-15",
        period=period,
    )

    def price(key, at):
        hits = [v[2] for v in versions if at and v[0] == key and v[6] <= at and (v[7] is None or v[7] > at)]
        return hits[0] if hits else None

    assert rows(joined, "fact", "version_monthly_amount_usd") == sorted(
        [(f, price(k, at)) for f, k, at in facts], key=lambda r: [(v is not None, str(v)) for v in r]
    )


def test_many_moments_are_no_single_task(spark):
    """Each state has its own time: the calendar is as long as the data, and ordered in ranges."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        n = 400
        states = spark.range(n).select(
            F.concat(F.lit("s"), F.col("id") % 7).alias("subscription_id"), F.lit("pro").alias("plan_name"), F.col("id").cast("double").alias("monthly_amount_usd"),
            F.lit("active").alias("subscription_status"), F.lit(True).alias("is_active"), F.timestamp_seconds(F.col("id") * 1000 + 7).alias("state_at"),
        )
        got = h.scd2_from_daily_states(states)
        plan = got._jdf.queryExecution().executedPlan().toString()
        found = got.select("monthly_amount_usd", F.unix_seconds("dbt_valid_from"), F.unix_seconds("dbt_valid_to")).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    # A key is not in the next run, so each state ends there; the last one stays open.
    want = [(float(i), i * 1000 + 7, i * 1000 + 1007 if i < n - 1 else None) for i in range(n)]
    assert sorted(map(tuple, found)) == want
    # Only the heads of the ranges, one row each, are brought together.
    assert plan.count("SinglePartition") <= 1
