"""Nothing is lost or multiplied on inputs that real sources have and the benchmark lacks."""

import pytest
from pyspark.sql import functions as F

from revlattice.operators import history, overview, pql, usage
from revlattice.operators.staging import stg_usage_events
from revlattice.session import fresh_folder
from revlattice.sources import usage_log
from revlattice.streaming import incremental
from tests.conftest import rows, ts


def events(spark, *some):
    """(event_id, domain, user, credits, occurred_at, ingested_at)"""
    data = [(i, "prompt_run", d, u, c, ts(o) if o else None, ts(g)) for i, d, u, c, o, g in some]
    return spark.createDataFrame(data, usage_log.EVENT_SCHEMA)


SOME = [
    ("a", "x.com", "u1", 1, "2024-01-02 10:00:00", "2024-01-02 10:05:00"),
    (None, "x.com", "u1", 2, "2024-01-02 11:00:00", "2024-01-02 11:05:00"),
    (None, "x.com", "u2", 3, "2024-01-02 12:00:00", "2024-01-02 12:05:00"),
    ("b", "x.com", "u3", 4, None, "2024-01-02 12:05:00"),
    (None, "y.com", "u4", 5, None, "2024-01-02 12:06:00"),
    ("a", "x.com", "late", 9, "2024-01-02 10:00:00", "2024-01-03 10:05:00"),
]


def test_events_without_id_or_time_are_kept_once(spark):
    path, batch = fresh_folder(spark, "log"), events(spark, *SOME)
    for _ in range(2):
        usage_log.append_usage_events(batch, path)
        kept = usage_log.read_usage_log(spark, path)
        assert rows(kept, "credits_used") == [(1,), (2,), (3,), (4,), (5,)]


def test_incremental_facts_equal_the_batch_ones(spark):
    root, batch = fresh_folder(spark, "incremental"), events(spark, *SOME)
    log, daily = f"{root}/log", f"{root}/daily"
    for part in (batch.where("credits_used % 2 = 1"), batch.where("credits_used % 2 = 0"), batch):
        incremental.incremental_daily_usage(part, log, daily)
    whole = usage.domain_daily_usage(stg_usage_events(batch.where("credits_used < 9")))
    assert rows(incremental.read_domain_usage(spark, daily), *whole.columns) == rows(whole)


def test_log_windows_read_their_partitions_only(spark):
    path = fresh_folder(spark, "log")
    usage_log.append_usage_events(events(spark, *SOME), path)
    logged = stg_usage_events(usage_log.read_usage_log(spark, path))
    who = spark.createDataFrame([("1", "x.com")], "hubspot_company_id string, company_domain string")
    df = usage.active_users_exact_14d(logged, who, "2024-01-10")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(occurred_date" in plan
    assert rows(df, "active_users_14d_exact") == [(2,)]


STATE = (
    "subscription_id string, hubspot_company_id string, company_name string, customer_id string, plan_name string, plan_rank int, "
    "monthly_amount_usd double, subscription_status string, is_active boolean, created_at timestamp, canceled_at timestamp"
)


def test_a_run_finds_the_one_before_it(spark):
    root = fresh_folder(spark, "history")

    def run(label, price, **given):
        now = spark.createDataFrame([("s", "1", "A", "c", "pro", 2, price, "active", True, None, None)], STATE)
        return rows(history.run_snapshot(now, root, label, f"{label} 00:00:00", **given), "monthly_amount_usd")

    assert run("2024-01-01", 20.0) == [(20.0,)]
    assert run("2024-01-02", 100.0) == [(100.0,), (20.0,)]
    assert run("2024-01-03", 100.0, previous_run="2024-01-02") == [(100.0,), (20.0,)]
    assert run("2024-01-02", 100.0) == [(100.0,), (20.0,)]  # a day can be repeated
    with pytest.raises(ValueError, match="2024-01-03"):
        run("2024-01-04", 100.0, previous_run="2024-01-01")


def test_many_customers_of_a_company_are_not_paired(spark):
    n = 200
    who = spark.range(n).select(
        F.lit("1").alias("hubspot_company_id"), F.lit("A").alias("company_name"), F.lit("a.com").alias("company_domain"),
        F.lit(100).cast("bigint").alias("total_employees"), F.concat(F.lit("c"), "id").alias("customer_id"), F.lit("direct").alias("match_type"),
    )
    held = who.select(
        "hubspot_company_id", "company_name", "customer_id", F.col("customer_id").alias("subscription_id"), F.lit("pro").alias("plan_name"),
        F.lit(2).alias("plan_rank"), F.lit(20.0).alias("monthly_amount_usd"), F.lit("active").alias("subscription_status"),
        F.lit(True).alias("is_active"), F.lit(None).cast("timestamp").alias("created_at"), F.lit(None).cast("timestamp").alias("canceled_at"),
        F.lit(5).cast("bigint").alias("seat_limit"), F.lit(100).cast("bigint").alias("monthly_credits"),
    )
    daily = spark.createDataFrame([], "hubspot_company_id string, usage_date date, total_credits_used bigint, active_users bigint, teammates_invited bigint")
    assert pql.pql_signals(who, held, daily, "2024-01-31").count() == n
    assert overview._accounts_with_subscription(who, held).count() == n
