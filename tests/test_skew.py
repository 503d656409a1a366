"""Joins with one key on a third of the rows are split, and give what a plain join gives."""

import pytest
from pyspark.sql import functions as F

from revlattice.functions.skew import attach_unique, keep_unmatched
from revlattice.operators.identity import account_identity
from revlattice.operators.subscription import account_subscription
from revlattice.sources.seeds import seed_plans

SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    "spark.sql.shuffle.partitions": "12",
}


@pytest.fixture
def as_if_large(spark):
    """Sizes scaled down so that AQE treats the test rows like a large table."""
    before = {k: spark.conf.get(k, None) for k in SMALL}
    for k, value in SMALL.items():
        spark.conf.set(k, value)
    yield spark
    for k, value in before.items():
        spark.conf.unset(k) if value is None else spark.conf.set(k, value)


def keyed(spark, n, hot):
    """`n` rows over many keys; a third of them has the key `hot` (which may be NULL)."""
    return spark.range(n, numPartitions=8).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, F.lit(hot).cast("string")).otherwise(F.concat(F.lit("k"), F.col("id") % 1000)).alias("key"),
        F.sha2(F.col("id").cast("string"), 512).alias("ballast"),
    )


def run(df):
    out = df.collect()
    return out, df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("hot", ["hot", None])
def test_left_joins_to_an_aggregate(as_if_large, hot):
    left = keyed(as_if_large, 30000, hot)
    right = left.where("key IS NOT NULL").groupBy(F.col("key").alias("rkey")).agg(F.max("id").alias("m"))
    out, plan = run(attach_unique(left, "key", right.where("m % 2 = 0"), "rkey"))
    assert "skew=true" in plan
    plain = left.join(right.where("m % 2 = 0"), F.col("key") == F.col("rkey"), "left").drop("rkey")
    assert sorted(map(str, out)) == sorted(map(str, plain.collect()))


@pytest.mark.parametrize("hot", ["hot", None])
@pytest.mark.parametrize("known", ["hot", "k5"])
def test_anti_joins(as_if_large, hot, known):
    left = keyed(as_if_large, 30000, hot)
    # The right side has a hot key of its own.
    right = as_if_large.range(9000).select(
        F.when(F.col("id") % 3 == 0, F.lit(known)).otherwise(F.concat(F.lit("k"), F.col("id") % 300 * 2)).alias("rkey")
    )
    out, plan = run(keep_unmatched(left, "key", right, "rkey"))
    assert "skew=true" in plan
    seen = {r.rkey for r in right.collect()}
    assert sorted(r.id for r in out) == sorted(r.id for r in left.collect() if r.key not in seen)


def test_hot_names_and_hot_customers(as_if_large):
    spark = as_if_large
    companies = keyed(spark, 12000, "Hot name").select(
        F.col("id").cast("string").alias("company_id"),
        F.col("key").alias("company_name"),
        F.col("ballast").alias("domain"),
        F.lit(1).cast("bigint").alias("employees"),
    )
    # Nearly half of the customers name one and the same company.
    customers = spark.range(9000).select(
        F.concat(F.lit("c"), "id").alias("customer_id"),
        F.concat(F.lit("k"), F.col("id") % 500).alias("customer_name"),
        F.expr("if(id % 2 = 0, '77', null)").alias("hubspot_company_id"),
    )
    found = account_identity(companies, customers)
    counts = {r.match_type: r["count"] for r in found.groupBy("match_type").count().collect()}
    # Company 77 takes its 4500 customers; the rest go by name, 18 customers to each.
    names = {f"k{i}" for i in range(500)}
    rest = [r for r in companies.collect() if r.company_id != "77"]
    by_name = sum(18 for r in rest if r.company_name in names)
    assert counts == {"direct": 4500, "name": by_name, "unmatched": sum(r.company_name not in names for r in rest)}

    subscriptions = spark.range(20000).select(
        F.concat(F.lit("s"), "id").alias("subscription_id"),
        F.expr("if(id % 3 = 0, 'c0', concat('c', id % 9000))").alias("customer_id"),
        F.lit("p").alias("price_id"),
        F.lit(1.0).alias("monthly_amount_usd"),
        F.lit("active").alias("subscription_status"),
        F.lit(None).cast("timestamp").alias("created_at"),
        F.lit(None).cast("timestamp").alias("canceled_at"),
    )
    who = found.where("match_type <> 'name'")
    total = account_subscription(who, subscriptions, seed_plans(spark)).count()
    held = {}
    for r in subscriptions.select("customer_id").collect():
        held[r.customer_id] = held.get(r.customer_id, 0) + 1
    assert total == sum(max(held.get(r.customer_id, 0), 1) for r in who.select("customer_id").collect())
