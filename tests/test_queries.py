"""Every registered query against its SQL, and what the plans must not contain."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from revlattice.plans.oracle import ORACLE
from revlattice.plans.query_list import QUERIES
from revlattice.session import apply_rules
from tests.compare import compare, duck
from tests.conftest import SF


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE) and len(QUERIES) >= 70
    assert set(QUERIES) <= set(queries()) and set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_same_values_as_sql(spark, con, name):
    df = QUERIES[name](spark, SF)
    problem, _ = compare(df, con, ORACLE[name])
    assert problem is None, problem
    plan = df._jdf.queryExecution().executedPlan().toString()
    for costly in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert costly not in plan


def test_entry(spark):
    assert entry(spark).count() == 81


# Counts stated for the derived tables, measured apart from this code.
def test_known_counts(spark):
    q = {n: f(spark, SF) for n, f in queries().items() if n in ("account_health", "match_type_coverage", "segment_summary", "revenue_reconciles")}
    assert dict(q["match_type_coverage"].collect()) == {"direct": 129, "name": 15, "unmatched": 6}
    health = q["account_health"].groupBy("health_status").count()
    assert dict(health.collect()) == {"red": 80, "green": 1}
    assert {r[0]: r[1] for r in q["segment_summary"].collect()} == {
        "churned": 18, "sales opportunity": 3, "at risk": 80, "dormant free": 48, "active free": 1,
    }
    gap = q["revenue_reconciles"].first()
    assert (gap.ending_mrr, gap.total_mrr) == (-15900.0, 39220.0)


def test_recent_usage_reads_recent_days_only(spark, tmp_path):
    """The date limit of a window reaches the scan of the stored daily facts."""
    from revlattice.operators.usage import attribute_usage, usage_two_windows
    from revlattice.streaming import incremental

    apply_rules(spark)
    path = str(tmp_path / "daily")
    one = spark.sql("SELECT 'a.com', 1, 1, 1, 1, 1, 1, 1, 1, date'2024-01-20'").toDF(
        *[f.split()[0] for f in incremental.DAILY_SCHEMA.split(", ")]
    )
    one.to(incremental.read_domain_usage(spark, str(tmp_path)).schema).write.partitionBy("usage_date").parquet(path)
    who = spark.createDataFrame([("1", "a.com")], "hubspot_company_id string, company_domain string")
    windows = usage_two_windows(attribute_usage(incremental.read_domain_usage(spark, path), who), "2024-01-31")
    text = windows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(usage_date" in text and "2024-01-03" in text
    assert "ReadSchema: struct<account_domain:string,total_credits_used:bigint>" in text
