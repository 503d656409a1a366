import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from revlattice.operators import history, quality, revenue
from tests.conftest import day, rows, ts

VERSION = "subscription_id string, monthly_amount_usd double, is_active boolean, created_at timestamp, canceled_at timestamp, dbt_valid_from timestamp, dbt_valid_to timestamp"
# Mondays: 2024-01-01, -08, -15, -22, -29
W = [day(f"2024-01-{d:02d}") for d in (1, 8, 15, 22, 29)]


def versions(spark, *items):
    return spark.createDataFrame(
        [(k, float(p), a, ts(c), x and ts(x), ts(f), None) for k, p, a, c, x, f in items], VERSION
    )


def weeks(spark, *items, as_of="2024-01-31"):
    df = revenue.revenue_movements(versions(spark, *items), as_of)
    names = ["week_start", "new_mrr", "expansion_mrr", "contraction_mrr", "churned_mrr", "ending_mrr"]
    return {r.week_start: tuple(r)[1:] for r in df.select(*names).collect()}


def v(key, price, valid_from, active=True, created="2024-01-01", canceled=None):
    return key, price, active, created, canceled, valid_from


def test_each_kind_of_movement(spark):
    got = weeks(
        spark,
        v("a", 0, "2024-01-01"), v("a", 20, "2024-01-08"),  # free to paid: new
        v("b", 20, "2024-01-01"), v("b", 100, "2024-01-09"), v("b", 20, "2024-01-16"), v("b", 0, "2024-01-23"),
        v("c", 100, "2024-01-02"), v("c", 100, "2024-01-30", active=False, canceled="2024-01-14 23:00:00"),
    )
    assert got == {
        W[0]: (120.0, 0.0, 0.0, 0.0, 120.0),
        W[1]: (20.0, 80.0, 0.0, 100.0, 120.0),
        W[2]: (0.0, 0.0, 80.0, 0.0, 40.0),
        W[3]: (0.0, 0.0, 0.0, 20.0, 20.0),
        W[4]: (0.0, 0.0, 0.0, 0.0, 20.0),  # a quiet week is there too
    }


def test_quirks_of_the_history(spark):
    # Stopped and changed price at once: both count.
    both = weeks(spark, v("a", 20, "2024-01-01"), v("a", 100, "2024-01-08", active=False))
    assert both[W[1]] == (0.0, 80.0, 0.0, 100.0, 0.0)
    # First seen inactive is no start, coming back adds nothing.
    back = weeks(spark, v("x", 0, "2024-01-01"), v("a", 20, "2024-01-08", active=False), v("a", 20, "2024-01-15"))
    assert [r[-1] for r in back.values()] == [0.0] * 5
    # No start, or one after today: no weeks at all.
    assert weeks(spark, v("a", 20, "2024-01-08", active=False)) == {}
    assert weeks(spark, v("a", 20, "2024-03-01", created="2024-03-01")) == {}
    # Movements before the first start's week vanish.
    early = weeks(spark, v("a", 5, "2024-01-08", created="2024-01-15"), v("a", 9, "2024-01-08 12:00:00"))
    assert early == {W[2]: (5.0, 0.0, 0.0, 0.0, 5.0), W[3]: (0.0, 0.0, 0.0, 0.0, 5.0), W[4]: (0.0, 0.0, 0.0, 0.0, 5.0)}


def test_parts_agree_with_the_one_pass(spark):
    prev = revenue.subscription_versions_with_prev(
        versions(spark, v("a", 0, "2024-01-01"), v("a", 20, "2024-01-08"), v("a", 20, "2024-01-15", active=False))
    )
    assert rows(revenue.subscription_starts(prev)) == [("a", W[0], 0.0)]
    assert rows(revenue.price_changes_classified(prev)) == [("a", W[1], "new", 20.0)]
    assert rows(revenue.cancellations(prev)) == [("a", W[2], 20.0)]
    assert rows(revenue.movements(prev)) == sorted(
        [(W[0], None, 0.0, True), (W[1], "new", 20.0, False), (W[2], "churn", 20.0, False)],
        key=lambda r: [(x is not None, str(x)) for x in r],
    )
    assert [r[0] for r in rows(revenue.week_spine(revenue.movement_totals(revenue.movements(prev)), "2024-01-16"))] == W[:3]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.lists(st.sampled_from([0, 20, 100, 1000]), min_size=1, max_size=5), st.booleans()), min_size=1, max_size=8))
def test_reconciles_without_reactivation(spark, subscriptions):
    items = []
    for n, (prices, stops) in enumerate(subscriptions):
        for i, price in enumerate(prices):
            last = i == len(prices) - 1 and i > 0
            # A stop keeps the price it had, as billing does.
            stopping = last and stops
            items.append(v(f"s{n}", prices[i - 1] if stopping else price, f"2024-01-{i * 6 + 1:02d}", active=not stopping))
    history_ = versions(spark, *items)
    latest = {k: (p if a else 0.0) for k, p, a, *_ in items}
    accounts = spark.createDataFrame([(float(x),) for x in latest.values()], "current_mrr_usd double")
    found = quality.revenue_reconciles(revenue.revenue_movements(history_, "2024-01-31"), accounts)
    assert found.count() == 0


@pytest.mark.parametrize(
    "ending, totals, plain, strict",
    [(5.0, [2.0, 3.0], 0, 0), (5.0, [2.0], 1, 1), (5.0, [], 0, 1), (None, [2.0], 0, 1), (None, [], 0, 1)],
)
def test_reconciliation(spark, ending, totals, plain, strict):
    weeks_ = [] if ending is None else [(W[0], 99.0), (W[1], ending)]
    moves = spark.createDataFrame(weeks_, "week_start date, ending_mrr double")
    accounts = spark.createDataFrame([(t,) for t in totals], "current_mrr_usd double")
    assert quality.revenue_reconciles(moves, accounts).count() == plain
    assert quality.revenue_reconciles(moves, accounts, strict=True).count() == strict


def test_extensions(spark):
    h = versions(spark, v("a", 100, "2024-01-01"), v("a", 20, "2024-01-08"), v("a", 20, "2024-01-15", active=False))
    assert rows(revenue.churn_at_peak_mrr(h)) == [("a", W[2], 20.0, 100.0)]
    closed = spark.createDataFrame(
        [("a", 20.0, True, ts("2024-01-01"), None, ts("2024-01-01"), ts("2024-01-09")), ("b", 20.0, True, ts("2024-01-01"), None, ts("2024-01-01"), ts("2024-01-09")), ("b", 30.0, True, ts("2024-01-01"), None, ts("2024-01-09"), None)],
        VERSION,
    )
    assert rows(revenue.hard_delete_churn(closed)) == [("a", W[1], 20.0)]
    bars = revenue.revenue_chart(revenue.revenue_movements(h, "2024-01-31")).collect()
    assert [r.week_start for r in bars] == W and bars[1].contraction_bar == -80.0
    assert history.VALID_TO == "dbt_valid_to"


def test_totals_kept_per_run_equal_the_whole_history(spark):
    """Subscriptions that change, stop, vanish and return over random runs, one run repeated."""
    import random

    from revlattice.operators import history
    from revlattice.session import fresh_folder

    schema = (
        "subscription_id string, hubspot_company_id string, company_name string, customer_id string, plan_name string, plan_rank int, "
        "monthly_amount_usd double, subscription_status string, is_active boolean, created_at timestamp, canceled_at timestamp"
    )
    rnd, root = random.Random(8), fresh_folder(spark, "runs")
    prices = {"free": 0.0, "pro": 20.0, "team": 100.0, "enterprise": 1000.0}
    for n in range(8):
        label = f"2024-0{1 + n // 4}-{1 + 7 * (n % 4):02d}"
        now = []
        for s in range(40):
            if rnd.random() < 0.25:
                continue
            plan, active = rnd.choice(list(prices)), rnd.random() < 0.8
            ended = ts(f"{label} 03:00:00") if not active and rnd.random() < 0.5 else None
            now.append((f"s{s}", str(s), "A", "c", plan, 1, prices[plan], "active" if active else "canceled", active, ts("2024-01-01 00:00:00"), ended))
        current = spark.createDataFrame(now, schema)
        for _ in range(2 if n == 5 else 1):
            versions = history.run_snapshot(current, root, label, f"{label} 00:00:00")
            revenue.keep_movements(spark, root, label, f"{label} 00:00:00")
        assert rows(revenue.kept_revenue_movements(spark, root, label, "2024-03-01")) == rows(revenue.revenue_movements(versions, "2024-03-01"))
    # An earlier run's figures can still be had.
    early = revenue.kept_revenue_movements(spark, root, "2024-01-08", "2024-03-01")
    stored = history.read_history(spark, root, "2024-01-08", ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in versions.schema.fields))
    seen = stored.withColumn("dbt_valid_to", F.when(F.col("dbt_valid_to") <= F.lit("2024-01-08").cast("timestamp"), F.col("dbt_valid_to")))
    assert rows(early) == rows(revenue.revenue_movements(seen, "2024-03-01"))


def test_a_run_reads_only_what_it_wrote(spark, tmp_path):
    from revlattice.operators import history

    schema = "subscription_id string, plan_name string, monthly_amount_usd double, subscription_status string, is_active boolean, created_at timestamp, canceled_at timestamp"
    root = str(tmp_path / "runs")
    for label, price in (("2024-01-01", 20.0), ("2024-01-08", 100.0)):
        current = spark.createDataFrame([("s", "pro", price, "active", True, ts("2024-01-01 00:00:00"), None)], schema)
        history.run_snapshot(current, root, label, f"{label} 00:00:00")
        if label > "2024-01-01":
            for file in (tmp_path / "runs" / "run=2024-01-01").rglob("*"):
                if file.is_file():
                    file.unlink()  # not needed any more
        revenue.keep_movements(spark, root, label, f"{label} 00:00:00")
    kept = revenue.kept_revenue_movements(spark, root, "2024-01-08", "2024-01-08")
    assert rows(kept, "new_mrr", "expansion_mrr", "ending_mrr") == [(0.0, 80.0, 100.0), (20.0, 0.0, 20.0)]
