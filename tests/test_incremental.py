import datetime as dt
import itertools
import random

import pytest
from pyspark.sql import functions as F

from revlattice.operators.staging import stg_usage_events
from revlattice.operators.usage import domain_daily_usage
from revlattice.sources import usage_log
from revlattice.streaming import incremental
from tests.conftest import rows, ts

START = ts("2024-01-01 00:00:00")


def make_events(n=120, seed=1):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        at = START + dt.timedelta(minutes=rng.randrange(5 * 24 * 60))
        late = dt.timedelta(days=2, hours=10) if i % 10 == 0 else dt.timedelta(seconds=5)
        # A third of all events belongs to one domain.
        domain = "Hot.com" if i % 3 == 0 else rng.choice(["a.com", "b.com", None])
        kind = rng.choice(["prompt_run", "session_started", "teammate_invited"])
        out.append((f"e{i}", kind, domain, f"U{i % 4}@x", i % 7, at, at + late))
    return out


def frame(spark, events):
    return spark.createDataFrame(events, usage_log.EVENT_SCHEMA)


DAILY = ["account_domain", "usage_date", "total_credits_used", "active_users", "sessions", "prompt_runs", "teammates_invited", "total_events"]


@pytest.mark.parametrize("order", list(itertools.permutations(range(3)))[::2])
def test_any_order_of_batches_equals_a_full_recomputation(spark, tmp_path, order):
    events = make_events()
    batches = [events[:50], events[40:90], events[85:]]  # overlapping: some arrive twice
    log, daily = str(tmp_path / "log"), str(tmp_path / "daily")
    for n in (*order, order[-1]):
        incremental.incremental_daily_usage(frame(spark, batches[n]), log, daily)
    whole = domain_daily_usage(stg_usage_events(frame(spark, events)))
    assert rows(incremental.read_domain_usage(spark, daily), *DAILY) == rows(whole, *DAILY)
    assert usage_log.read_usage_log(spark, log).count() == len(events)


def test_untouched_days_are_not_rewritten(spark, tmp_path):
    events = make_events()
    log, daily = str(tmp_path / "log"), tmp_path / "daily"
    incremental.incremental_daily_usage(frame(spark, events), log, str(daily))
    before = {p: p.stat().st_mtime_ns for p in daily.rglob("*.parquet")}
    extra = [("late", "prompt_run", "a.com", "u", 1, ts("2024-01-02 08:00:00"), ts("2024-01-04 18:00:00"))]
    incremental.incremental_daily_usage(frame(spark, extra), log, str(daily))
    after = {p: p.stat().st_mtime_ns for p in daily.rglob("*.parquet")}
    changed = {p.parent.name for p in set(before.items()) ^ set(after.items()) for p in [p[0]]}
    assert changed == {"usage_date=2024-01-02"}


def test_events_without_a_time_are_kept_once(spark, tmp_path):
    log = str(tmp_path / "log")
    odd = frame(spark, [("x", "prompt_run", "a.com", "u", 1, None, None)])
    for _ in range(2):
        assert usage_log.append_usage_events(odd, log) == []
    assert usage_log.read_usage_log(spark, log).count() == 1


def test_backfill_replaces_the_table_and_prunes_by_date(spark, tmp_path):
    path = str(tmp_path / "log")
    for n in (100, 60):
        usage_log.load_usage_backfill(frame(spark, make_events(n)), path)
    log = usage_log.read_usage_log(spark, path)
    assert log.count() == 60 and log.where("occurred_date <> to_date(occurred_at)").count() == 0
    plan = log.where("occurred_date = date'2024-01-02'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(occurred_date" in plan


def source(spark, tmp_path, batches):
    """A folder of files, read one per micro-batch in order."""
    folder = tmp_path / "arrivals"
    for n, batch in enumerate(batches):
        frame(spark, batch).coalesce(1).write.mode("append").parquet(str(folder))
    schema = usage_log.EVENT_SCHEMA
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(folder))


def test_stream_of_arrivals_keeps_daily_facts_exact(spark, tmp_path):
    events = make_events()
    log, daily = str(tmp_path / "log"), str(tmp_path / "daily")
    arrivals = source(spark, tmp_path, [events[:70], events[60:]])
    query = incremental.follow_arrivals(arrivals, log, daily, str(tmp_path / "state"), available_now=True)
    query.awaitTermination()
    whole = domain_daily_usage(stg_usage_events(frame(spark, events)))
    assert rows(incremental.read_domain_usage(spark, daily), *DAILY) == rows(whole, *DAILY)


def test_streaming_days_wait_for_late_events(spark, tmp_path):
    def event(n, at):
        return (f"e{n}", "prompt_run", "a.com", "u", 1, ts(at), ts(at))

    batches = [
        [event(1, "2024-01-01 10:00:00"), event(1, "2024-01-01 10:00:00"), event(2, "2024-01-03 09:00:00")],
        [event(3, "2024-01-01 23:00:00")],  # 34 hours behind: still counted
        [event(4, "2024-01-04 10:00:01")],  # now the first day is final
        [event(6, "2024-01-04 12:00:00")],
        [event(5, "2024-01-01 12:00:00")],  # too late for it
    ]
    daily = incremental.streaming_daily_usage(stg_usage_events(source(spark, tmp_path, batches)))
    query = incremental.write_daily_stream(daily, str(tmp_path / "days"), str(tmp_path / "state"), available_now=True)
    query.awaitTermination()
    out = spark.read.parquet(str(tmp_path / "days"))
    assert rows(out, "account_domain", F.col("usage_date").cast("string"), "total_credits_used", "total_events") == [
        ("a.com", "2024-01-01", 2, 2)
    ]


def test_stream_with_open_days_is_whole(spark, tmp_path):
    """Final days from the stream, open ones from the log: ids once, rows without an id kept, and
    equal to one pass over all events. The source is a folder of files."""
    from pyspark.sql import functions as F

    from revlattice.session import apply_rules
    from revlattice.streaming import incremental

    apply_rules(spark)
    columns = "event_id string, event_type string, account_domain string, user_email string, credits_used bigint, occurred_at timestamp"
    sql = """SELECT * FROM VALUES ('1', 'prompt_run', 'a.com', 'u', 5, '2024-01-01 10:00:00'), ('1', 'prompt_run', 'a.com', 'u', 5, '2024-01-01 10:00:00'),
        (null, 'prompt_run', 'a.com', 'u', 7, '2024-01-01 11:00:00'), (null, 'prompt_run', 'a.com', 'v', 2, '2024-01-01 11:00:00'),
        ('2', 'session_started', 'b.com', 'u', 1, '2024-01-09 10:00:00'), ('3', 'session_started', 'b.com', 'u', 1, '2024-01-10 10:00:00'),
        ('3', 'session_started', 'b.com', 'u', 1, '2024-01-10 10:00:00')"""
    rows = spark.sql(sql).toDF("event_id", "event_type", "account_domain", "user_email", "credits_used", "occurred_at")
    rows = rows.selectExpr("event_id", "event_type", "account_domain", "user_email", "cast(credits_used as bigint) credits_used", "cast(occurred_at as timestamp) occurred_at")
    rows.repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    stream = spark.readStream.schema(columns).parquet(str(tmp_path / "[e]vents.parquet"))
    incremental.write_daily_stream(
        incremental.streaming_daily_usage(stream), str(tmp_path / "days"), str(tmp_path / "state"), available_now=True
    ).awaitTermination()
    final = spark.read.parquet(str(tmp_path / "days"))
    assert [tuple(r) for r in final.select("account_domain", "total_credits_used").collect()] == [("a.com", 14)]
    got = incremental.with_open_days(final, rows).select(F.col("usage_date").cast("string"), "account_domain", "total_credits_used")
    assert sorted(map(tuple, got.collect())) == [("2024-01-01", "a.com", 14), ("2024-01-09", "b.com", 1), ("2024-01-10", "b.com", 1)]
    assert incremental.with_open_days(final, rows.limit(0)).count() == 1
