"""Daily facts and logs in committed parts: exact after failures, without reading earlier events."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from revlattice.operators import usage
from revlattice.operators.staging import stg_usage_events
from revlattice.session import fresh_folder
from revlattice.sources import parts, usage_log
from revlattice.streaming import incremental
from tests.conftest import rows, ts
from tests.test_incremental import DAILY, START, frame, make_events


@pytest.fixture(autouse=True)
def many_ranges(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def whole(spark, events):
    return rows(usage.domain_daily_usage(stg_usage_events(frame(spark, events))), *DAILY)


def test_a_batch_reads_no_earlier_event(spark, tmp_path):
    """Earlier events may even be lost: a batch needs the keys of its days only."""
    events, log, daily = make_events(), str(tmp_path / "log"), str(tmp_path / "daily")
    incremental.incremental_daily_usage(frame(spark, events[:70]), log, daily)
    (first,) = (tmp_path / "log" / "events").iterdir()
    for file in first.rglob("*.parquet"):
        file.write_bytes(b"not to be read")
    for file in first.rglob("*.crc"):
        file.unlink()
    incremental.incremental_daily_usage(frame(spark, events[60:]), log, daily)
    assert rows(incremental.read_domain_usage(spark, daily), *DAILY) == whole(spark, events)


@pytest.mark.parametrize("fails", ["keys", "log commit", "sums", "users", "facts commit", "merge"])
def test_a_batch_that_failed_is_made_good_by_repeating_it(spark, tmp_path, monkeypatch, fails):
    events, log, daily = make_events(), str(tmp_path / "log"), str(tmp_path / "daily")
    monkeypatch.setattr(incremental, "MERGE_AT", 2)
    monkeypatch.setattr(incremental.merge_parts, "__defaults__", (2,))
    incremental.incremental_daily_usage(frame(spark, events[:50]), log, daily)
    before = rows(incremental.read_domain_usage(spark, daily), *DAILY)

    class Lost(Exception):
        pass

    def lost(*_, **__):
        raise Lost

    commit = parts.commit

    def commit_but(spark, root, part, level=0, *more, **named):
        if (root, level) == {"log commit": (log, 0), "facts commit": (daily, 0), "merge": (daily, 1)}[fails]:
            raise Lost
        commit(spark, root, part, level, *more, **named)

    with monkeypatch.context() as broken:
        if fails == "keys":
            broken.setattr(usage_log, "_write_keys", lost)
        elif fails == "sums":
            broken.setattr(incremental, "_write_dated", lost)
        elif fails == "users":
            broken.setattr(incremental, "_numbered", lost)
        else:
            broken.setattr(parts, "commit", commit_but)
        with pytest.raises(Lost):
            incremental.incremental_daily_usage(frame(spark, events[40:]), log, daily)
    seen = rows(incremental.read_domain_usage(spark, daily), *DAILY)
    assert seen == (whole(spark, events) if fails == "merge" else before)  # never half a batch
    incremental.incremental_daily_usage(frame(spark, events[40:]), log, daily)
    assert rows(incremental.read_domain_usage(spark, daily), *DAILY) == whole(spark, events)
    assert usage_log.read_usage_log(spark, log).count() == len(events)
    # What the failed job left can go.
    gone = parts.remove_stale(spark, log, ["events", "keys"]) + parts.remove_stale(spark, daily, list(incremental.KINDS))
    assert gone
    assert rows(incremental.read_domain_usage(spark, daily), *DAILY) == whole(spark, events)
    assert usage_log.read_usage_log(spark, log).count() == len(events)


def test_parts_are_merged_by_level(spark, tmp_path):
    events, log, daily = make_events(80), str(tmp_path / "log"), str(tmp_path / "daily")
    for n in range(4):
        usage_log.append_usage_events(frame(spark, events[20 * n : 20 * n + 20]), log)
        incremental.absorb(spark, log, daily)
        incremental.merge_parts(spark, daily, merge_at=2)
    facts = parts.state(spark, daily)
    assert list(facts.active.values()) == [2] and len(facts.covered) == 4
    assert rows(incremental.read_domain_usage(spark, daily), *DAILY) == whole(spark, events)
    before = rows(incremental.read_user_sets(spark, daily).selectExpr("account_domain", "usage_date", "bitmap_count(users) n"))
    incremental.absorb(spark, log, daily)  # nothing new: nothing written
    assert parts.state(spark, daily) == facts
    assert rows(incremental.read_user_sets(spark, daily).selectExpr("account_domain", "usage_date", "bitmap_count(users) n")) == before


def test_a_replaced_log_gives_new_facts(spark, tmp_path):
    log, daily = str(tmp_path / "log"), str(tmp_path / "daily")
    incremental.incremental_daily_usage(frame(spark, make_events(50)), log, daily)
    other = make_events(80, seed=2)
    usage_log.load_usage_backfill(frame(spark, other), log)
    incremental.absorb(spark, log, daily)
    assert rows(incremental.read_domain_usage(spark, daily), *DAILY) == whole(spark, other)
    incremental.incremental_daily_usage(frame(spark, other[:9]), log, daily)  # known already
    assert rows(incremental.read_domain_usage(spark, daily), *DAILY) == whole(spark, other)


def test_windows_of_users_from_daily_sets(spark, tmp_path):
    """Any window, exact: many users of one domain over several ranges, buckets and batches."""
    rng, log, daily = random.Random(9), str(tmp_path / "log"), str(tmp_path / "daily")
    events = [
        (f"e{i}", "prompt_run", "hot.com" if i % 3 else "b.com", None if i % 50 == 0 else f"u{rng.randrange(900)}@x", 1, at, at)
        for i, at in ((i, START + dt.timedelta(hours=rng.randrange(40 * 24))) for i in range(3000))
    ]
    for part in (events[:1000], events[900:2200], events[2200:]):
        incremental.incremental_daily_usage(frame(spark, part), log, daily)
    numbers = spark.read.parquet(f"{daily}/users")
    dense = (F.max("user_no") == F.count("*")) & (F.count_distinct("user_no") == F.count("*"))
    assert {r[1] for r in numbers.groupBy("account_domain").agg(dense).collect()} == {True}
    who = spark.createDataFrame([("1", "hot.com"), ("2", "b.com"), ("3", "none.com")], "hubspot_company_id string, company_domain string")
    got = usage.active_users_by_window(incremental.read_user_sets(spark, daily), who, "2024-02-05", days=(1, 14, 33, 400))
    want = {}
    for _, _, domain, user, _, at, _ in events:
        for n in (1, 14, 33, 400):
            if user and at.date() >= dt.date(2024, 2, 5) - dt.timedelta(days=n):
                want.setdefault(("1" if domain == "hot.com" else "2", domain, n), set()).add(user)
    assert sorted(map(tuple, got.collect())) == sorted((*k, len(v)) for k, v in want.items())
    # The same as the count over events.
    exact = usage.active_users_exact_14d(stg_usage_events(frame(spark, events)), who, "2024-02-05")
    fourteen = got.where("window_days = 14").drop("window_days")
    assert sorted(map(tuple, fourteen.collect())) == sorted(map(tuple, exact.collect()))


def test_user_sets_span_buckets(spark):
    """Numbers beyond one bitmap go to the next; counts add up."""
    sets = (
        spark.range(1, 100_001)
        .select(F.lit("a.com").alias("account_domain"), F.lit("2024-01-30").cast("date").alias("usage_date"), F.col("id").alias("n"))
        .groupBy("account_domain", "usage_date", F.bitmap_bucket_number("n").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("n")).alias("users"))
    )
    assert sets.count() > 3
    who = spark.createDataFrame([("1", "a.com")], "hubspot_company_id string, company_domain string")
    assert rows(usage.active_users_by_window(sets.union(sets), who, "2024-01-31", days=(7,))) == [("1", "a.com", 7, 100_000)]


def test_stream_over_batches_in_any_order(spark, tmp_path):
    """Newest file first: nothing is dropped, and the days come from the stream's state."""
    events = make_events()
    named = sorted((e for e in events if e[2]), key=lambda e: e[5], reverse=True)
    folder = tmp_path / "arrivals"
    for n in range(4):
        frame(spark, named[n::4] if n == 3 else named[n * 20 : n * 20 + 30]).coalesce(1).write.mode("append").parquet(str(folder))
    read = spark.read.schema(usage_log.EVENT_SCHEMA).parquet(str(folder))
    stream = spark.readStream.schema(usage_log.EVENT_SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(folder))
    days = incremental.streaming_daily_usage(stg_usage_events(stream), incremental.ANY_ORDER)
    incremental.write_daily_stream(days, str(tmp_path / "days"), str(tmp_path / "state"), available_now=True).awaitTermination()
    got = incremental.daily_so_far(spark, str(tmp_path / "days"), str(tmp_path / "state"))
    want = usage.domain_daily_usage(stg_usage_events(read.dropDuplicates(["event_id"]))).drop("active_users")
    assert rows(got, *want.columns) == rows(want)


def test_final_and_open_days_of_a_live_stream(spark, tmp_path):
    def event(n, at):
        return (f"e{n}", "prompt_run", "a.com", "u", n, ts(at), ts(at))

    folder = tmp_path / "arrivals"
    for batch in ([event(1, "2024-01-01 10:00:00")], [event(2, "2024-01-05 09:00:00")], [event(2, "2024-01-05 09:00:00"), event(3, "2024-01-06 09:00:00")]):
        frame(spark, batch).coalesce(1).write.mode("append").parquet(str(folder))
    stream = spark.readStream.schema(usage_log.EVENT_SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(folder))
    days = incremental.streaming_daily_usage(stg_usage_events(stream))
    incremental.write_daily_stream(days, str(tmp_path / "days"), str(tmp_path / "state"), available_now=True).awaitTermination()
    final = spark.read.parquet(str(tmp_path / "days"))
    assert rows(final, F.col("usage_date").cast("string"), "total_credits_used") == [("2024-01-01", 1)]
    got = incremental.daily_so_far(spark, str(tmp_path / "days"), str(tmp_path / "state"))
    assert rows(got, F.col("usage_date").cast("string"), "total_credits_used", "total_events") == [
        ("2024-01-01", 1, 1), ("2024-01-05", 2, 1), ("2024-01-06", 3, 1),
    ]
    text = got._jdf.queryExecution().executedPlan().toString()
    assert "arrivals" not in text  # no event file is opened again


def test_nothing_arrived(spark):
    root = fresh_folder(spark, "none")
    incremental.incremental_daily_usage(frame(spark, []), f"{root}/log", f"{root}/daily")
    assert usage_log.read_usage_log(spark, f"{root}/log").count() == 0
    assert incremental.read_user_sets(spark, f"{root}/daily").count() == 0
