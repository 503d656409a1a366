"""Keeping daily usage up to date as events arrive, late ones included."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from revlattice.functions.ordered import RANGE, carried_before, in_ranges
from revlattice.functions.skew import attach_unique
from revlattice.operators.staging import stg_usage_events
from revlattice.operators.usage import EVENT_COUNTS, event_counts
from revlattice.session import store
from revlattice.sources import parts
from revlattice.sources.usage_log import append_usage_events, event_key, read_usage_log

# Fixed value: how late an event can be, two days and ten hours.
LATEST_ARRIVAL = "58 hours"
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

DAILY_SCHEMA = (
    "account_domain string, total_credits_used bigint, active_users bigint, sessions bigint, "
    "prompt_runs bigint, projects_created bigint, teammates_invited bigint, "
    "projects_published bigint, total_events bigint, usage_date date"
)
SUMS = ["total_credits_used", *EVENT_COUNTS.values(), "total_events"]
STREAM_SCHEMA = f"account_domain string, usage_date date, {', '.join(f'{c} bigint' for c in SUMS)}"
#: A lateness that no event exceeds.
ANY_ORDER = "36500 days"
#: The kinds of a part of the daily facts; `users` numbers the users of each domain, 1, 2, ..., and has
#: the first of the days on which a part came upon them.
KINDS = {
    "sums": f"account_domain string, {', '.join(f'{c} bigint' for c in SUMS)}, usage_date date",
    "user_sets": "account_domain string, bucket bigint, users binary, usage_date date",
    "users": "account_domain string, user_email string, user_no bigint, usage_date date",
}
#: So many parts of a level are merged into one of the next.
MERGE_AT = 8


def read_domain_usage(spark: SparkSession, daily_path: str) -> DataFrame:
    """Daily facts per domain: what the parts hold of a day, added up.

    A date filter reaches the scans. A folder without commits is read as one that holds the facts
    themselves.
    """
    active = list(parts.state(spark, daily_path).active)
    if not active:
        return spark.read.schema(DAILY_SCHEMA).parquet(daily_path)
    columns = [f.split()[0] for f in DAILY_SCHEMA.split(", ")]
    both = _read(spark, daily_path, "sums", active).unionByName(
        _read(spark, daily_path, "user_sets", active), allowMissingColumns=True
    )
    # Sets first, of a third of all users in many buckets; then one row per domain and day.
    merged = both.groupBy("account_domain", "usage_date", "bucket").agg(
        *[F.sum(c).alias(c) for c in SUMS], F.bitmap_count(F.bitmap_or_agg("users")).alias("active_users")
    )
    totals = merged.groupBy("account_domain", "usage_date").agg(
        *[F.sum(c).alias(c) for c in SUMS], F.sum(F.when(F.col("bucket").isNotNull(), F.col("active_users")).otherwise(0)).alias("active_users")
    )
    return totals.select(*columns)


def read_user_sets(spark: SparkSession, daily_path: str) -> DataFrame:
    """(account_domain, usage_date, bucket, users): who used the product, as bitmaps of user
    numbers that can be merged over any days. A domain-day has one or more rows a bucket."""
    return _read(spark, daily_path, "user_sets", list(parts.state(spark, daily_path).active))


def _read(spark: SparkSession, daily_path: str, kind: str, active: list[str]) -> DataFrame:
    return parts.read(spark, daily_path, kind, KINDS[kind], active)


def absorb(spark: SparkSession, events_path: str, daily_path: str) -> None:
    """Bring the daily facts up to the event log: read its parts that they do not hold yet, and no other.

    What new events add to their days is written beside what is there, and counts once it is
    committed, so a run that failed at any point is made good by the next. If the log was
    replaced, the facts are made anew.
    """
    log, facts = parts.state(spark, events_path), parts.state(spark, daily_path)
    replaced = not facts.covered <= log.active.keys()
    fresh = [p for p in log.active if replaced or p not in facts.covered]
    if not fresh and not replaced:
        return
    part, kept = parts.new_part(), [] if replaced else list(facts.active)
    _write_facts(stg_usage_events(read_usage_log(spark, events_path, fresh)), daily_path, part, kept)
    parts.commit(spark, daily_path, part, covers=fresh, replaces=list(facts.active) if replaced else [])
    merge_parts(spark, daily_path)


def _write_facts(events: DataFrame, daily_path: str, part: str, kept: list[str]) -> None:
    """The facts of `events` as a part; users that the parts `kept` know keep their numbers."""
    spark = events.sparkSession
    named = events.where(F.col("account_domain").isNotNull()).withColumn("usage_date", F.to_date("occurred_at"))
    sums = named.groupBy("account_domain", "usage_date").agg(
        F.sum("credits_used").alias("total_credits_used"), *event_counts(), F.count("*").alias("total_events")
    )
    _write_dated(sums, daily_path, "sums", part)
    used = named.where(F.col("user_email").isNotNull()).select("account_domain", "usage_date", "user_email").distinct()
    used = store(used, "users-of-days")
    who = ["account_domain", "user_email"]
    known = _read(spark, daily_path, "users", kept)
    found = used.groupBy(*who).agg(F.min("usage_date").alias("usage_date"))
    _write_dated(_numbered(found.join(known.select(*who), who, "left_anti"), known), daily_path, "users", part)
    numbers = known.unionByName(_read(spark, daily_path, "users", [part])).select(*who, "user_no")
    at = F.col("user_no")
    sets = used.join(numbers, who).groupBy(
        "account_domain", "usage_date", F.bitmap_bucket_number(at).alias("bucket")
    ).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("users"))
    _write_dated(sets, daily_path, "user_sets", part)


def _write_dated(df: DataFrame, daily_path: str, kind: str, part: str) -> None:
    # Rebalancing by date gives files of a good size: few per day, large days split.
    dated = df.hint("rebalance", "usage_date").write.partitionBy("usage_date")
    dated.parquet(parts.folder(daily_path, kind, part))


def _numbered(new: DataFrame, known: DataFrame) -> DataFrame:
    """Distinct `new` users with the numbers after those their domain has given out.

    Users are numbered within ranges of (domain, user), so a domain with very many is no single task.
    """
    ranged = in_ranges(new, "account_domain", "user_email")
    within = F.row_number().over(W.partitionBy(RANGE, "account_domain").orderBy("user_email"))
    before = carried_before(ranged, "account_domain", earlier=(F.count("*"), F.sum))
    given = known.groupBy("account_domain").agg(F.max("user_no").alias("given"))
    placed = ranged.withColumn("within", within).join(before, [RANGE, "account_domain"], "left")
    # Spread over its ranges, a large domain meets its one row of `given`.
    placed = attach_unique(placed, "account_domain", given, "account_domain")
    number = F.col("within") + F.coalesce("earlier", F.lit(0)) + F.coalesce("given", F.lit(0))
    return placed.select("account_domain", "user_email", number.alias("user_no"), "usage_date")


def merge_parts(spark: SparkSession, daily_path: str, merge_at: int = MERGE_AT) -> None:
    """Merge parts once there are `merge_at` of a level, so that readers open few.

    A fact is rewritten once per level, and levels grow with the logarithm of the batches.
    """
    facts = parts.state(spark, daily_path)
    for level in sorted(set(facts.active.values())):
        old = [p for p, at in facts.active.items() if at == level]
        if len(old) < merge_at:
            continue
        part, covers = parts.new_part(), [c for p in old for c in facts.covers[p]]
        sums = _read(spark, daily_path, "sums", old).groupBy("account_domain", "usage_date")
        _write_dated(sums.agg(*[F.sum(c).alias(c) for c in SUMS]), daily_path, "sums", part)
        sets = _read(spark, daily_path, "user_sets", old).groupBy("account_domain", "usage_date", "bucket")
        _write_dated(sets.agg(F.bitmap_or_agg("users").alias("users")), daily_path, "user_sets", part)
        _write_dated(_read(spark, daily_path, "users", old), daily_path, "users", part)
        parts.commit(spark, daily_path, part, level + 1, covers, old)
        return merge_parts(spark, daily_path, merge_at)


def incremental_daily_usage(
    batch: DataFrame, events_path: str, daily_path: str, watch: Callable[[DataFrame], DataFrame] | None = None
) -> None:
    """Append one batch of arrivals and add what it brings to the daily facts per domain.

    No earlier event is read: sums are added to sums and sets of users merged with sets, when the
    facts are read. Event dates decide where an event counts, however late it is; events without a time
    are a date of their own. A batch may be repeated, and one that failed half-way is made good by
    repeating it: afterwards the facts equal a full recomputation. They are kept per domain
    and attributed to accounts when read, so a later match also gets the past days.
    """
    append_usage_events(batch, events_path, watch=watch)
    absorb(batch.sparkSession, events_path, daily_path)


def follow_arrivals(
    arrivals: DataFrame,
    events_path: str,
    daily_path: str,
    checkpoint: str,
    available_now: bool = False,
) -> StreamingQuery:
    """Run `incremental_daily_usage` on every micro-batch of a stream of raw events."""

    def on_batch(batch: DataFrame, _batch_id: int) -> None:
        # Read once: the batch is used for its dates and again for the append.
        incremental_daily_usage(store(batch, "arrivals"), events_path, daily_path)

    writer = arrivals.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def streaming_daily_usage(arrivals: DataFrame, lateness: str = LATEST_ARRIVAL) -> DataFrame:
    """Daily facts per domain as a stream: a day is final once `lateness` has passed.

    Repeated events are dropped within that time; those without an id are told apart by all
    their columns. An event that lies further behind an earlier batch is dropped, so a backlog in files of
    any order takes `lateness` as long as the time it spans (`ANY_ORDER`): its days stay open until all of it
    is read. Distinct users are not available to a streaming aggregate;
    `incremental_daily_usage` has them exactly. `daily_so_far` has the open days as well.
    """
    once = (
        _timed(arrivals)
        .withWatermark("occurred_at", lateness)
        .dropDuplicatesWithinWatermark(["event_key"])
    )
    return _per_day(once)


def daily_so_far(spark: SparkSession, path: str, checkpoint: str) -> DataFrame:
    """All days of a `write_daily_stream` as of its last batch: the final ones it has put out, and the open
    ones, which are read from its own state. No event is read again.

    A stream that runs on may put out a day between the two reads; ask while it is stopped.
    """
    try:
        final = spark.read.schema(STREAM_SCHEMA).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        final = spark.createDataFrame([], STREAM_SCHEMA)
    operators = spark.read.format("state-metadata").load(checkpoint).where("operatorName = 'stateStoreSave'")
    found = operators.agg(F.max("operatorId")).first()[0]
    if found is None:
        return final
    state = spark.read.format("statestore").option("operatorId", found).load(checkpoint)
    # The state holds the sums by position, in the order of the aggregates.
    sums = F.col("value").cast(f"struct<{','.join(f'{c}:bigint' for c in SUMS)}>")
    still_open = state.select(
        F.col("key.account_domain").alias("account_domain"), F.to_date(F.col("key")[state.schema["key"].dataType.names[0]]["start"]).alias("usage_date"), sums.alias("s")
    )
    return final.unionByName(still_open.select("account_domain", "usage_date", "s.*"))


def with_open_days(final: DataFrame, events: DataFrame, lateness: str = LATEST_ARRIVAL) -> DataFrame:
    """`final`, what the stream has put out by its end, and the days it still held open, from
    `events`, all that it has read. Only events of the open days are aggregated."""
    timed = _timed(events)
    mark = timed.agg(F.max("occurred_at").alias("latest")).select(F.expr(f"latest - interval {lateness}")).first()[0]
    if mark is None:
        return final
    still_open = F.date_add(F.to_date("occurred_at"), 1).cast("timestamp") > F.lit(mark)
    return final.unionByName(_per_day(timed.where(still_open).dropDuplicates(["event_key"])))


def _timed(events: DataFrame) -> DataFrame:
    return events.withColumn("event_key", event_key(events.columns)).withColumn(
        "occurred_at", F.col("occurred_at").cast("timestamp")
    )


def _per_day(events: DataFrame) -> DataFrame:
    return (
        events.where(F.col("account_domain").isNotNull())
        .groupBy(F.window("occurred_at", "1 day").alias("day"), "account_domain")
        .agg(
            F.sum("credits_used").alias("total_credits_used"),
            *event_counts(),
            F.count("*").alias("total_events"),
        )
        .select(
            "account_domain",
            F.to_date("day.start").alias("usage_date"),
            "total_credits_used",
            "sessions",
            "prompt_runs",
            "projects_created",
            "teammates_invited",
            "projects_published",
            "total_events",
        )
    )


def write_daily_stream(
    daily: DataFrame, path: str, checkpoint: str, available_now: bool = False
) -> StreamingQuery:
    """Append finished days to a parquet folder. State is kept in RocksDB, not on the heap."""
    spark, provider = daily.sparkSession, "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider, None)
    writer = (
        daily.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    # A query takes the session's settings when it starts.
    spark.conf.set(provider, STATE_STORE)
    try:
        return writer.start()
    finally:
        if before is None:
            spark.conf.unset(provider)
        else:
            spark.conf.set(provider, before)
