"""The usage event table: parts partitioned by the UTC date an event happened.

Each append is a part with the events and, apart from them, their keys, which later appends are held against.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revlattice.sources import parts

EVENT_COLUMNS = [
    "event_id",
    "event_type",
    "account_domain",
    "user_email",
    "credits_used",
    "occurred_at",
    "ingested_at",
]
EVENT_SCHEMA = (
    "event_id string, event_type string, account_domain string, user_email string, "
    "credits_used bigint, occurred_at timestamp, ingested_at timestamp"
)
KEY_SCHEMA = "event_hash binary, occurred_date date"


def read_usage_log(spark: SparkSession, table_path: str, only: list[str] | None = None) -> DataFrame:
    """All committed events (or those of some parts), with `occurred_date` for partition pruning."""
    chosen = list(parts.state(spark, table_path).active) if only is None else only
    return parts.read(spark, table_path, "events", f"{EVENT_SCHEMA}, occurred_date date", chosen)


def _dated(events: DataFrame) -> DataFrame:
    return events.select(*EVENT_COLUMNS, F.to_date("occurred_at").alias("occurred_date"))


def touched_days(events: DataFrame) -> list:
    """The distinct event dates of a batch, None for events without a time: at most one value
    per calendar day."""
    days = [row.d for row in events.select(F.to_date("occurred_at").alias("d")).distinct().collect()]
    return sorted(d for d in days if d is not None) + [None] * (None in days)


def on_days(days: list, column: str = "occurred_date") -> Column:
    """Whether a row is of one of the days of `touched_days`."""
    found = F.col(column).isin([d for d in days if d is not None])
    return (found | F.col(column).isNull()) if None in days else found


def event_key(columns: list[str] = EVENT_COLUMNS) -> Column:
    """What tells events apart: the id, or without one everything that is known of the event."""
    content = F.md5(F.to_json(F.struct(*columns)))
    return F.coalesce(F.concat(F.lit("id:"), "event_id"), F.concat(F.lit("content:"), content))


def event_hash() -> Column:
    """`event_key` in 16 bytes."""
    return F.unhex(F.md5(event_key()))


def load_usage_backfill(events: DataFrame, table_path: str) -> None:
    """Replace the whole table, in event-time order.

    The event id is part of the range key, so one very busy instant can still be split. Readers see
    the old table until the new one is committed.
    """
    spark, part = events.sparkSession, parts.new_part()
    (
        _dated(events)
        .repartitionByRange("occurred_date", "occurred_at", "event_id")
        .sortWithinPartitions("occurred_date", "occurred_at", "event_id")
        .write.partitionBy("occurred_date")
        .parquet(parts.folder(table_path, "events", part))
    )
    _write_keys(spark, table_path, part)
    parts.commit(spark, table_path, part, replaces=list(parts.state(spark, table_path).active))


def append_usage_events(
    events: DataFrame, table_path: str, days: list | None = None, watch: Callable[[DataFrame], DataFrame] | None = None
) -> list:
    """Append a batch and return the event dates it touched.

    `days` are its `touched_days` where the caller has them already. `watch` is put over the rows as they
    are written, see `quality.Watch`.

    Safe to run again with the same batch, also after a failure at any point: events already in the
    touched dates are left out, and an append counts as a whole or not at all. To tell
    them, only the keys of those dates are read, never the events. Of rows that share an event id
    the one ingested first stays. Events without an id are told apart by all their columns; events
    without a time are a date of their own.
    """
    spark, days = events.sparkSession, touched_days(events) if days is None else days
    dated = _dated(events)
    first = F.struct("ingested_at", F.to_json(F.struct(*EVENT_COLUMNS)))
    batch = (
        dated.groupBy(event_hash().alias("event_hash"))
        .agg(F.min_by(F.struct(*dated.columns), first).alias("event"))
        .select("event_hash", "event.*")
    )
    known = parts.state(spark, table_path)
    present = parts.read(spark, table_path, "keys", KEY_SCHEMA, list(known.active)).where(on_days(days))
    batch = batch.join(present.select("event_hash"), "event_hash", "left_anti")
    # Late events touch several dates: without rebalancing every task would write a small
    # file to each of them.
    part = parts.new_part()
    dealt = batch.drop("event_hash").hint("rebalance", "occurred_date")
    written = watch(dealt) if watch else dealt
    written.write.partitionBy("occurred_date").parquet(parts.folder(table_path, "events", part))
    if not read_usage_log(spark, table_path, [part]).isEmpty():
        _write_keys(spark, table_path, part)
        parts.commit(spark, table_path, part)
    return [d for d in days if d is not None]


def _write_keys(spark: SparkSession, table_path: str, part: str) -> None:
    """The keys of a part's events, beside them."""
    rows = read_usage_log(spark, table_path, [part]).select(event_hash().alias("event_hash"), "occurred_date")
    rows.hint("rebalance", "occurred_date").write.partitionBy("occurred_date").parquet(
        parts.folder(table_path, "keys", part)
    )
