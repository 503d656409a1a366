"""Subscription history: one row per version, with the time it was valid.

A version is closed when a checked column changes or when the key is gone from a run;
a key that comes back starts a new version. `dbt_valid_to` is NULL while it is open.
"""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from revlattice.functions.dates import AsOf, as_day
from revlattice.functions.ordered import with_next

KEY = "subscription_id"
VALID_FROM, VALID_TO = "dbt_valid_from", "dbt_valid_to"

# What a snapshot keeps, and which of it opens a new version when it changes.
SNAPSHOT_COLUMNS = [
    "subscription_id",
    "hubspot_company_id",
    "company_name",
    "customer_id",
    "plan_name",
    "plan_rank",
    "monthly_amount_usd",
    "subscription_status",
    "is_active",
    "created_at",
    "canceled_at",
]
CHECK_COLUMNS = ["plan_name", "monthly_amount_usd", "subscription_status", "is_active"]


def _moment(when: dt.datetime | str | Column) -> Column:
    return (when if isinstance(when, Column) else F.lit(when)).cast("timestamp")


def snapshot_input(account_subscriptions: DataFrame) -> DataFrame:
    """Today's state in snapshot shape."""
    return account_subscriptions.where(F.col(KEY).isNotNull()).select(*SNAPSHOT_COLUMNS)


def _one_per_key(current: DataFrame, payload: list[str]) -> DataFrame:
    """(key, now): fails the job if a key occurs twice, as a keyed merge would.

    Copies of a key are reduced before the shuffle, and the result is already
    partitioned for the join that follows.
    """
    twice = F.concat(F.lit("snapshot key occurs more than once: "), F.col(KEY))
    return (
        current.where(F.col(KEY).isNotNull())
        .groupBy(KEY)
        .agg(F.first(F.struct(*payload)).alias("now"), F.count("*").alias("copies"))
        .select(
            F.col(KEY).alias("now_key"),
            F.when(F.col("copies") > 1, F.raise_error(twice).cast("string")).alias("problem"),
            "now",
        )
        # Reading `problem` here keeps the check from being pruned away.
        .where(F.col("problem").isNull())
        .drop("problem")
    )


def snapshot_step(
    open_versions: DataFrame,
    current: DataFrame,
    run_at: dt.datetime | str | Column,
    check_columns: list[str] = CHECK_COLUMNS,
) -> DataFrame:
    """One snapshot run over the open versions: kept, closed and newly opened rows.

    Both sides hold one row per key. Closed versions take no part and are never shuffled.
    """
    payload = [c for c in open_versions.columns if c not in (KEY, VALID_FROM, VALID_TO)]
    run = _moment(run_at)
    before = open_versions.select(
        F.col(KEY).alias("old_key"),
        F.struct(*payload).alias("old"),
        F.col(VALID_FROM).alias("since"),
    )
    paired = before.join(
        _one_per_key(current, payload), F.col("old_key") == F.col("now_key"), "full_outer"
    )

    same = F.lit(True)
    for c in check_columns:
        same = same & F.col(f"old.{c}").eqNullSafe(F.col(f"now.{c}"))
    was_open, is_present = F.col("old_key").isNotNull(), F.col("now_key").isNotNull()
    unchanged = was_open & is_present & same

    def version(key: str, values: str, since: Column, until: Column) -> Column:
        return F.struct(
            F.col(key).alias("key"),
            F.col(values).alias("values"),
            since.cast("timestamp").alias("since"),
            until.cast("timestamp").alias("until"),
        )

    forever = F.lit(None)
    old_row = version("old_key", "old", F.col("since"), F.when(unchanged, forever).otherwise(run))
    new_row = version("now_key", "now", run, forever)
    rows = F.array(F.when(was_open, old_row), F.when(is_present & ~unchanged, new_row))
    return (
        paired.select(F.explode(rows).alias("v"))
        .where(F.col("v").isNotNull())
        .select(
            F.col("v.key").alias(KEY),
            *[F.col(f"v.values.{c}").alias(c) for c in payload],
            F.col("v.since").alias(VALID_FROM),
            F.col("v.until").alias(VALID_TO),
        )
    )


def scd2_snapshot_apply(
    history: DataFrame,
    current: DataFrame,
    run_at: dt.datetime | str | Column,
    check_columns: list[str] = CHECK_COLUMNS,
) -> DataFrame:
    """The whole history after one snapshot run."""
    closed = history.where(F.col(VALID_TO).isNotNull())
    still_open = history.where(F.col(VALID_TO).isNull())
    return closed.unionByName(snapshot_step(still_open, current, run_at, check_columns))


def empty_history(current: DataFrame) -> DataFrame:
    """A history without rows, in the shape `current` will give it."""
    none = F.lit(None).cast("timestamp")
    return current.where(F.lit(False)).select("*", none.alias(VALID_FROM), none.alias(VALID_TO))


# Stored form: <root>/run=<label>/is_open=<true|false>. Each run writes the versions open
# after it and the versions it closed. Older closed versions are never rewritten, no path
# is overwritten while read, and repeating a run replaces only that run's folder.


def write_snapshot_run(step: DataFrame, root: str, run_label: str) -> None:
    (
        step.withColumn("is_open", F.col(VALID_TO).isNull())
        .write.mode("overwrite")
        .partitionBy("is_open")
        .parquet(f"{root}/run={run_label}")
    )


def read_history(spark: SparkSession, root: str, run_label: str, schema: str) -> DataFrame:
    """History as it stood after the run `run_label`; partition pruning skips the rest."""
    stored = spark.read.schema(f"{schema}, run string, is_open boolean").parquet(root)
    latest_open = F.col("is_open") & (F.col("run") == run_label)
    closed_so_far = ~F.col("is_open") & (F.col("run") <= run_label)
    return stored.where(latest_open | closed_so_far).drop("run", "is_open")


def latest_run_before(spark: SparkSession, root: str, run_label: str) -> str | None:
    """The greatest stored run label below `run_label`; reads file footers only."""
    try:
        stored = spark.read.schema("run string, is_open boolean").parquet(root)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return stored.where(F.col("run") < run_label).agg(F.max("run")).first()[0]


def run_snapshot(
    current: DataFrame,
    root: str,
    run_label: str,
    run_at: dt.datetime | str,
    previous_run: str | None = None,
) -> DataFrame:
    """One stored snapshot run; run labels must sort in run order. Returns the history.

    It goes on from the latest stored run before `run_label`. `previous_run` need not be given;
    if it is, it must be that run.
    """
    spark = current.sparkSession
    empty = empty_history(current)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in empty.schema.fields)
    before = latest_run_before(spark, root, run_label)
    if previous_run is not None and previous_run != before:
        raise ValueError(f"the latest run before {run_label} is {before}, not {previous_run}")
    if before is None:
        open_versions = empty
    else:
        open_versions = read_history(spark, root, before, schema).where(
            F.col(VALID_TO).isNull()
        )
    write_snapshot_run(snapshot_step(open_versions, current, run_at), root, run_label)
    return read_history(spark, root, run_label, schema)


def scd2_from_daily_states(
    states: DataFrame,
    state_at: str = "state_at",
    check_columns: list[str] = CHECK_COLUMNS,
    detect_deletes: bool = True,
) -> DataFrame:
    """All versions in one pass from dated states, one per key and run.

    With `detect_deletes` the distinct times are the run calendar, and a key missing from
    the run after its state is closed at that run; without, a state lasts until the next. The times may
    be days or moments, and as many as there are states: the calendar is ordered in ranges.
    A key has at most one row per run, which bounds the window groups.
    """
    payload = [c for c in states.columns if c not in (KEY, state_at)]
    dated = states.where(F.col(KEY).isNotNull()).withColumn("at", _moment(F.col(state_at)))
    if detect_deletes:
        calendar = with_next(dated.select("at").distinct(), "at").select("at", F.col("next.at").alias("next_run"))
        dated = dated.join(calendar, "at")
    per_key = W.partitionBy(KEY).orderBy("at")

    seen_next = F.lead("at").over(per_key)
    checked = F.struct(*check_columns)
    if detect_deletes:
        vanishes = F.col("next_run").isNotNull() & ~F.col("seen_next").eqNullSafe(F.col("next_run"))
        gone_at = F.when(vanishes, F.col("next_run"))
    else:
        gone_at = F.lit(None).cast("timestamp")

    looked = dated.select(
        KEY,
        *payload,
        "at",
        *(["next_run"] if detect_deletes else []),
        checked.alias("checked"),
        seen_next.alias("seen_next"),
        F.lead(checked).over(per_key).alias("checked_next"),
    ).withColumn("gone_at", gone_at)
    changes = F.col("seen_next").isNotNull() & ~F.col("checked").eqNullSafe(F.col("checked_next"))
    ended = looked.withColumn(
        "ends_at", F.coalesce("gone_at", F.when(changes, F.col("seen_next")))
    ).withColumn("row_no", F.row_number().over(per_key))
    # A row opens a version if it is the key's first or the row before it ended one.
    opened = ended.withColumn(
        "opens",
        (F.col("row_no") == 1) | F.lag(F.col("ends_at").isNotNull()).over(per_key),
    )
    # Between an opening row and the ending row of the same version lie only
    # unremarkable rows; once those are gone, the end is on the row itself or the next.
    edges = opened.where(F.col("opens") | F.col("ends_at").isNotNull())
    return (
        edges.withColumn(
            "until", F.coalesce("ends_at", F.lead("ends_at").over(per_key))
        )
        .where("opens")
        .select(KEY, *payload, F.col("at").alias(VALID_FROM), F.col("until").alias(VALID_TO))
    )


def scd2_as_of(history: DataFrame, moment: dt.datetime | str | Column) -> DataFrame:
    """The version of every key in force at one instant."""
    at = _moment(moment)
    return history.where(
        (F.col(VALID_FROM) <= at) & (F.col(VALID_TO).isNull() | (F.col(VALID_TO) > at))
    )


def scd2_as_of_join(
    facts: DataFrame,
    fact_time: str,
    history: DataFrame,
    version_columns: list[str],
    as_of: AsOf = None,
    fact_key: str = KEY,
    period: str = "year",
) -> DataFrame:
    """Each fact with the version in force at its own time; facts without one keep NULLs.

    The join runs on (key, period): a version is listed under each period it touches, so a
    key's facts are spread over the periods and meet only that period's versions. `period`
    is year, quarter or month: shorter ones mean fewer comparisons for keys that change
    often, and more listings of versions that last. Periods after `as_of` count as its
    own, which keeps open versions finite and loses nothing.
    """
    step = {"year": "INTERVAL 1 YEAR", "quarter": "INTERVAL 3 MONTHS", "month": "INTERVAL 1 MONTH"}
    last = F.trunc(as_day(as_of), period)

    def period_of(moment: Column) -> Column:
        return F.least(F.trunc(F.to_date(moment), period), last)

    first = period_of(F.col(VALID_FROM))
    final = period_of(F.coalesce(F.col(VALID_TO), last.cast("timestamp")))
    listed = history.select(
        F.col(KEY).alias("v_key"),
        *[F.col(c).alias(f"v_{c}") for c in version_columns],
        F.col(VALID_FROM).alias("v_from"),
        F.col(VALID_TO).alias("v_to"),
        F.explode(F.sequence(first, F.greatest(first, final), F.expr(step[period]))).alias("v_period"),
    )
    at = F.col(fact_time)
    in_force = (
        (F.col("fact_key") == F.col("v_key"))
        & (F.col("fact_period") == F.col("v_period"))
        & (F.col("v_from") <= at)
        & (F.col("v_to").isNull() | (F.col("v_to") > at))
    )
    dated = facts.withColumn("fact_key", F.col(fact_key)).withColumn("fact_period", period_of(at))
    return dated.join(listed, in_force, "left").select(
        *facts.columns,
        *[F.col(f"v_{c}").alias(f"version_{c}") for c in version_columns],
        F.col("v_from").alias(VALID_FROM),
        F.col("v_to").alias(VALID_TO),
    )
