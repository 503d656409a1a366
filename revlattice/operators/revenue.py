"""Weekly revenue movements, from subscription history."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from revlattice.functions.dates import AsOf, as_day, week_start
from revlattice.functions.values import cents, sum_usd
from revlattice.operators.history import KEY, VALID_FROM, VALID_TO, latest_run_before
from revlattice.session import store

# Kind of movement -> columns of its money and its count.
MONEY = {
    "new": "new_mrr",
    "expansion": "expansion_mrr",
    "contraction": "contraction_mrr",
    "churn": "churned_mrr",
}
COUNTS = {
    "new": "new_accounts",
    "expansion": "upgrades",
    "contraction": "downgrades",
    "churn": "churned_accounts",
}


def subscription_versions_with_prev(history: DataFrame) -> DataFrame:
    """Each version beside the one before it; one sort serves all three window functions."""
    w = W.partitionBy(KEY).orderBy(VALID_FROM)
    return history.select(
        KEY,
        "monthly_amount_usd",
        "is_active",
        "created_at",
        "canceled_at",
        VALID_FROM,
        F.lag("monthly_amount_usd").over(w).alias("previous_amount"),
        F.lag("is_active").over(w).alias("previous_is_active"),
        F.row_number().over(w).alias("rn"),
    )


def _is_start():
    return (F.col("rn") == 1) & F.col("is_active")


def _is_cancellation():
    return F.col("previous_is_active") & ~F.col("is_active") & (F.col("monthly_amount_usd") > 0)


def _cancel_week():
    return week_start(F.coalesce("canceled_at", VALID_FROM))


def _change_kind():
    """The one kind a price change is, or NULL if it is none."""
    new, old = F.col("monthly_amount_usd"), F.col("previous_amount")
    kind = (
        F.when((old == 0) & (new > 0), "new")
        .when((old > 0) & (new > old), "expansion")
        .when((new > 0) & (new < old), "contraction")
        .when((old > 0) & (new == 0), "churn")
    )
    return F.when((F.col("rn") > 1) & old.isNotNull() & (new != old), kind)


def _change_amount():
    """The difference; for new and churned, whose other price is 0, that is the whole price."""
    return F.abs(F.col("monthly_amount_usd") - F.col("previous_amount"))


def subscription_starts(versions: DataFrame) -> DataFrame:
    """Subscriptions first seen active, free ones included, by the week they were created."""
    return versions.where(_is_start()).select(
        KEY, week_start(F.col("created_at")).alias("week_start"), F.col("monthly_amount_usd").alias("amount")
    )


def price_changes_classified(versions: DataFrame) -> DataFrame:
    return versions.where(_change_kind().isNotNull()).select(
        KEY,
        week_start(F.col(VALID_FROM)).alias("week_start"),
        _change_kind().alias("kind"),
        _change_amount().alias("amount"),
    )


def cancellations(versions: DataFrame) -> DataFrame:
    return versions.where(_is_cancellation()).select(
        KEY, _cancel_week().alias("week_start"), F.col("monthly_amount_usd").alias("amount")
    )


def movements(versions: DataFrame) -> DataFrame:
    """(week_start, kind, amount, is_start) in one pass: a version is a start, a price change
    and a cancellation at most once each."""

    def entry(condition, week, kind, amount, is_start):
        return F.when(
            condition,
            F.struct(
                week.alias("week_start"),
                kind.alias("kind"),
                amount.cast("double").alias("amount"),
                F.lit(is_start).alias("is_start"),
            ),
        )

    price = F.col("monthly_amount_usd")
    entries = F.array(
        # A free start is no movement, but it can open the calendar.
        entry(_is_start(), week_start(F.col("created_at")), F.when(price > 0, "new"), price, True),
        entry(_change_kind().isNotNull(), week_start(F.col(VALID_FROM)), _change_kind(), _change_amount(), False),
        entry(_is_cancellation(), _cancel_week(), F.lit("churn"), price, False),
    )
    return (
        versions.select(F.explode(entries).alias("m")).where(F.col("m").isNotNull()).select("m.*")
    )


def movement_totals(moves: DataFrame) -> DataFrame:
    """One row per week that has any movement or start."""

    def total(kind):
        return F.coalesce(sum_usd(F.when(F.col("kind") == kind, F.col("amount"))), F.lit(0.0))

    return moves.groupBy("week_start").agg(
        *[total(kind).alias(name) for kind, name in MONEY.items()],
        *[F.count_if(F.col("kind") == kind).alias(name) for kind, name in COUNTS.items()],
        F.count_if("is_start").alias("starts"),
    )


def _calendar(first: Column, as_of: AsOf) -> Column:
    """Every Monday from `first` to the current week; NULL without a start or before it."""
    last = F.trunc(as_day(as_of), "week")
    return F.when(first <= last, F.sequence(first, last, F.expr("INTERVAL 7 DAYS")))


def _first_start() -> Column:
    return F.min(F.when(F.col("starts") > 0, F.col("week_start")))


def week_spine(totals: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Every Monday from the first start's week to the current one; none without starts."""
    return totals.agg(_first_start().alias("first")).select(
        F.explode(_calendar(F.col("first"), as_of)).alias("week_start")
    )


def weekly_movement_totals(history: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Dense weeks, zero-filled; movements outside the calendar drop out.

    The totals, one per calendar week, become one map that the calendar looks its weeks up
    in, so the history is gone through once for both.
    """
    return dense_weeks(movement_totals(movements(subscription_versions_with_prev(history))), as_of)


def dense_weeks(totals: DataFrame, as_of: AsOf = None) -> DataFrame:
    """`movement_totals` on the calendar: every week from the first start's on, zero-filled."""
    names = [*MONEY.values(), *COUNTS.values()]
    entry = F.struct("week_start", F.struct(*names))
    whole = totals.agg(
        _first_start().alias("first"),
        F.map_from_entries(
            F.collect_list(F.when(F.col("week_start").isNotNull(), entry))
        ).alias("by_week"),
    )
    dense = whole.select(
        F.explode(_calendar(F.col("first"), as_of)).alias("week_start"), "by_week"
    )
    that_week = F.try_element_at("by_week", F.col("week_start"))
    return dense.select(
        "week_start", *[F.coalesce(that_week[c], F.lit(0)).alias(c) for c in names]
    )


# Kept form, beside the stored snapshots at <root>: <root>-movements/run=<label> has what a run adds to
# the weeks, <root>-gone/run=<label> the last version of every subscription not there after the run.
_LAST_SEEN = ["monthly_amount_usd", "is_active"]
_GONE_SCHEMA = f"{KEY} string, monthly_amount_usd double, is_active boolean"
_WROTE_SCHEMA = f"{_GONE_SCHEMA}, created_at timestamp, canceled_at timestamp, {VALID_FROM} timestamp, is_open boolean"
_TOTALS_SCHEMA = ", ".join(
    ["week_start date", *[f"{c} double" for c in MONEY.values()], *[f"{c} bigint" for c in [*COUNTS.values(), "starts"]]]
)


def keep_movements(spark: SparkSession, root: str, run_label: str, run_at: dt.datetime | str) -> None:
    """Add up the movements of one stored snapshot run (`run_snapshot`), from the versions that it wrote.

    A version that the run opened follows the one it closed, or, for a subscription that was away,
    the last one known of it. Movements of earlier runs do not change, so their totals stay.
    May be repeated with its run; runs must be kept in order.
    """
    run = F.lit(run_at).cast("timestamp")
    wrote = spark.read.schema(_WROTE_SCHEMA).parquet(f"{root}/run={run_label}")
    columns = [KEY, *_LAST_SEEN, "created_at", "canceled_at", VALID_FROM]
    opened = wrote.where(F.col("is_open") & (F.col(VALID_FROM) == run)).select(*columns)
    closed = wrote.where(~F.col("is_open")).select(KEY, *_LAST_SEEN)
    before = latest_run_before(spark, root, run_label)
    away = spark.createDataFrame([], _GONE_SCHEMA)
    if before is not None:
        away = spark.read.schema(_GONE_SCHEMA).parquet(f"{root}-gone/run={before}")
    # One row per subscription: it was either open before the run, or away.
    last = closed.unionByName(away).select(
        F.col(KEY).alias("old_key"), *[F.col(c).alias(f"old_{c}") for c in _LAST_SEEN]
    )
    paired = store(opened.join(last, F.col(KEY) == F.col("old_key"), "full_outer"), "run-movements")
    gone = paired.where(F.col(KEY).isNull()).select(
        F.col("old_key").alias(KEY), *[F.col(f"old_{c}").alias(c) for c in _LAST_SEEN]
    )
    gone.write.mode("overwrite").parquet(f"{root}-gone/run={run_label}")
    versions = paired.where(F.col(KEY).isNotNull()).select(
        *columns,
        F.col("old_monthly_amount_usd").alias("previous_amount"),
        F.col("old_is_active").alias("previous_is_active"),
        F.when(F.col("old_key").isNull(), 1).otherwise(2).alias("rn"),
    )
    movement_totals(movements(versions)).write.mode("overwrite").parquet(f"{root}-movements/run={run_label}")


def kept_revenue_movements(spark: SparkSession, root: str, run_label: str, as_of: AsOf = None) -> DataFrame:
    """`revenue_movements` of the history after a run, from the kept totals: a row per run and week."""
    try:
        kept = spark.read.schema(f"{_TOTALS_SCHEMA}, run string").parquet(f"{root}-movements")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        kept = spark.createDataFrame([], f"{_TOTALS_SCHEMA}, run string")
    totals = kept.where(F.col("run") <= run_label).groupBy("week_start").agg(
        *[sum_usd(F.col(c)).alias(c) for c in MONEY.values()], *[F.sum(c).alias(c) for c in [*COUNTS.values(), "starts"]]
    )
    return ending_mrr_running(dense_weeks(totals, as_of))


def ending_mrr_running(weekly: DataFrame) -> DataFrame:
    """Net change and cumulative MRR. One task, but over one row per calendar week only."""
    net = F.col("new_mrr") + F.col("expansion_mrr") - F.col("contraction_mrr") - F.col("churned_mrr")
    so_far = F.sum(cents(F.col("net_mrr_change"))).over(W.orderBy("week_start"))
    return weekly.withColumn("net_mrr_change", cents(net) / F.lit(100)).withColumn(
        "ending_mrr", so_far / F.lit(100)
    )


def revenue_movements(history: DataFrame, as_of: AsOf = None) -> DataFrame:
    return ending_mrr_running(weekly_movement_totals(history, as_of))


def revenue_chart(movements_by_week: DataFrame) -> DataFrame:
    """Bars (losses negative) and the ending-MRR line, in week order."""
    return movements_by_week.select(
        "week_start",
        "new_mrr",
        "expansion_mrr",
        (F.lit(0.0) - F.col("contraction_mrr")).alias("contraction_bar"),
        (F.lit(0.0) - F.col("churned_mrr")).alias("churned_bar"),
        "net_mrr_change",
        "ending_mrr",
    ).orderBy("week_start")


def churn_at_peak_mrr(history: DataFrame) -> DataFrame:
    """Extension: each cancellation with the highest price the subscription ever had by then."""
    versions = subscription_versions_with_prev(history)
    so_far = W.partitionBy(KEY).orderBy(VALID_FROM).rowsBetween(W.unboundedPreceding, W.currentRow)
    peaked = versions.withColumn("peak_mrr", F.max("monthly_amount_usd").over(so_far))
    return peaked.where(_is_cancellation()).select(
        KEY,
        _cancel_week().alias("week_start"),
        F.col("monthly_amount_usd").alias("churned_mrr"),
        F.col("peak_mrr").alias("churned_mrr_at_peak"),
    )


def hard_delete_churn(history: DataFrame) -> DataFrame:
    """Extension: active versions that were closed without a successor at that moment."""
    w = W.partitionBy(KEY).orderBy(VALID_FROM)
    return (
        history.withColumn("followed_at", F.lead(VALID_FROM).over(w))
        .where(F.col("is_active") & (F.col("monthly_amount_usd") > 0) & F.col(VALID_TO).isNotNull())
        .where(F.col("followed_at").isNull() | (F.col("followed_at") > F.col(VALID_TO)))
        .select(
            KEY,
            week_start(F.col(VALID_TO)).alias("week_start"),
            F.col("monthly_amount_usd").alias("churned_mrr"),
        )
    )
