"""Checks on the data and on the models' results."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from revlattice.functions.values import domain_from_name, local_part_key, part_after_at, sum_usd


def _profile_metrics(df: DataFrame) -> list[Column]:
    return [F.count(F.lit(1)).alias("total_rows"), *[F.count(F.col(c)).alias(f"n_{c}") for c in df.columns]]


def null_profile(df: DataFrame, table_name: str) -> DataFrame:
    """Rows and non-NULL values of every column: a wrong JSON path shows as 0."""
    counted = df.agg(*_profile_metrics(df))
    per_column = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.col(f"n_{c}").alias("non_null_rows"))
            for c in df.columns
        ]
    )
    return counted.select(
        F.lit(table_name).alias("table_name"), "total_rows", F.inline(per_column)
    ).select("table_name", "column_name", "total_rows", "non_null_rows")


class Watch:
    """Checks that ride along with the writing of a model, in place of a scan of their own.

    `over` marks the rows; write its result, with no shuffle after the mark, so that each row is
    counted once even if a task is repeated. Then `profile` and `event_summary` have the rows of
    `null_profile` and `unattributed_and_late_events`.
    """

    def __init__(self) -> None:
        self.profiled: dict[str, tuple[Observation, list[str]]] = {}
        self.events: Observation | None = None

    def over(self, df: DataFrame, table_name: str) -> DataFrame:
        seen = Observation(f"profile of {table_name} {uuid.uuid4().hex}")
        self.profiled[table_name] = seen, df.columns
        return df.observe(seen, *_profile_metrics(df))

    def over_events(self, events: DataFrame) -> DataFrame:
        self.events = Observation(f"events {uuid.uuid4().hex}")
        return events.observe(self.events, *_event_metrics())

    def profile(self, spark: SparkSession) -> DataFrame:
        rows = [
            (name, c, seen.get["total_rows"], seen.get[f"n_{c}"])
            for name, (seen, columns) in self.profiled.items()
            for c in columns
        ]
        return spark.createDataFrame(rows, "table_name string, column_name string, total_rows bigint, non_null_rows bigint")

    def event_summary(self, spark: SparkSession) -> DataFrame:
        kinds = "events bigint, without_domain bigint, late bigint, delay bigint"
        got = self.events.get if self.events else {}
        row = tuple(got.get(k.split()[0]) for k in kinds.split(", "))
        return _event_shares(spark.createDataFrame([row] if self.events else [], kinds))


def key_uniqueness(df: DataFrame, key: str, table_name: str) -> DataFrame:
    """Keys that break "one row per key"; an empty result is a pass."""
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(F.col(key).alias("key_value"))
        .agg(F.count("*").alias("copies"))
        .where(F.col("copies") > 1)
        .select(F.lit(table_name).alias("table_name"), "key_value", "copies")
    )


def name_collisions(companies: DataFrame, customers: DataFrame) -> DataFrame:
    """Names shared by several companies or customers, by counts and without pairing them.

    `pairs` is the number of rows a name match could produce.
    """
    tagged = companies.select(F.col("company_name").alias("name"), F.lit(1).alias("c"), F.lit(0).alias("b"))
    tagged = tagged.unionByName(
        customers.select(F.col("customer_name").alias("name"), F.lit(0).alias("c"), F.lit(1).alias("b"))
    )
    return (
        tagged.where(F.col("name").isNotNull())
        .groupBy("name")
        .agg(F.sum("c").alias("companies"), F.sum("b").alias("customers"))
        .where((F.col("companies") > 1) | (F.col("customers") > 1))
        .withColumn("pairs", F.col("companies") * F.col("customers"))
    )


def crowded_names(companies: DataFrame, customers: DataFrame, max_pairs: int) -> DataFrame:
    """`name_collisions` of more than `max_pairs` pairs: names for which a match by name would give that
    many rows. Ask before matching; an empty result is a pass."""
    return name_collisions(companies, customers).where(F.col("pairs") > max_pairs)


def revenue_reconciles(movements: DataFrame, overview: DataFrame, strict: bool = False) -> DataFrame:
    """A row if the latest ending MRR and the accounts' total differ; empty is a pass.

    As a plain comparison it also passes when a side is missing; `strict` reports that.
    The two totals meet as one row each in a union.
    """
    none = F.lit(None).cast("double")
    latest = movements.agg(F.max_by("ending_mrr", "week_start").alias("ending_mrr"))
    total = overview.agg(sum_usd(F.col("current_mrr_usd")).alias("total_mrr"))
    both = (
        latest.select("ending_mrr", none.alias("total_mrr"))
        .unionByName(total.select(none.alias("ending_mrr"), "total_mrr"))
        .agg(F.max("ending_mrr").alias("ending_mrr"), F.max("total_mrr").alias("total_mrr"))
    )
    ending, accounts = F.col("ending_mrr"), F.col("total_mrr")
    differs = ~ending.eqNullSafe(accounts) | ending.isNull() if strict else ending != accounts
    return both.where(differs).withColumn("gap", ending - accounts)


def _delay() -> Column:
    return F.unix_micros("ingested_at") - F.unix_micros("occurred_at")


def _is_late() -> Column:
    """On-time events arrive within 30 seconds, late ones a day or more later."""
    return _delay() >= 86_400_000_000


def _event_metrics() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("events"),
        F.count_if(F.col("account_domain").isNull()).alias("without_domain"),
        F.count_if(_is_late()).alias("late"),
        F.max(F.floor(_delay() / 1_000_000)).alias("delay"),
    ]


def _event_shares(counted: DataFrame) -> DataFrame:
    return counted.select(
        "events",
        "without_domain",
        "late",
        F.round(F.try_divide("without_domain", "events") * 100, 1).alias("without_domain_pct"),
        F.round(F.try_divide("late", "events") * 100, 1).alias("late_pct"),
        F.col("delay").alias("max_delay_seconds"),
    )


def unattributed_and_late_events(events: DataFrame) -> DataFrame:
    return _event_shares(events.agg(*_event_metrics()))


def dq_unattributed_report(events: DataFrame) -> DataFrame:
    """Extension: events without an account, by day and type, instead of losing sight of them."""
    return (
        events.groupBy(F.to_date("occurred_at").alias("usage_date"), "event_type")
        .agg(
            F.count("*").alias("events"),
            F.count_if(F.col("account_domain").isNull()).alias("without_domain"),
            F.sum(F.when(F.col("account_domain").isNull(), F.col("credits_used")).otherwise(0)).alias(
                "credits_without_domain"
            ),
        )
        .where(F.col("without_domain") > 0)
    )


def event_type_counts(events: DataFrame) -> DataFrame:
    return events.groupBy("event_type").agg(F.count("*").alias("events"))


def validate_against_answer_key(answer_key: DataFrame, overview: DataFrame) -> DataFrame:
    """Hidden archetype by health label and lead flag, with how often they meet."""
    truth = answer_key.select(F.col("hubspot_company_id").alias("account"), "archetype")
    return (
        overview.join(truth, F.col("hubspot_company_id") == F.col("account"))
        .groupBy("archetype", "health_status", "is_pql")
        .agg(F.count("*").alias("accounts"))
    )


def orphan_billing(subscriptions: DataFrame, invoices: DataFrame, customers: DataFrame) -> DataFrame:
    """Billing records whose customer no longer exists, counted per missing customer.

    Records are counted per customer before they meet the customer list, so one customer
    with very many records does not weigh on a single task.
    """
    of_subscriptions = subscriptions.groupBy("customer_id").agg(
        F.count("*").alias("subscriptions"),
        F.lit(0).cast("bigint").alias("invoices"),
        F.lit(0.0).alias("invoiced_usd"),
    )
    of_invoices = invoices.groupBy("customer_id").agg(
        F.lit(0).cast("bigint").alias("subscriptions"),
        F.count("*").alias("invoices"),
        sum_usd(F.col("amount_due_usd")).alias("invoiced_usd"),
    )
    billed = (
        of_subscriptions.unionByName(of_invoices)
        .groupBy("customer_id")
        .agg(
            F.sum("subscriptions").alias("subscriptions"),
            F.sum("invoices").alias("invoices"),
            sum_usd(F.col("invoiced_usd")).alias("invoiced_usd"),
        )
    )
    existing = customers.select(F.col("customer_id").alias("known")).distinct()
    return billed.join(existing, F.col("customer_id") == F.col("known"), "left_anti")


def duplicate_contacts(contacts: DataFrame) -> DataFrame:
    """Mailboxes of one domain that agree once dots are removed, with different addresses.

    One row per such mailbox: its number of addresses, the first and the last of them.
    """
    keyed = contacts.select(
        part_after_at(F.col("email")).alias("email_domain"),
        local_part_key(F.col("email")).alias("local_part"),
        "email",
    ).where("email_domain IS NOT NULL")
    return (
        keyed.groupBy("email_domain", "local_part")
        .agg(
            F.count_distinct("email").alias("addresses"),
            F.min("email").alias("first_email"),
            F.max("email").alias("last_email"),
        )
        .where(F.col("addresses") > 1)
    )


def domain_from_name_check(companies: DataFrame) -> DataFrame:
    """Companies whose domain is not the one their name gives."""
    expected = domain_from_name(F.col("company_name"))
    return companies.where(~F.col("domain").eqNullSafe(expected)).select(
        "company_id", "company_name", "domain", expected.alias("expected_domain")
    )


def deal_funnel(deals: DataFrame) -> DataFrame:
    """Extension: deals and their amount by stage."""
    return deals.groupBy("deal_stage").agg(
        F.count("*").alias("deals"), F.sum("amount").cast("double").alias("amount")
    )
