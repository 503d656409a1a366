"""Write-back payloads for the CRM. Delivery to the CRM's API is outside this repo."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from revlattice.functions.skew import keep_unmatched
from revlattice.functions.values import blank_if_missing
from revlattice.session import store

# CRM property names carry a prefix, so that fields written by this job stand out.
PROPERTY_PREFIX = "revlattice_"

# CRM property (without prefix) -> overview column.
PROPERTY_SOURCES = {
    "health_status": "health_status",
    "account_segment": "account_segment",
    "days_since_active": "days_since_last_active",
    "active_users_14d": "active_users_14d",
    "plan": "plan_name",
    "credit_usage_pct": "credit_usage_pct",
    "seat_usage_pct": "seat_usage_pct",
    "credits_used_14d": "credits_used_14d",
    "current_mrr": "current_mrr_usd",
    "lifetime_revenue": "lifetime_revenue_usd",
    "tenure_days": "tenure_days",
    "pql_signals": "pql_signal_count",
}
# Deal stage for a new lead, and the CRM's limit per batch call.
NEW_DEAL_STAGE = "appointmentscheduled"
WON_STAGE, LOST_STAGE = "closedwon", "closedlost"
BATCH_SIZE = 100


def _text(df: DataFrame, name: str) -> Column:
    return blank_if_missing(F.col(name), df.schema[name].dataType.simpleString() == "double")


def company_property_payload(
    overview: DataFrame, synced_at: dt.datetime | str | None = None, prefix: str = PROPERTY_PREFIX
) -> DataFrame:
    """(id, properties): one update per overview row, every value as text, missing as ''."""
    stamp = F.current_timestamp() if synced_at is None else F.lit(synced_at).cast("timestamp")
    # The text says +00:00, whatever zone the session has.
    stamp = F.to_utc_timestamp(stamp, F.current_timezone())
    properties = [
        _text(overview, source).alias(prefix + name) for name, source in PROPERTY_SOURCES.items()
    ]
    properties.append(
        F.when(F.coalesce("is_pql", F.lit(False)), "Yes").otherwise("No").alias(prefix + "is_pql")
    )
    properties.append(
        F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss'+00:00'").alias(prefix + "synced_at")
    )
    return overview.where(F.col("hubspot_company_id").isNotNull()).select(
        F.col("hubspot_company_id").alias("id"), F.struct(*properties).alias("properties")
    )


def payload_batches(payload: DataFrame, batch_size: int = BATCH_SIZE, bucket_digits: int = 3) -> DataFrame:
    """(batch_no, size, inputs): all updates, numbered through and cut into full batches.

    Numbering needs no global sort. Rows fall into 16 ** `bucket_digits` hash buckets (4096;
    raise it where a bucket is too much for a task); a bucket's offset is the size of those
    before it (a running sum over one row per bucket), and the position inside a bucket is
    added. Equal updates are counted first and numbered as copies, so a company that occurs
    very often is spread over all buckets. The rows are stored, as they are counted and numbered.
    """
    copies = payload.groupBy("id", "properties").agg(F.count("*").alias("n"))
    rows = copies.select(
        "id", "properties", F.explode(F.sequence(F.lit(1).cast("long"), "n")).alias("copy")
    ).withColumn(
        "bucket", F.substring(F.md5(F.concat("id", F.to_json("properties"), "copy")), 1, bucket_digits)
    )
    rows = store(rows, "payload-rows")
    sizes = rows.groupBy("bucket").agg(F.count("*").alias("in_bucket"))
    before = W.orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select(
        F.col("bucket").alias("of_bucket"),
        F.coalesce(F.sum("in_bucket").over(before), F.lit(0)).alias("offset"),
    )
    order = W.partitionBy("bucket").orderBy("id", F.to_json("properties"), "copy")
    numbered = (
        rows.withColumn("at", F.row_number().over(order))
        .join(offsets, F.col("bucket") == F.col("of_bucket"))
        .withColumn("position", F.col("offset") + F.col("at") - 1)
    )
    update = F.struct("position", F.struct("id", "properties").alias("update"))
    return (
        numbered.groupBy(F.floor(F.col("position") / batch_size).alias("batch_no"))
        .agg(F.count("*").alias("size"), F.array_sort(F.collect_list(update)).alias("updates"))
        .select("batch_no", "size", F.col("updates.update").alias("inputs"))
    )


def deal_value_estimate(employees: Column) -> Column:
    """A rough yearly value by company size; unknown counts as small."""
    size = F.coalesce(employees, F.lit(0))
    # Size limits and amounts.
    return F.when(size >= 250, 24000.0).when(size >= 100, 18000.0).otherwise(12000.0)


def _one_per_company(leads: DataFrame) -> DataFrame:
    """At most one row per company, the strongest, so that none gets two deals."""
    best = F.struct(
        "signal_count", "credits_used_14d", F.coalesce("monthly_amount_usd", F.lit(0.0)), "plan_name"
    )
    row = F.struct(*[c for c in leads.columns if c != "hubspot_company_id"])
    return (
        leads.groupBy("hubspot_company_id").agg(F.max_by(row, best).alias("row")).select("hubspot_company_id", "row.*")
    )


def deal_decisions(leads: DataFrame, deal_accounts: DataFrame) -> DataFrame:
    """Leads by company, with `action` created or already existed.

    The existing ids are made distinct before the join: a company with very many deals
    counts once.
    """
    known = (
        deal_accounts.where(F.col("hubspot_company_id") != "")
        .select(F.col("hubspot_company_id").alias("has_deal"))
        .distinct()
    )
    per_company = _one_per_company(leads)
    joined = per_company.join(known, F.col("hubspot_company_id") == F.col("has_deal"), "left")
    action = F.when(F.col("has_deal").isNull(), "created").otherwise("already existed")
    return joined.withColumn("action", action).drop("has_deal")


def new_pql_deals(
    leads: DataFrame, deal_accounts: DataFrame, prefix: str = PROPERTY_PREFIX
) -> DataFrame:
    """One deal for each lead whose company has none yet, all values as text."""
    fresh = keep_unmatched(
        _one_per_company(leads),
        "hubspot_company_id",
        deal_accounts.where(F.col("hubspot_company_id") != ""),
        "hubspot_company_id",
    )
    return fresh.select(
        F.concat(F.coalesce("company_name", F.lit("None")), F.lit(" - Enterprise (PQL)")).alias("dealname"),
        F.lit(NEW_DEAL_STAGE).alias("dealstage"),
        deal_value_estimate(F.col("total_employees")).cast("string").alias("amount"),
        F.col("hubspot_company_id").alias(prefix + "company_id"),
        F.col("signal_count").cast("string").alias(prefix + "pql_signals"),
        _text(fresh, "credit_usage_pct").alias(prefix + "credit_usage_pct"),
        _text(fresh, "active_users").alias(prefix + "active_users"),
    )


def deal_associations(new_deals: DataFrame, prefix: str = PROPERTY_PREFIX) -> DataFrame:
    """Which company each deal of `new_pql_deals` is to be linked with in the CRM.

    A new deal has no id yet; it is known by its name and the company id that it carries.
    """
    company = F.col(prefix + "company_id")
    return new_deals.where(company.isNotNull()).select(
        F.lit("deals").alias("from_object_type"),
        "dealname",
        F.lit("companies").alias("to_object_type"),
        company.alias("to_object_id"),
    )


def deal_follow_up(leads: DataFrame, deals: DataFrame, deal_accounts: DataFrame) -> DataFrame:
    """What is left to do about deals made earlier: action, deal_id, hubspot_company_id.

    `close`: an open deal whose company is no lead any more. `open anew`: a lead all of whose deals
    were lost, which `new_pql_deals` passes over as it has deals; deal_id is NULL. A deal without a stage is
    open, deals without a company are left alone, and a company of very many deals is spread over them.
    """
    lost = F.coalesce(F.col("deal_stage") == LOST_STAGE, F.lit(False))
    won = F.coalesce(F.col("deal_stage") == WON_STAGE, F.lit(False))
    stages = deals.select(F.col("deal_id").alias("of_deal"), "deal_stage")
    linked = (
        deal_accounts.where(F.col("hubspot_company_id") != "")
        .join(stages, F.col("deal_id") == F.col("of_deal"))
        .drop("of_deal")
    )
    close = keep_unmatched(linked.where(~lost & ~won), "hubspot_company_id", leads, "hubspot_company_id")
    companies = linked.groupBy("hubspot_company_id").agg(F.bool_and(lost).alias("all_lost"))
    wanted = leads.select(F.col("hubspot_company_id").alias("lead")).distinct()
    again = companies.where("all_lost").join(wanted, F.col("hubspot_company_id") == F.col("lead"))
    return close.select(F.lit("close").alias("action"), "deal_id", "hubspot_company_id").unionByName(
        again.select(F.lit("open anew").alias("action"), F.lit(None).cast("string").alias("deal_id"), "hubspot_company_id")
    )


def deal_sync_counts(payload: DataFrame, decisions: DataFrame) -> DataFrame:
    """How many companies are updated, and how many deals are made or exist already."""
    updates = payload.agg(F.count("*").alias("records"))
    deals = decisions.groupBy(F.concat(F.lit("deal "), "action").alias("action"))
    return updates.select(F.lit("company updated").alias("action"), "records").unionByName(
        deals.agg(F.count("*").alias("records"))
    )
