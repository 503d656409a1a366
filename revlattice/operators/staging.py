"""Raw JSON objects and raw events to typed rows.

Every JSON leaf is declared STRING and cast afterwards: the CRM sends numbers as quoted
text, which a numeric leaf would turn into NULL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlattice.functions.values import (
    cents_to_usd,
    from_epoch,
    part_after_at,
    safe_bigint,
    safe_boolean,
    safe_timestamp,
    strict_bigint,
)


def _struct(*leaves: str) -> str:
    return "struct<" + ", ".join(f"{leaf}: string" for leaf in leaves) + ">"


COMPANY_JSON = f"properties {_struct('name', 'domain', 'numberofemployees', 'createdate')}"
CONTACT_JSON = "properties " + _struct(
    "email", "firstname", "lastname", "company", "createdate", "lastmodifieddate"
)
DEAL_JSON = "properties " + _struct(
    "dealname", "dealstage", "pipeline", "amount", "closedate", "createdate", "hs_lastmodifieddate"
)
CUSTOMER_JSON = (
    "name string, email string, created string, "
    f"metadata {_struct('hubspot_company_id')}"
)
ITEM_JSON = (
    "struct<price: struct<id: string, unit_amount: string>, quantity: string, "
    "current_period_start: string, current_period_end: string>"
)
SUBSCRIPTION_JSON = (
    "customer string, status string, currency string, created string, canceled_at string, "
    f"ended_at string, cancel_at_period_end string, items struct<data: array<{ITEM_JSON}>>"
)
INVOICE_JSON = (
    "customer string, status string, amount_due string, amount_paid string, currency string, "
    "created string, parent struct<subscription_details: struct<subscription: string>>"
)


def _parsed(raw: DataFrame, schema: str) -> DataFrame:
    """(id, extracted_at, the document's fields).

    Parsed through a generator because Spark does not move later filters below one; pushed
    below a plain projection, each filter would parse the document again.
    """
    document = F.inline(F.array(F.from_json("raw_json", schema)))
    return raw.select("id", "extracted_at", document)


def stg_companies(raw: DataFrame) -> DataFrame:
    p = F.col("properties")
    return _parsed(raw, COMPANY_JSON).select(
        F.col("id").alias("company_id"),
        p["name"].alias("company_name"),
        F.lower(p["domain"]).alias("domain"),
        safe_bigint(p["numberofemployees"]).alias("employees"),
        safe_timestamp(p["createdate"]).alias("created_at"),
        "extracted_at",
    )


def stg_contacts(raw: DataFrame) -> DataFrame:
    p = F.col("properties")
    email = F.lower(p["email"])
    return _parsed(raw, CONTACT_JSON).select(
        F.col("id").alias("contact_id"),
        email.alias("email"),
        part_after_at(email).alias("email_domain"),
        p["firstname"].alias("first_name"),
        p["lastname"].alias("last_name"),
        p["company"].alias("company_name"),
        safe_timestamp(p["createdate"]).alias("created_at"),
        safe_timestamp(p["lastmodifieddate"]).alias("updated_at"),
        "extracted_at",
    )


def stg_deals(raw: DataFrame) -> DataFrame:
    p = F.col("properties")
    return _parsed(raw, DEAL_JSON).select(
        F.col("id").alias("deal_id"),
        p["dealname"].alias("deal_name"),
        p["dealstage"].alias("deal_stage"),
        p["pipeline"].alias("pipeline"),
        p["amount"].try_cast("decimal(38,9)").alias("amount"),
        safe_timestamp(p["closedate"]).alias("close_date"),
        safe_timestamp(p["createdate"]).alias("created_at"),
        safe_timestamp(p["hs_lastmodifieddate"]).alias("updated_at"),
        "extracted_at",
    )


def stg_deal_accounts(raw: DataFrame, property_name: str) -> DataFrame:
    """(deal_id, hubspot_company_id) from the property the activation job writes on its deals."""
    path = F.get_json_object("raw_json", f"$.properties.{property_name}")
    return raw.select(F.col("id").alias("deal_id"), path.alias("hubspot_company_id"))


def stg_customers(raw: DataFrame) -> DataFrame:
    return _parsed(raw, CUSTOMER_JSON).select(
        F.col("id").alias("customer_id"),
        F.col("name").alias("customer_name"),
        F.lower(F.col("email")).alias("email"),
        F.col("metadata.hubspot_company_id"),
        from_epoch(strict_bigint(F.col("created"), "customer.created")).alias("created_at"),
        "extracted_at",
    )


def stg_subscriptions(raw: DataFrame) -> DataFrame:
    """One row per subscription item; a subscription without items keeps one row."""
    item = F.col("item")
    per_item = _parsed(raw, SUBSCRIPTION_JSON).select("*", F.explode_outer("items.data").alias("item"))

    def moment(text):
        return from_epoch(safe_bigint(text))

    return per_item.select(
        F.col("id").alias("subscription_id"),
        F.col("customer").alias("customer_id"),
        F.col("status").alias("subscription_status"),
        "currency",
        item["price"]["id"].alias("price_id"),
        cents_to_usd(item["price"]["unit_amount"]).alias("monthly_amount_usd"),
        safe_bigint(item["quantity"]).alias("quantity"),
        moment(item["current_period_start"]).alias("current_period_start"),
        moment(item["current_period_end"]).alias("current_period_end"),
        moment(F.col("created")).alias("created_at"),
        moment(F.col("canceled_at")).alias("canceled_at"),
        moment(F.col("ended_at")).alias("ended_at"),
        safe_boolean(F.col("cancel_at_period_end")).alias("cancel_at_period_end"),
        "extracted_at",
    )


def stg_invoices(raw: DataFrame) -> DataFrame:
    return _parsed(raw, INVOICE_JSON).select(
        F.col("id").alias("invoice_id"),
        F.col("customer").alias("customer_id"),
        F.col("parent.subscription_details.subscription").alias("subscription_id"),
        F.col("status").alias("payment_status"),
        cents_to_usd(F.col("amount_due")).alias("amount_due_usd"),
        cents_to_usd(F.col("amount_paid")).alias("amount_paid_usd"),
        "currency",
        from_epoch(strict_bigint(F.col("created"), "invoice.created")).alias("created_at"),
        "extracted_at",
    )


def stg_usage_events(raw: DataFrame) -> DataFrame:
    """Events with lower-case names; the log's partition column comes along where there is one."""
    return raw.select(
        "event_id",
        "event_type",
        F.lower("account_domain").alias("account_domain"),
        F.lower("user_email").alias("user_email"),
        "credits_used",
        "occurred_at",
        "ingested_at",
        *[c for c in raw.columns if c == "occurred_date"],
    )
