"""Which CRM company is which billing customer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlattice.functions.skew import keep_unmatched

ACCOUNT = ["hubspot_company_id", "company_name", "company_domain", "total_employees"]


def _accounts(companies: DataFrame) -> DataFrame:
    return companies.select(
        F.col("company_id").alias("hubspot_company_id"),
        "company_name",
        F.col("domain").alias("company_domain"),
        F.col("employees").alias("total_employees"),
    )


def _labelled(df: DataFrame, customer_id: Column, match_type: str) -> DataFrame:
    return df.select(*ACCOUNT, customer_id.alias("customer_id"), F.lit(match_type).alias("match_type"))


def _match(companies: DataFrame, customers: DataFrame, name_key) -> DataFrame:
    accounts = _accounts(companies)
    linked = customers.select(F.col("hubspot_company_id").alias("link"), "customer_id")
    named = customers.select(name_key(F.col("customer_name")).alias("billing_name"), "customer_id")

    direct = accounts.join(linked, F.col("hubspot_company_id") == F.col("link"))

    # Customers already linked stay eligible for a name match with another company.
    rest = keep_unmatched(
        accounts.where(F.col("hubspot_company_id").isNotNull()),
        "hubspot_company_id",
        linked,
        "link",
    ).withColumn("name_key", name_key(F.col("company_name")))
    by_name = rest.join(named, F.col("name_key") == F.col("billing_name"))
    nowhere = keep_unmatched(rest, "name_key", named, "billing_name")

    return (
        _labelled(direct, F.col("customer_id"), "direct")
        .unionByName(_labelled(by_name, F.col("customer_id"), "name"))
        .unionByName(_labelled(nowhere, F.lit(None).cast("string"), "unmatched"))
    )


def account_identity(companies: DataFrame, customers: DataFrame) -> DataFrame:
    """Match by the id stored in billing, else by exact equal name, else no customer.

    Rows multiply where several customers match one company; `key_uniqueness` reports that.
    """
    return _match(companies, customers, lambda name: name)


def normalised_name(name: Column) -> Column:
    """Lower case, no punctuation, no trailing company suffixes; NULL if nothing is left."""
    words = F.trim(F.regexp_replace(F.lower(name), r"[^\p{L}\p{N}]+", " "))
    # Company suffixes.
    bare = F.regexp_replace(words, r"( (ab|inc|llc|ltd|limited|gmbh|corp|corporation|co|as|oy|plc))+$", "")
    joined = F.replace(bare, F.lit(" "), F.lit(""))
    return F.when(joined != "", joined)


def identity_normalised_name(companies: DataFrame, customers: DataFrame) -> DataFrame:
    """Extension: as `account_identity`, with names compared after normalisation."""
    return _match(companies, customers, normalised_name)


def match_type_coverage(identity: DataFrame) -> DataFrame:
    return identity.groupBy("match_type").agg(F.count("*").alias("accounts"))
