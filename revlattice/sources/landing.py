"""Landing of raw API objects, kept whole as JSON text."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RAW_SCHEMA = "id string, raw_json string, extracted_at timestamp"

# The six object types, as <system>_<object>.
RAW_OBJECTS = [
    "hubspot_companies",
    "hubspot_contacts",
    "hubspot_deals",
    "stripe_customers",
    "stripe_subscriptions",
    "stripe_invoices",
]


def raw_objects(lines: DataFrame, extracted_at: dt.datetime | str | None = None) -> DataFrame:
    """One JSON document per `value` row -> (id, raw_json, extracted_at)."""
    stamp = F.current_timestamp() if extracted_at is None else F.lit(extracted_at)
    return lines.where(F.trim("value") != "").select(
        F.get_json_object("value", "$.id").alias("id"),
        F.col("value").alias("raw_json"),
        stamp.cast("timestamp").alias("extracted_at"),
    )


def land_raw_objects(
    spark: SparkSession,
    dump_path: str,
    table_path: str,
    extracted_at: dt.datetime | str | None = None,
) -> DataFrame:
    """Replace one raw table from a newline-delimited JSON dump.

    An empty dump still leaves a table that reads back with the three columns.
    """
    landed = raw_objects(spark.read.text(dump_path), extracted_at)
    landed.write.mode("overwrite").parquet(table_path)
    return read_raw(spark, table_path)


def read_raw(spark: SparkSession, table_path: str) -> DataFrame:
    return spark.read.schema(RAW_SCHEMA).parquet(table_path)
