"""Publishing of model results: views for staging and intermediate, tables for marts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# How each layer is kept.
LAYER_KIND = {"staging": "view", "intermediate": "view", "marts": "table", "seeds": "table"}


def layer_name(name: str | None, default: str) -> str:
    """A layer's schema: the given name as it is, trimmed and in lower case."""
    return default if name is None else name.strip().lower()


def materialise_layer(
    df: DataFrame, layer: str, name: str, root: str, default: str = "staging", schema: str | None = None
) -> DataFrame:
    """Publish a model under its layer and return it as readers will see it.

    Views are session views `<schema>_<name>`; tables are `<schema>.<name>`, stored in
    `<root>/<schema>`, and replace a table of that name. The schema is the layer's own unless `schema` names another.
    """
    spark = df.sparkSession
    kind = LAYER_KIND[layer_name(layer, default)]
    schema = layer_name(schema, layer_name(layer, default))
    if kind == "view":
        df.createOrReplaceTempView(f"{schema}_{name}")
        return spark.table(f"{schema}_{name}")
    # Tables lie beside the schema's own folder, which goes with the schema.
    location = f"{root.rstrip('/')}/{schema}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {schema} LOCATION '{location}-schema'")
    (
        df.write.mode("overwrite")
        .format("parquet")
        .option("path", f"{location}/{name}")
        .saveAsTable(f"{schema}.{name}")
    )
    return spark.table(f"{schema}.{name}")


def release_schema(spark: SparkSession, schema: str) -> None:
    """Take a schema and its tables out of the catalog. Their files stay for readers that have them open."""
    spark.sql(f"DROP DATABASE IF EXISTS {schema} CASCADE")


def scan_overview(spark: SparkSession, path: str) -> DataFrame:
    """The published overview, rows that name a CRM company only."""
    return spark.read.parquet(path).where(F.col("hubspot_company_id").isNotNull())


def scan_pqls(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
