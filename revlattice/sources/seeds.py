"""Plan reference data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

PLAN_SCHEMA = (
    "price_id string, plan_name string, plan_rank bigint, "
    "monthly_price_usd bigint, seat_limit bigint, monthly_credits bigint"
)

# The price list, one row per billing price id.
PLANS = [
    ("price_1UIXE8I3CMSSHfjNHnB92faL", "free", 1, 0, 1, 50),
    ("price_1UIXESI3CMSSHfjNcuxPhlgr", "pro", 2, 20, 3, 500),
    ("price_1UIXHBI3CMSSHfjNyu99GHTu", "team", 3, 100, 10, 3000),
    ("price_1UIXIOI3CMSSHfjNUkjitlVi", "enterprise", 4, 1000, 50, 20000),
]


def seed_plans(spark: SparkSession, path: str | None = None) -> DataFrame:
    """The price list, from a CSV with a header if `path` is given.

    No broadcast hint: Spark knows the size of either form and broadcasts it only if small.
    """
    if path is None:
        names = ", ".join(field.split()[0] for field in PLAN_SCHEMA.split(", "))
        rows = ", ".join(str(plan) for plan in PLANS)
        listed = spark.sql(f"SELECT * FROM VALUES {rows} AS plans({names})")
        return listed.to(StructType.fromDDL(PLAN_SCHEMA))
    return spark.read.schema(PLAN_SCHEMA).csv(path, header=True)
