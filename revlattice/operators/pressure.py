"""Pressure on a plan's limits: the deterministic part of the plan-change rule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Self-serve steps up, steps down, and the two usage limits.
NEXT_PLAN = {"free": "pro", "pro": "team"}
LOWER_PLAN = {"enterprise": "team", "team": "pro", "pro": "free"}
HIGH_USAGE, LOW_USAGE = 0.80, 0.15


def _step(plan: Column, path: dict[str, str]) -> Column:
    out = F.lit(None).cast("string")
    for source, target in path.items():
        out = F.when(plan == source, target).otherwise(out)
    return out


def plan_pressure(state: DataFrame, plans: DataFrame) -> DataFrame:
    """Which subscriptions push against their plan's limits and which have gone quiet on a paid one.

    `state` as from `account_usage_state`; accounts without a plan have no answer. Both can hold at once: few credits but too many seats.
    """
    limits = plans.select(F.col("plan_name").alias("limit_plan"), "seat_limit", "monthly_credits")
    plan = F.col("plan_name")
    ratio = F.try_divide("credits_30d", "monthly_credits")
    pushing = (ratio >= HIGH_USAGE) | (F.col("seats") > F.col("seat_limit"))
    quiet = (plan != "free") & (ratio < LOW_USAGE)
    return state.join(limits, plan == F.col("limit_plan"), "left").select(
        "hubspot_company_id",
        "subscription_id",
        "plan_name",
        "credits_30d",
        "seats",
        ratio.alias("credit_ratio"),
        pushing.alias("is_pushing"),
        F.when(pushing, _step(plan, NEXT_PLAN)).alias("next_plan"),
        quiet.alias("is_quiet"),
        F.when(quiet, _step(plan, LOWER_PLAN)).alias("lower_plan"),
    )
