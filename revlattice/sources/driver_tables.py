"""Account data derived from the benchmark tables `customer`, `orders` and `events`.

Each table becomes raw CRM and billing objects (as JSON text) and raw usage events, so the
whole way from raw JSON to the marts runs on them. The conditions a real source shows
(missing links, duplicate contacts, lost domains, late events) are planted by rules on the
keys; every input row is used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from revlattice.sources.seeds import PLANS

# The "today" of usage, and of the order-derived history.
USAGE_DAY, HISTORY_DAY = "2024-01-31", "2001-12-31"
EXTRACTED_AT = "2024-01-31 05:00:00"
DEAL_ACCOUNT_PROPERTY = "revlattice_company_id"


_schemas: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A benchmark table. Its schema is read from the file footer once, not on every use."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def _customers_with_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").withColumn("k", F.col("c_custkey"))


def _raw(df: DataFrame, object_id: str, document: str) -> DataFrame:
    return df.select(
        F.expr(object_id).alias("id"),
        F.to_json(F.expr(document)).alias("raw_json"),
        F.lit(EXTRACTED_AT).cast("timestamp").alias("extracted_at"),
    )


_CRM_DATE = "date_format(date_add(date'2023-01-01', cast(k % 365 as int)), \"yyyy-MM-dd'T'00:00:00.000'Z'\")"
_BILLING_EPOCH = "unix_timestamp(cast(date_add(date'2023-10-01', cast(k % 90 as int)) as timestamp))"
_PLAN_OF_KEY = "case when k % 10 <= 3 then 'free' when k % 10 <= 6 then 'pro' when k % 10 <= 8 then 'team' else 'enterprise' end"


def _plan_case(column: int, plan: str) -> str:
    whens = " ".join(f"when '{p[1]}' then {p[column]!r}" for p in PLANS)
    return f"case {plan} {whens} end"


def raw_companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The domain is in upper case here, so that staging has to lower it.
    return _raw(
        _customers_with_key(spark, sf_dir),
        "cast(k as string)",
        "named_struct('properties', named_struct('name', c_name, 'domain', concat('C', k, '.COM'), "
        f"'numberofemployees', cast((k * 37) % 500 + 1 as string), 'createdate', {_CRM_DATE}))",
    )


def raw_contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One contact per company; some have a second one whose address lacks the dot."""
    people = _customers_with_key(spark, sf_dir).select(
        "k",
        "c_name",
        F.explode(F.expr("if(k % 20 = 3, array(0, 1), array(0))")).alias("again"),
    )
    made = "date_add(date'2023-01-01', cast(k % 365 + again as int))"
    iso = f"date_format({made}, \"yyyy-MM-dd'T'00:00:00.000'Z'\")"
    return _raw(
        people,
        "concat('con_', k, '_', again)",
        "named_struct('properties', named_struct("
        "'email', concat(if(again = 0, 'First.Last', 'firstlast'), k, '@c', k, '.com'), "
        "'firstname', if(k % 11 = 0, null, 'First'), 'lastname', concat('Last', k), "
        f"'company', c_name, 'createdate', {iso}, 'lastmodifieddate', {iso}))",
    )


def raw_deals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A deal for each customer; every sixth one, and some lost ones, were written by the activation job."""
    return _raw(
        _customers_with_key(spark, sf_dir),
        "concat('deal_', k)",
        "named_struct('properties', named_struct('dealname', concat(c_name, ' deal'), "
        "'dealstage', element_at(array('appointmentscheduled', 'qualifiedtobuy', 'closedwon', 'closedlost'), cast(k % 4 + 1 as int)), "
        "'pipeline', 'default', 'amount', if(k % 9 = 0, 'unknown', concat(12000 + k % 7 * 1000, '.5')), "
        f"'createdate', {_CRM_DATE}, 'hs_lastmodifieddate', {_CRM_DATE}, "
        f"'{DEAL_ACCOUNT_PROPERTY}', if(k % 6 = 0 or k % 12 = 7, cast(k as string), null)))",
    )


# Customers that signed up anew under another name. Their old customer objects were deleted, but
# subscriptions and invoices still refer to those.
_NEW = "k % 25 = 7"
_PAYER = f"concat('cus_', k, if({_NEW}, '_old', ''))"


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw(
        _customers_with_key(spark, sf_dir),
        "concat('cus_', k)",
        f"named_struct('name', if({_NEW}, concat('Formerly ', c_name), c_name), 'email', concat('Billing', k, '@c', k, '.com'), 'metadata', "
        f"named_struct('hubspot_company_id', if(k % 10 <> 0 and not {_NEW}, cast(k as string), null)), 'created', {_BILLING_EPOCH})",
    )


def raw_subscriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = _BILLING_EPOCH
    canceled = "if(k % 13 = 0, unix_timestamp(timestamp'2024-01-20 00:00:00'), null)"
    price = _plan_case(0, _PLAN_OF_KEY)
    cents = f"{_plan_case(3, _PLAN_OF_KEY)} * 100"
    return _raw(
        _customers_with_key(spark, sf_dir),
        "concat('sub_', k)",
        f"named_struct('customer', {_PAYER}, 'status', if(k % 13 = 0, 'canceled', 'active'), "
        f"'currency', 'usd', 'created', {start}, 'canceled_at', {canceled}, 'ended_at', {canceled}, "
        "'cancel_at_period_end', k % 13 = 0, 'items', named_struct('data', array(named_struct("
        f"'price', named_struct('id', {price}, 'unit_amount', {cents}), 'quantity', 1, "
        f"'current_period_start', {start}, 'current_period_end', {start} + 2592000))))",
    )


def raw_invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    cents = "cast(round(o_totalprice * 100) as bigint)"
    return _raw(
        table(spark, sf_dir, "orders").withColumn("k", F.col("o_custkey")),
        "concat('in_', o_orderkey)",
        f"named_struct('customer', {_PAYER}, 'parent', named_struct('subscription_details', "
        "named_struct('subscription', concat('sub_', o_custkey))), "
        "'status', case o_orderstatus when 'F' then 'paid' when 'O' then 'open' else 'void' end, "
        f"'amount_due', {cents}, 'amount_paid', if(o_orderstatus = 'F' and o_orderkey % 5 <> 0, {cents}, 0), "
        "'currency', 'usd', 'created', unix_timestamp(cast(o_orderdate as timestamp)))",
    )


def usage_events_from(events: DataFrame) -> DataFrame:
    """Raw usage events from rows of the `events` table; three users make an account."""
    a, n = "(user_id div 3)", "event_id"
    occurred = "cast(ts as timestamp)"
    delay = (
        f"if({n} % 20 = 0, (1 + ({n} div 20) % 2) * 86400 + ({n} % 601) * 60, {n} % 30 + 1)"
    )
    credits = f"if({a} % 7 = 0 and ts >= timestamp_ntz'2024-01-17 00:00:00', 0, cast(floor(value) as bigint))"
    columns = {
        "event_id": f"cast({n} as string)",
        "event_type": "case when event_type = 'click' then 'prompt_run' "
        "when event_type = 'purchase' then 'project_created' "
        "when event_type = 'error' then 'project_published' "
        f"when event_type = 'signup' and {n} % 20 = 0 then 'teammate_invited' else 'session_started' end",
        "account_domain": f"if({n} % 33 <> 0, concat('C', {a}, '.com'), null)",
        "user_email": f"concat(if({a} % 4 = 1, 'User1', concat('User', user_id % 3 + 1)), '@c', {a}, '.com')",
        "credits_used": f"if(event_type = 'click', {credits}, 0)",
        "occurred_at": occurred,
        "ingested_at": f"timestamp_micros(unix_micros({occurred}) + {delay} * 1000000)",
    }
    return events.select(*[F.expr(e).alias(c) for c, e in columns.items()])


def raw_usage_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return usage_events_from(table(spark, sf_dir, "events"))


def answer_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is really true of each account; only the validation queries may read it."""
    return _customers_with_key(spark, sf_dir).select(
        F.col("c_name").alias("company_name"),
        F.expr("concat('c', k, '.com')").alias("domain"),
        F.expr(
            "case when k % 20 < 10 then 'ghost' when k % 20 < 14 then 'power_solo' "
            "when k % 20 < 17 then 'skeptic_exec' else 'champion' end"
        ).alias("archetype"),
        F.expr("(k * 37) % 500 + 1").alias("employees"),
        F.expr(_PLAN_OF_KEY).alias("starting_plan"),
        F.expr(f"if(k % 3 = 0, null, {_PLAN_OF_KEY})").alias("current_plan"),
        F.expr("if(k % 13 = 0, 'canceled', null)").alias("status"),
        F.col("k").cast("string").alias("hubspot_company_id"),
    )


def history_states(spark: SparkSession, sf_dir: str, reactivations: bool) -> DataFrame:
    """Dated subscription states from orders, one per customer and date.

    With `reactivations` a subscription may stop and come back; without, it can only stop
    with its last state, and then revenue reconciles.
    """
    orders = table(spark, sf_dir, "orders")
    daily = (
        orders.groupBy("o_custkey", "o_orderdate")
        .agg(F.max("o_orderkey").alias("o_orderkey"))
        .withColumn("c", F.col("o_custkey"))
    )
    spans = orders.groupBy("o_custkey").agg(
        F.min("o_orderdate").alias("first_at"),
        F.max("o_orderdate").alias("last_at"),
        F.count_distinct("o_orderdate").alias("states"),
    )
    stops = "c % 13 = 0 and o_orderdate = last_at and states > 1"
    active = "o_orderkey % 5 <> 0" if reactivations else f"not ({stops})"
    plan = "element_at(array('free', 'pro', 'team', 'enterprise'), cast(o_orderkey % 4 + 1 as int))"
    return (
        daily.join(spans, "o_custkey")
        .withColumn("is_active", F.expr(active))
        .withColumn("plan_name", F.expr(plan))
        .select(
            F.expr("concat('sub_', c)").alias("subscription_id"),
            F.expr("cast(c as string)").alias("hubspot_company_id"),
            F.expr("concat('Account ', c)").alias("company_name"),
            F.expr("concat('cus_', c)").alias("customer_id"),
            "plan_name",
            F.expr("o_orderkey % 4 + 1").alias("plan_rank"),
            F.expr(f"cast({_plan_case(3, 'plan_name')} as double)").alias("monthly_amount_usd"),
            F.expr("if(is_active, 'active', 'canceled')").alias("subscription_status"),
            "is_active",
            F.expr("cast(first_at as timestamp)").alias("created_at"),
            F.expr(
                "if(not is_active and o_orderkey % 2 = 0, cast(o_orderdate + interval 2 days as timestamp), null)"
            ).alias("canceled_at"),
            F.expr("cast(o_orderdate as timestamp)").alias("state_at"),
        )
    )
