"""Every operator as a query over the benchmark tables: (spark, sf_dir) -> DataFrame.

All queries read whole tables. Run-time stamps are fixed or left out, so that results
can be compared.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlattice.operators import (
    activation,
    health,
    history,
    identity,
    overview,
    pql,
    pressure,
    quality,
    reads,
    revenue,
    staging,
    subscription,
    usage,
)
from revlattice.plans.models import Models
from revlattice.session import apply_rules, fresh_folder, store
from revlattice.sources import driver_tables as src
from revlattice.sources import landing, layers, seeds, usage_log
from revlattice.streaming import incremental

Query = Callable[[SparkSession, str], DataFrame]
TODAY, LAST_DAY = src.USAGE_DAY, src.HISTORY_DAY
SYNCED_AT = "2024-01-31 06:00:00"

QUERIES: dict[str, Query] = {}


def comparable(df: DataFrame) -> DataFrame:
    """Timestamps without zone and decimals as doubles, so engines agree on their text."""
    out = []
    for field in df.schema.fields:
        kind = field.dataType.simpleString()
        if kind == "timestamp":
            out.append(F.col(field.name).cast("timestamp_ntz").alias(field.name))
        elif kind.startswith("decimal"):
            out.append(F.col(field.name).cast("double").alias(field.name))
        else:
            out.append(F.col(field.name))
    return df.select(*out)


def query(fn: Query) -> Query:
    """Register a query under its function name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(fn(apply_rules(spark), sf_dir))

    QUERIES[fn.__name__] = run
    return run


# What a mart's plan reads several times is written once beforehand.
SHARED = ("companies", "customers", "identity")
SHARED_BY_OVERVIEW = (*SHARED, "subscriptions", "daily_usage", "account_subscriptions")


def models(spark: SparkSession, sf_dir: str, written: tuple[str, ...] = SHARED) -> Models:
    """The models over the benchmark tables."""

    def of(make):
        return lambda: make(spark, sf_dir)

    raw = {
        "companies": of(src.raw_companies),
        "contacts": of(src.raw_contacts),
        "deals": of(src.raw_deals),
        "customers": of(src.raw_customers),
        "subscriptions": of(src.raw_subscriptions),
        "invoices": of(src.raw_invoices),
        "usage_events": of(src.raw_usage_events),
        "plans": lambda: seeds.seed_plans(spark),
    }
    return Models(raw, TODAY, SYNCED_AT, written)


def for_overview(spark: SparkSession, sf_dir: str) -> Models:
    return models(spark, sf_dir, SHARED_BY_OVERVIEW)


# --- sources, landing, sinks


@query
def land_raw_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All six object types dumped as JSON lines, landed and read back."""
    dumps = {
        "hubspot_companies": src.raw_companies,
        "hubspot_contacts": src.raw_contacts,
        "hubspot_deals": src.raw_deals,
        "stripe_customers": src.raw_customers,
        "stripe_subscriptions": src.raw_subscriptions,
        "stripe_invoices": src.raw_invoices,
    }
    root = fresh_folder(spark, "landing")
    landed = None
    for name in landing.RAW_OBJECTS:
        # A dump line is the whole object: its id beside its other fields.
        whole = F.concat(
            F.lit('{"id":"'), F.col("id"), F.lit('",'), F.expr("substring(raw_json, 2)")
        )
        dumps[name](spark, sf_dir).select(whole.alias("value")).write.text(f"{root}/dump/{name}")
        table = landing.land_raw_objects(
            spark, f"{root}/dump/{name}", f"{root}/raw_{name}", src.EXTRACTED_AT
        ).select(F.lit(f"raw_{name}").alias("table_name"), "id", "raw_json", "extracted_at")
        landed = table if landed is None else landed.unionByName(table)
    return landed.groupBy("table_name", "extracted_at").agg(
        F.count("*").alias("objects"),
        F.count_distinct("id").alias("ids"),
        F.count(F.get_json_object("raw_json", "$.id")).alias("documents"),
    )


@query
def append_usage_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two overlapping batches, the second one appended twice: no event is doubled."""
    events = src.raw_usage_events(spark, sf_dir)
    path = fresh_folder(spark, "usage-log")
    first = events.where("ingested_at < timestamp'2024-01-20 00:00:00'")
    second = events.where("ingested_at >= timestamp'2024-01-18 00:00:00'")
    usage_log.append_usage_events(first, path)
    usage_log.append_usage_events(second, path)
    usage_log.append_usage_events(second, path)
    return (
        usage_log.read_usage_log(spark, path)
        .groupBy("occurred_date")
        .agg(
            F.count("*").alias("events"),
            F.count_distinct("event_id").alias("ids"),
            F.sum("credits_used").alias("credits"),
        )
    )


@query
def load_usage_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_folder(spark, "usage-log")
    usage_log.load_usage_backfill(src.raw_usage_events(spark, sf_dir), path)
    return usage_log.read_usage_log(spark, path).select(*usage_log.EVENT_COLUMNS)


@query
def seed_plans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The price list, with the subscriptions on each price."""
    m = models(spark, sf_dir)
    return subscription.plan_summary_of_prices(m.subscriptions, m.plans)


@query
def materialise_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staging as a view, a mart as a table; read back by their published names. The mart's schema
    is this run's own, so that no table of the session's catalog is replaced, and leaves the catalog with the run."""
    m = models(spark, sf_dir)
    layers.materialise_layer(m.companies, " Staging ", "stg_companies", "")
    marts = fresh_folder(spark, "tables")
    health_mart = models(spark, sf_dir).health
    schema = f"marts_{marts.rpartition('-')[2]}"
    layers.materialise_layer(health_mart, "marts", "mart_account_health", marts, schema=schema)
    found = spark.sql(
        f"""
        SELECT c.company_id, c.company_name, h.health_status
        FROM staging_stg_companies c
        JOIN {schema}.mart_account_health h ON h.hubspot_company_id = c.company_id
        """
    )
    layers.release_schema(spark, schema)
    return found


def _published(spark: SparkSession, df: DataFrame, name: str) -> str:
    path = fresh_folder(spark, name)
    df.write.parquet(path)
    return path


@query
def scan_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _published(spark, for_overview(spark, sf_dir).overview, "overview")
    return layers.scan_overview(spark, path).select(
        "hubspot_company_id", "company_name", "plan_name", "account_segment"
    )


@query
def scan_pqls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layers.scan_pqls(spark, _published(spark, models(spark, sf_dir).leads, "leads"))


# --- staging


@query
def stg_companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stg_companies(src.raw_companies(spark, sf_dir)).drop("extracted_at")


@query
def stg_contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stg_contacts(src.raw_contacts(spark, sf_dir)).drop("extracted_at")


@query
def stg_deals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stg_deals(src.raw_deals(spark, sf_dir)).drop("extracted_at")


@query
def stg_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stg_customers(src.raw_customers(spark, sf_dir)).drop("extracted_at")


@query
def stg_subscriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stg_subscriptions(src.raw_subscriptions(spark, sf_dir)).drop("extracted_at")


@query
def stg_invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stg_invoices(src.raw_invoices(spark, sf_dir)).drop("extracted_at")


@query
def stg_usage_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stg_usage_events(src.raw_usage_events(spark, sf_dir))


# --- intermediate models


@query
def account_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models(spark, sf_dir).identity


@query
def account_daily_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models(spark, sf_dir).daily_usage


@query
def account_subscription(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models(spark, sf_dir).account_subscriptions


# --- history


def _versions(spark: SparkSession, sf_dir: str, reactivations: bool) -> DataFrame:
    states = src.history_states(spark, sf_dir, reactivations)
    return history.scd2_from_daily_states(states, detect_deletes=False)


SNAPSHOT_RUNS = 4


@query
def scd2_snapshot_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored runs, spread evenly over the time of the states, the last one at their end. A run
    sees the latest state of every subscription up to it; one in eleven is missing from each run but
    the last and back in the next, so subscriptions change, vanish and return."""
    *_, (_, _, versions) = _stored_runs(spark, sf_dir, fresh_folder(spark, "snapshots"))
    return versions


def _stored_runs(spark: SparkSession, sf_dir: str, root: str):
    """Take the runs of `scd2_snapshot_apply`, and give label, time and history after each."""
    states = src.history_states(spark, sf_dir, reactivations=True)
    first, last = states.agg(F.min("state_at"), F.max("state_at")).first()
    number = F.substring("subscription_id", 5, 20).cast("long")
    if not first:
        yield None, None, history.empty_history(states.drop("state_at"))
    for i in range(1, SNAPSHOT_RUNS + 1 if first else 0):
        label = str((first + (last - first).days * i // SNAPSHOT_RUNS * dt.timedelta(days=1)).date())
        seen = states.where(F.col("state_at") <= F.lit(label).cast("timestamp"))
        if i < SNAPSHOT_RUNS:
            seen = seen.where(number % 11 != i)
        columns = [c for c in states.columns if c not in ("subscription_id", "state_at")]
        current = (
            seen.groupBy("subscription_id")
            .agg(F.max_by(F.struct(*columns), "state_at").alias("s"))
            .select("subscription_id", "s.*")
        )
        run_at = f"{label} 00:00:00"
        yield label, run_at, history.run_snapshot(current, root, label, run_at)


@query
def scd2_from_daily_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """States that last until the next one."""
    return _versions(spark, sf_dir, reactivations=True)


@query
def scd2_from_daily_states_with_deletes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same states as full snapshots, one per order date: a key not seen is deleted."""
    states = src.history_states(spark, sf_dir, reactivations=True)
    return history.scd2_from_daily_states(states, detect_deletes=True)


@query
def scd2_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.scd2_as_of(_versions(spark, sf_dir, True), "1998-06-15 00:00:00")


@query
def scd2_as_of_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each invoice with the plan its subscription was on at the time."""
    invoices = staging.stg_invoices(src.raw_invoices(spark, sf_dir)).select(
        "invoice_id", "subscription_id", F.date_add("created_at", 20).cast("timestamp").alias("billed_at")
    )
    return history.scd2_as_of_join(
        invoices,
        "billed_at",
        _versions(spark, sf_dir, True),
        ["plan_name", "monthly_amount_usd", "is_active"],
        as_of=LAST_DAY,
    )


# --- health and leads


@query
def usage_two_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return usage.usage_two_windows(models(spark, sf_dir).daily_usage, TODAY)


@query
def account_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models(spark, sf_dir).health


@query
def health_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = models(spark, sf_dir).health
    return health.health_reason(scored).select(
        "hubspot_company_id", "credits_recent", "credits_previous", "health_status", "health_reason"
    )


@query
def recent_usage_14d(spark: SparkSession, sf_dir: str) -> DataFrame:
    return usage.recent_usage_14d(models(spark, sf_dir).daily_usage, TODAY)


@query
def pql_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = models(spark, sf_dir)
    return pql.pql_signals(m.identity, m.account_subscriptions, m.daily_usage, TODAY)


@query
def product_qualified_leads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pql.ranked_leads(models(spark, sf_dir).leads)


# --- revenue


def _prev(spark: SparkSession, sf_dir: str) -> DataFrame:
    return revenue.subscription_versions_with_prev(_versions(spark, sf_dir, True))


@query
def subscription_versions_with_prev(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _prev(spark, sf_dir)


@query
def subscription_starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return revenue.subscription_starts(_prev(spark, sf_dir))


@query
def price_changes_classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return revenue.price_changes_classified(_prev(spark, sf_dir))


@query
def cancellations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return revenue.cancellations(_prev(spark, sf_dir))


@query
def week_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = revenue.movement_totals(revenue.movements(_prev(spark, sf_dir)))
    return revenue.week_spine(totals, LAST_DAY)


@query
def weekly_movement_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return revenue.weekly_movement_totals(_versions(spark, sf_dir, True), LAST_DAY)


@query
def ending_mrr_running(spark: SparkSession, sf_dir: str) -> DataFrame:
    weekly = revenue.weekly_movement_totals(_versions(spark, sf_dir, False), LAST_DAY)
    return revenue.ending_mrr_running(weekly).select("week_start", "net_mrr_change", "ending_mrr")


@query
def revenue_movements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return revenue.revenue_movements(_versions(spark, sf_dir, True), LAST_DAY)


@query
def revenue_movements_by_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The movements of stored runs, each run's added up when it was taken: none reads the history."""
    root = fresh_folder(spark, "snapshots")
    label = None
    for label, run_at, _ in _stored_runs(spark, sf_dir, root):
        if label:
            revenue.keep_movements(spark, root, label, run_at)
    return revenue.kept_revenue_movements(spark, root, label or "", LAST_DAY)


@query
def revenue_chart(spark: SparkSession, sf_dir: str) -> DataFrame:
    weekly = revenue.revenue_movements(_versions(spark, sf_dir, False), LAST_DAY)
    return revenue.revenue_chart(weekly)


@query
def revenue_reconciles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The check on a history with reactivations (fails) and on one without (passes)."""

    def check(reactivations: bool) -> DataFrame:
        # Used three times; built and written once.
        versions = store(_versions(spark, sf_dir, reactivations), "versions")
        accounts = versions.where("dbt_valid_to IS NULL").select(
            F.when(F.col("is_active"), F.col("monthly_amount_usd")).otherwise(0.0).alias("current_mrr_usd")
        )
        found = quality.revenue_reconciles(revenue.revenue_movements(versions, LAST_DAY), accounts)
        return found.withColumn("history", F.lit("reactivations" if reactivations else "plain"))

    return check(True).unionByName(check(False))


@query
def churn_at_peak_mrr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return revenue.churn_at_peak_mrr(_versions(spark, sf_dir, True))


@query
def hard_delete_churn(spark: SparkSession, sf_dir: str) -> DataFrame:
    states = src.history_states(spark, sf_dir, reactivations=True)
    return revenue.hard_delete_churn(history.scd2_from_daily_states(states, detect_deletes=True))


# --- overview


@query
def usage_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return usage.usage_windows(models(spark, sf_dir).daily_usage, TODAY)


@query
def lifetime_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overview.lifetime_revenue(staging.stg_invoices(src.raw_invoices(spark, sf_dir)))


@query
def primary_contact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overview.primary_contact(staging.stg_contacts(src.raw_contacts(spark, sf_dir)))


@query
def account_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return for_overview(spark, sf_dir).overview.drop("refreshed_at")


@query
def account_limits_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return for_overview(spark, sf_dir).overview.select(
        "hubspot_company_id",
        "credit_usage_pct",
        "seat_usage_pct",
        "tenure_days",
        "days_since_last_active",
    )


@query
def account_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return for_overview(spark, sf_dir).overview.select("hubspot_company_id", "account_segment")


# --- activation


@query
def company_property_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    payload = activation.company_property_payload(for_overview(spark, sf_dir).overview, SYNCED_AT)
    return payload.select("id", F.to_json("properties").alias("properties"))


@query
def payload_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = models(spark, sf_dir, (*SHARED_BY_OVERVIEW, "overview"))
    payload = activation.company_property_payload(m.overview, SYNCED_AT)
    return activation.payload_batches(payload).select(
        "batch_no", "size", F.to_json("inputs").alias("inputs")
    )


def _deal_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = src.raw_deals(spark, sf_dir)
    return staging.stg_deal_accounts(raw, src.DEAL_ACCOUNT_PROPERTY)


@query
def new_pql_deals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return activation.new_pql_deals(models(spark, sf_dir).leads, _deal_accounts(spark, sf_dir))


@query
def deal_associations(spark: SparkSession, sf_dir: str) -> DataFrame:
    fresh = activation.new_pql_deals(models(spark, sf_dir).leads, _deal_accounts(spark, sf_dir))
    return activation.deal_associations(fresh)


@query
def deal_follow_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    deals = staging.stg_deals(src.raw_deals(spark, sf_dir))
    return activation.deal_follow_up(models(spark, sf_dir).leads, deals, _deal_accounts(spark, sf_dir))


@query
def deal_value_estimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    companies = staging.stg_companies(src.raw_companies(spark, sf_dir))
    return companies.select(
        "company_id",
        "employees",
        activation.deal_value_estimate(F.col("employees")).alias("deal_value_usd"),
    )


@query
def deal_sync_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = for_overview(spark, sf_dir)
    decided = activation.deal_decisions(m.leads, _deal_accounts(spark, sf_dir))
    return activation.deal_sync_counts(
        activation.company_property_payload(m.overview, SYNCED_AT), decided
    )


# --- quality and validation


@query
def null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = models(spark, sf_dir)
    out = None
    for name in (
        "companies",
        "contacts",
        "deals",
        "customers",
        "subscriptions",
        "invoices",
        "usage_events",
    ):
        profile = quality.null_profile(getattr(m, name), f"stg_{name}")
        out = profile if out is None else out.unionByName(profile)
    return out


@query
def key_uniqueness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per account holds for the accounts; billing customers per invoice do repeat."""
    m = models(spark, sf_dir)
    invoices = staging.stg_invoices(src.raw_invoices(spark, sf_dir))
    return (
        quality.key_uniqueness(m.account_subscriptions, "hubspot_company_id", "account_subscription")
        .unionByName(
            quality.key_uniqueness(m.account_subscriptions, "subscription_id", "account_subscription")
        )
        .unionByName(quality.key_uniqueness(invoices, "customer_id", "stg_invoices"))
    )


@query
def name_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names that many share: the market segment of each customer in place of its own name,
    and on the billing side that of customers with a positive balance."""
    customer = src.table(spark, sf_dir, "customer")
    return quality.name_collisions(
        customer.select(F.col("c_mktsegment").alias("company_name")),
        customer.select(F.expr("if(c_acctbal > 0, c_mktsegment, c_name)").alias("customer_name")),
    )


@query
def unattributed_and_late_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.unattributed_and_late_events(src.raw_usage_events(spark, sf_dir))


@query
def validate_against_answer_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.validate_against_answer_key(
        src.answer_key(spark, sf_dir), for_overview(spark, sf_dir).overview
    )


@query
def match_type_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identity.match_type_coverage(models(spark, sf_dir).identity)


@query
def orphan_billing(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = models(spark, sf_dir)
    return quality.orphan_billing(m.subscriptions, m.invoices, m.customers)


@query
def event_type_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.event_type_counts(src.raw_usage_events(spark, sf_dir))


@query
def duplicate_contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.duplicate_contacts(staging.stg_contacts(src.raw_contacts(spark, sf_dir)))


@query
def domain_from_name_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.domain_from_name_check(staging.stg_companies(src.raw_companies(spark, sf_dir)))


def _usage_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = for_overview(spark, sf_dir)
    users = usage.active_users_exact(m.usage_events, m.identity, TODAY, days=30)
    return usage.account_usage_state(m.account_subscriptions, m.daily_usage, users, TODAY)


@query
def account_usage_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _usage_state(spark, sf_dir)


@query
def plan_pressure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pressure.plan_pressure(_usage_state(spark, sf_dir), seeds.seed_plans(spark))


# --- pages


@query
def kpi_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reads.kpi_cards(for_overview(spark, sf_dir).overview)


@query
def segment_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reads.segment_summary(for_overview(spark, sf_dir).overview)


@query
def plan_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reads.plan_summary(for_overview(spark, sf_dir).overview)


@query
def account_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accounts on a self-serve paid plan that used the product lately, by a search text."""
    return reads.account_filter(
        for_overview(spark, sf_dir).overview, TODAY, search="CUSTOMER#", plan="pro", active_within_days=14
    )


@query
def usage_chart_30d(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = models(spark, sf_dir)
    return usage.usage_chart_30d(m.daily_usage, m.identity, TODAY)


@query
def account_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The page of every account."""
    m = models(spark, sf_dir, (*SHARED_BY_OVERVIEW, "overview"))
    pages = reads.account_detail(m.overview, m.daily_usage, TODAY)
    return pages.select(
        "hubspot_company_id",
        *[f"{section}.{c}" for section, columns in reads.DETAIL_SECTIONS.items() for c in columns],
        F.to_json("daily").alias("daily"),
    )


# --- incremental and streaming


@query
def incremental_daily_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in three batches by arrival, the last one twice; late ones reopen past days."""
    events = src.raw_usage_events(spark, sf_dir)
    who = models(spark, sf_dir).identity
    root = fresh_folder(spark, "incremental")
    cuts = ["2024-01-12 00:00:00", "2024-01-22 06:00:00"]
    arrived = F.col("ingested_at")
    batches = [
        events.where(arrived < cuts[0]),
        events.where((arrived >= cuts[0]) & (arrived < cuts[1])),
        events.where(arrived >= cuts[1]),
    ]
    log, daily = f"{root}/events", f"{root}/daily"
    for batch in [*batches, batches[-1]]:
        incremental.incremental_daily_usage(batch, log, daily)
    return usage.attribute_usage(incremental.read_domain_usage(spark, daily), who)


@query
def streaming_daily_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event table, a file or a folder, read as a stream in batches of any order: its final
    days, and the open ones from the stream's state. Every file is read once."""
    schema = src.table(spark, sf_dir, "events").schema
    # A pattern, as a stream takes a plain path for a folder and the table may be one file.
    rows = spark.readStream.schema(schema).parquet(f"{sf_dir}/[e]vents.parquet")
    arrivals = staging.stg_usage_events(src.usage_events_from(rows))
    root = fresh_folder(spark, "stream")
    days = incremental.streaming_daily_usage(arrivals, incremental.ANY_ORDER)
    running = incremental.write_daily_stream(days, f"{root}/days", f"{root}/state", available_now=True)
    running.awaitTermination()
    return incremental.daily_so_far(spark, f"{root}/days", f"{root}/state")


# --- extensions


@query
def identity_normalised_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Billing names spelled differently: a suffix, other case, punctuation."""
    m = models(spark, sf_dir)
    spelled = m.customers.withColumn(
        "customer_name", F.concat(F.upper("customer_name"), F.lit(", Inc."))
    )
    return identity.identity_normalised_name(m.companies, spelled)


@query
def health_low_usage_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    return health.health_low_usage_rule(for_overview(spark, sf_dir).overview)


@query
def active_users_exact_14d(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = models(spark, sf_dir)
    return usage.active_users_exact_14d(m.usage_events, m.identity, TODAY)


@query
def active_users_by_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct users of the last 7, 14 and 30 days, merged from the days' kept sets of users."""
    root = fresh_folder(spark, "kept-usage")
    log, daily = f"{root}/events", f"{root}/daily"
    events = src.raw_usage_events(spark, sf_dir)
    half = F.col("ingested_at") < F.lit("2024-01-20 00:00:00").cast("timestamp")
    for batch in (events.where(half), events.where(~half)):
        incremental.incremental_daily_usage(batch, log, daily)
    sets = incremental.read_user_sets(spark, daily)
    return usage.active_users_by_window(sets, models(spark, sf_dir).identity, TODAY, days=(7, 14, 30))


@query
def equal_health_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = models(spark, sf_dir)
    return health.equal_health_windows(m.account_subscriptions, m.daily_usage, TODAY)


@query
def dq_unattributed_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.dq_unattributed_report(src.raw_usage_events(spark, sf_dir))


@query
def deal_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.deal_funnel(staging.stg_deals(src.raw_deals(spark, sf_dir)))


@query
def short_history_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return health.short_history_flag(for_overview(spark, sf_dir).overview)


@query
def failed_payment_signal(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = models(spark, sf_dir)
    return health.failed_payment_signal(m.account_subscriptions, m.invoices)
