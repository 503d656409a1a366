"""One day's run: usage, snapshot, models, checks, and only then the payloads.

Folders below `root`, all on storage every executor reaches:

    raw_<object>/                      landed JSON objects, replaced by each extract
    usage_log/                         raw events, in committed parts
    domain_usage/                      daily facts per domain, in committed parts that add up
    snapshots/run=<label>/             subscription history, one folder per run
    snapshots-movements/run=<label>/   what a run adds to the weeks' revenue movements
    snapshots-gone/run=<label>/        last versions of subscriptions that are away
    published/run=<label>/<model>/     models and payloads of that run
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from revlattice.operators import activation, history, quality, revenue, staging
from revlattice.plans.models import Models
from revlattice.session import apply_rules
from revlattice.sources import landing, seeds
from revlattice.streaming import incremental


#: Staged models that a run stores, and profiles meanwhile.
STAGED = ("companies", "customers", "subscriptions")
#: Pairs that one name may give in a match by name before a run stops.
MAX_NAME_PAIRS = 10_000


class ChecksFailed(Exception):
    """Raised before anything is activated; names the checks with findings."""


@dataclass
class DayResult:
    folder: str
    failed_checks: list[str] = field(default_factory=list)


def raw_inputs(spark: SparkSession, root: str, plans_path: str | None = None) -> dict:
    def landed(name: str):
        return lambda: landing.read_raw(spark, f"{root}/raw_{name}")

    return {
        "companies": landed("hubspot_companies"),
        "contacts": landed("hubspot_contacts"),
        "deals": landed("hubspot_deals"),
        "customers": landed("stripe_customers"),
        "subscriptions": landed("stripe_subscriptions"),
        "invoices": landed("stripe_invoices"),
        "domain_usage": lambda: incremental.read_domain_usage(spark, f"{root}/domain_usage"),
        "plans": lambda: seeds.seed_plans(spark, plans_path),
    }


def run_day(
    spark: SparkSession,
    root: str,
    as_of: str,
    new_events: DataFrame | None = None,
    previous_run: str | None = None,
    plans_path: str | None = None,
    run_at: str | None = None,
    allow_repeated_accounts: bool = False,
    max_name_pairs: int | None = MAX_NAME_PAIRS,
) -> DayResult:
    """Run the day `as_of` (`yyyy-mm-dd`, also the run's label).

    Repeating a day with the same inputs replaces that day's results and adds nothing.
    A name that many companies share with many customers matches each of them with each, so names
    with more than `max_name_pairs` pairs stop the run before accounts are matched; they are counted, not
    paired. With None such a name is matched in full, whatever it costs.
    Accounts that occur more than once multiply rows in the overview, so they stop the run
    before it is built unless `allow_repeated_accounts` is set. Other findings are reported
    in the result, and a revenue mismatch stops the run before the payloads.
    """
    apply_rules(spark)
    run_at = run_at or f"{as_of} 00:00:00"
    folder = f"{root}/published/run={as_of}"
    result = DayResult(folder)

    watch = quality.Watch()
    if new_events is not None:
        incremental.incremental_daily_usage(
            new_events, f"{root}/usage_log", f"{root}/domain_usage", watch.over_events
        )

    def publish(name: str, df: DataFrame) -> DataFrame:
        if name in STAGED:
            df = watch.over(df, f"stg_{name}")
        df.write.mode("overwrite").parquet(f"{folder}/{name}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{name}")

    models = Models(
        raw_inputs(spark, root, plans_path),
        as_of,
        run_at,
        written=(
            *STAGED,
            "identity",
            "daily_usage",
            "account_subscriptions",
            "health",
            "leads",
        ),
        write=publish,
    )

    def found(name: str, findings: DataFrame) -> bool:
        if publish(f"check_{name}", findings).isEmpty():
            return False
        result.failed_checks.append(name)
        return True

    if max_name_pairs is not None and found(
        "crowded_names", quality.crowded_names(models.companies, models.customers, max_name_pairs)
    ):
        raise ChecksFailed(f"{result.failed_checks}: see {folder}")

    # Counted while they were written. Findings here are for people to read; they stop nothing.
    for name in STAGED:
        getattr(models, name)
    publish("check_null_profile", watch.profile(spark))
    publish("check_new_events", watch.event_summary(spark))

    # The snapshot comes first, so today's changes reach today's revenue.
    history.run_snapshot(
        history.snapshot_input(models.account_subscriptions),
        f"{root}/snapshots",
        as_of,
        run_at,
        previous_run,
    )

    repeated = quality.key_uniqueness(
        models.account_subscriptions, "hubspot_company_id", "account_subscriptions"
    )
    if found("key_uniqueness", repeated) and not allow_repeated_accounts:
        raise ChecksFailed(f"{result.failed_checks}: see {folder}")

    revenue.keep_movements(spark, f"{root}/snapshots", as_of, run_at)
    publish("revenue_movements", revenue.kept_revenue_movements(spark, f"{root}/snapshots", as_of, as_of))
    overview = publish("overview", models.overview)
    movements = spark.read.parquet(f"{folder}/revenue_movements")
    if found("revenue_reconciles", quality.revenue_reconciles(movements, overview)):
        raise ChecksFailed(f"{result.failed_checks}: see {folder}")

    payload = activation.company_property_payload(overview, run_at)
    publish("company_payload_batches", activation.payload_batches(payload))
    raw_deals = models.raw["deals"]()
    deal_accounts = staging.stg_deal_accounts(raw_deals, f"{activation.PROPERTY_PREFIX}company_id")
    publish("new_deals", activation.new_pql_deals(models.leads, deal_accounts))
    decisions = activation.deal_decisions(models.leads, deal_accounts)
    publish("deal_sync_counts", activation.deal_sync_counts(payload, decisions))
    publish("deal_follow_up", activation.deal_follow_up(models.leads, staging.stg_deals(raw_deals), deal_accounts))
    return result
