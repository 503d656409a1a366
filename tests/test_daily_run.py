import json

import pytest

from revlattice.plans import daily
from revlattice.sources import landing
from revlattice.sources import usage_log
from revlattice.sources.seeds import PLANS
from tests.conftest import rows, ts

PRICE = {p[1]: p for p in PLANS}


def land(spark, root, plan_of, deals=()):
    """One company, customer and subscription per entry of `plan_of`."""

    def epoch(text):
        return int(ts(text + "+00:00").timestamp())

    objects = {
        "hubspot_companies": [{"id": k, "properties": {"name": f"N{k}", "domain": f"{k}.com", "numberofemployees": "60"}} for k in plan_of],
        "hubspot_contacts": [{"id": f"p{k}", "properties": {"email": f"x@{k}.com", "firstname": "A", "lastname": "B"}} for k in plan_of],
        "hubspot_deals": [{"id": f"d{k}", "properties": {"revlattice_company_id": k}} for k in deals],
        "stripe_customers": [{"id": f"c{k}", "name": f"N{k}", "created": 1, "metadata": {"hubspot_company_id": k}} for k in plan_of],
        "stripe_subscriptions": [
            {
                "id": f"s{k}", "customer": f"c{k}", "status": "active", "created": epoch("2024-01-01"),
                "items": {"data": [{"price": {"id": PRICE[p][0], "unit_amount": PRICE[p][3] * 100}}]},
            }
            for k, p in plan_of.items()
        ],
        "stripe_invoices": [{"id": "i", "customer": "ca", "status": "paid", "amount_paid": 2000, "created": 1}],
    }
    for name, items in objects.items():
        folder = root / "dump" / name
        folder.mkdir(parents=True, exist_ok=True)
        (folder / "part.json").write_text("\n".join(json.dumps(i) for i in items))
        landing.land_raw_objects(spark, str(folder), f"{root}/raw_{name}")


def events(spark, date):
    out = [
        (f"{date}-{u}-{i}", "teammate_invited" if i == 0 else "prompt_run", "A.com", f"u{u}@a.com", 20, ts(f"{date} 10:00:0{u}"), ts(f"{date} 10:00:09"))
        for u in range(3)
        for i in range(3)
    ]
    return spark.createDataFrame(out, usage_log.EVENT_SCHEMA)


def test_two_days_and_a_repeat(spark, tmp_path):
    root = str(tmp_path)
    land(spark, tmp_path, {"a": "free", "b": "team"})
    first = daily.run_day(spark, root, "2024-01-08", events(spark, "2024-01-07"))
    assert first.failed_checks == []

    land(spark, tmp_path, {"a": "pro", "b": "team"}, deals=["b"])
    for _ in range(2):
        second = daily.run_day(spark, root, "2024-01-15", events(spark, "2024-01-14"), previous_run="2024-01-08")
        assert second.failed_checks == []
        read = lambda name: spark.read.parquet(f"{second.folder}/{name}")
        assert rows(read("overview"), "hubspot_company_id", "plan_name", "current_mrr_usd", "account_segment") == [
            ("a", "pro", 20.0, "sales opportunity"), ("b", "team", 100.0, "at risk"),
        ]
        # The free account's move to pro is new revenue of its week.
        assert rows(read("revenue_movements"), "new_mrr", "ending_mrr") == [(0.0, 100.0), (100.0, 100.0), (20.0, 120.0)]
        assert rows(read("new_deals"), "revlattice_company_id") == [("a",)]
        assert read("company_payload_batches").first()["size"] == 2
        assert usage_log.read_usage_log(spark, f"{root}/usage_log").count() == 18


def test_repeated_accounts_stop_the_run_before_the_overview(spark, tmp_path):
    root = str(tmp_path)
    land(spark, tmp_path, {"a": "pro"})
    folder = tmp_path / "dump" / "stripe_customers"
    twice = [{"id": c, "name": "N", "created": 1, "metadata": {"hubspot_company_id": "a"}} for c in ("ca", "cz")]
    (folder / "part.json").write_text("\n".join(json.dumps(i) for i in twice))
    landing.land_raw_objects(spark, str(folder), f"{root}/raw_stripe_customers")
    with pytest.raises(daily.ChecksFailed, match="key_uniqueness"):
        daily.run_day(spark, root, "2024-01-08", events(spark, "2024-01-07"))
    assert not (tmp_path / "published" / "run=2024-01-08" / "overview").exists()
    # Let through, the account has a row for each of its two customers, not for each pair.
    daily.run_day(spark, root, "2024-01-08", allow_repeated_accounts=True)
    assert spark.read.parquet(f"{root}/published/run=2024-01-08/overview").count() == 2


def test_a_revenue_mismatch_stops_the_payloads(spark, tmp_path):
    root = str(tmp_path)
    land(spark, tmp_path, {"a": "pro", "b": "team"})
    daily.run_day(spark, root, "2024-01-08", events(spark, "2024-01-07"))
    land(spark, tmp_path, {"a": "pro"})  # an active subscription is deleted: no churn is booked
    with pytest.raises(daily.ChecksFailed, match="revenue_reconciles"):
        daily.run_day(spark, root, "2024-01-15", previous_run="2024-01-08")
    assert not (tmp_path / "published" / "run=2024-01-15" / "new_deals").exists()


def test_crowded_names_stop_the_run_before_they_are_paired(spark, tmp_path):
    root = str(tmp_path)
    land(spark, tmp_path, {"a": "pro", "b": "free"})
    for name, key, made in (
        ("hubspot_companies", "properties", [{"id": f"x{i}", "properties": {"name": "Same", "domain": f"x{i}.com"}} for i in range(6)]),
        ("stripe_customers", "metadata", [{"id": f"cx{i}", "name": "Same", "created": 1, "metadata": {}} for i in range(5)]),
    ):
        (tmp_path / "dump" / name / "more.json").write_text("\n".join(json.dumps(i) for i in made))
        landing.land_raw_objects(spark, str(tmp_path / "dump" / name), f"{root}/raw_{name}")
    with pytest.raises(daily.ChecksFailed, match="crowded_names"):
        daily.run_day(spark, root, "2024-01-08", events(spark, "2024-01-07"), max_name_pairs=29)
    found = spark.read.parquet(f"{root}/published/run=2024-01-08/check_crowded_names")
    assert rows(found, "name", "pairs") == [("Same", 30)]
    assert not (tmp_path / "published" / "run=2024-01-08" / "identity").exists()
    # Asked for, they are matched in full.
    daily.run_day(spark, root, "2024-01-08", max_name_pairs=None, allow_repeated_accounts=True)
    identity = spark.read.parquet(f"{root}/published/run=2024-01-08/identity")
    assert identity.where("company_name = 'Same'").count() == 30


def test_checks_ride_along_with_the_writing(spark, tmp_path):
    from revlattice.operators import quality
    from revlattice.operators.staging import stg_usage_events

    root, batch = str(tmp_path), events(spark, "2024-01-07")
    land(spark, tmp_path, {"a": "pro", "b": "free"})
    folder = daily.run_day(spark, root, "2024-01-08", batch).folder
    read = lambda name: spark.read.parquet(f"{folder}/{name}")
    scanned = None
    for name in daily.STAGED:
        profile = quality.null_profile(read(name), f"stg_{name}")
        scanned = profile if scanned is None else scanned.unionByName(profile)
    assert rows(read("check_null_profile")) == rows(scanned)
    assert rows(read("check_new_events")) == rows(quality.unattributed_and_late_events(stg_usage_events(batch)))
    # The same batch again brings no event.
    daily.run_day(spark, root, "2024-01-08", batch)
    assert rows(read("check_new_events"), "events") == [(0,)]
