import json

import pytest
from pyspark.sql import functions as F

from revlattice.operators import staging
from revlattice.sources import landing, layers, seeds
from tests.conftest import rows, ts


def raw(spark, *documents):
    data = [(str(i), d if isinstance(d, str) or d is None else json.dumps(d), ts("2024-01-01")) for i, d in enumerate(documents)]
    return spark.createDataFrame(data, landing.RAW_SCHEMA)


def test_companies_cast_text_and_survive_bad_values(spark):
    df = staging.stg_companies(
        raw(
            spark,
            {"properties": {"name": "A", "domain": "A.COM", "numberofemployees": "7", "createdate": "2026-09-25T10:11:12.345Z"}},
            {"properties": {"name": "B", "numberofemployees": "12.5", "createdate": "2026-09"}},
            {"properties": {"numberofemployees": 9}},
            "not json",
            None,
        )
    )
    got = rows(df, "company_id", "company_name", "domain", "employees", "created_at")
    assert got == [
        ("0", "A", "a.com", 7, ts("2026-09-25 10:11:12.345")),
        ("1", "B", None, None, None),
        ("2", None, None, 9, None),
        ("3", None, None, None, None),
        ("4", None, None, None, None),
    ]


def test_contacts_domain_is_the_part_after_the_first_at(spark):
    mails = ["no-at", "a@b@c", None, "First.Last@X.COM"]
    df = staging.stg_contacts(raw(spark, *[{"properties": {"email": m}} for m in mails]))
    assert rows(df, "contact_id", "email", "email_domain") == [
        ("0", "no-at", None),
        ("1", "a@b@c", "b"),
        ("2", None, None),
        ("3", "first.last@x.com", "x.com"),
    ]


def test_deals_amount_is_decimal_or_null(spark):
    df = staging.stg_deals(raw(spark, {"properties": {"amount": "18000.5"}}, {"properties": {"amount": "x"}}))
    assert df.schema["amount"].dataType.simpleString() == "decimal(38,9)"
    assert [r.amount and float(r.amount) for r in df.orderBy("deal_id").collect()] == [18000.5, None]


def test_customer_and_invoice_created_is_strict(spark):
    good = staging.stg_customers(raw(spark, {"created": 1766000000, "metadata": {"hubspot_company_id": "5"}}, {"metadata": {}}))
    assert rows(good, "customer_id", "hubspot_company_id", "created_at") == [
        ("0", "5", ts("2025-12-17 19:33:20")),
        ("1", None, None),
    ]
    for stage in (staging.stg_customers, staging.stg_invoices):
        with pytest.raises(Exception, match="not an integer"):
            stage(raw(spark, {"created": "soon"})).collect()
    # Nobody asks for the column, nobody is told: as with a view in SQL.
    assert staging.stg_customers(raw(spark, {"created": "soon"})).select("customer_id").count() == 1


def test_subscription_items(spark):
    item = {"price": {"id": "p", "unit_amount": 2050}, "quantity": 2, "current_period_start": 10}
    df = staging.stg_subscriptions(
        raw(
            spark,
            {"customer": "c", "items": {"data": []}},
            {"customer": "c"},
            {"customer": "c", "items": {"data": [item, {**item, "price": {"id": "q", "unit_amount": "x"}}]}},
            {"created": "bad", "cancel_at_period_end": "yes"},
            {"cancel_at_period_end": True},
        )
    )
    assert rows(df, "subscription_id", "price_id", "monthly_amount_usd", "quantity") == [
        ("0", None, None, None),
        ("1", None, None, None),
        ("2", "p", 20.5, 2),
        ("2", "q", None, 2),
        ("3", None, None, None),
        ("4", None, None, None),
    ]
    flags = rows(df.where("subscription_id >= '3'"), "created_at", "cancel_at_period_end")
    assert flags == [(None, None), (None, True)]


def test_json_is_parsed_once_even_under_filters(spark):
    df = staging.stg_invoices(raw(spark, {"status": "paid", "amount_paid": 5}))
    df = df.where("payment_status = 'paid' AND amount_paid_usd > 0").select("customer_id")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_events_lowered(spark):
    data = [("1", "x", "A.Com", "U@A.com", 1, ts("2024-01-01"), ts("2024-01-01")), ("2", "x", None, None, 0, None, None)]
    from revlattice.sources.usage_log import EVENT_SCHEMA

    df = staging.stg_usage_events(spark.createDataFrame(data, EVENT_SCHEMA))
    assert rows(df, "account_domain", "user_email") == [(None, None), ("a.com", "u@a.com")]


def test_landing_keeps_documents_and_types_empty_dumps(spark, tmp_path):
    dump = tmp_path / "dump"
    dump.mkdir()
    (dump / "a.json").write_text('{"id": "1", "x": {"y": 2}}\n\n{"id": 7}\n')
    landed = landing.land_raw_objects(spark, str(dump), str(tmp_path / "t"), "2024-01-31 05:00:00")
    assert rows(landed, "id", "raw_json") == [("1", '{"id": "1", "x": {"y": 2}}'), ("7", '{"id": 7}')]
    (dump / "a.json").write_text("")
    landed = landing.land_raw_objects(spark, str(dump), str(tmp_path / "t"))
    assert landed.columns == ["id", "raw_json", "extracted_at"] and landed.count() == 0


def test_plans_from_csv_equal_the_built_in_list(spark, tmp_path):
    lines = ["price_id,plan_name,plan_rank,monthly_price_usd,seat_limit,monthly_credits"]
    lines += [",".join(map(str, p)) for p in seeds.PLANS]
    path = tmp_path / "plans.csv"
    path.write_text("\n".join(lines) + "\n")
    listed, read = seeds.seed_plans(spark), seeds.seed_plans(spark, str(path))
    assert rows(listed) == rows(read)
    assert [f.dataType for f in listed.schema] == [f.dataType for f in read.schema]


def test_layers(spark, tmp_path):
    assert layers.layer_name(" Marts ", "x") == "marts" and layers.layer_name(None, "x") == "x"
    df = spark.range(3).withColumn("v", F.col("id") * 2)
    layers.materialise_layer(df, "Intermediate", "numbers", str(tmp_path))
    assert spark.table("intermediate_numbers").count() == 3
    for _ in range(2):  # replacing it is fine
        out = layers.materialise_layer(df, "marts", "numbers", str(tmp_path))
    assert out.count() == 3 and (tmp_path / "marts" / "numbers").exists()


def test_a_released_schema_leaves_the_catalog_but_not_its_readers(spark):
    from revlattice.session import fresh_folder
    from revlattice.sources import layers

    table = layers.materialise_layer(spark.range(5).toDF("n"), "marts", "five", fresh_folder(spark, "tables"), schema="marts_gone")
    assert spark.catalog.databaseExists("marts_gone")
    layers.release_schema(spark, "marts_gone")
    assert not spark.catalog.databaseExists("marts_gone") and table.count() == 5
    before = {d.name for d in spark.catalog.listDatabases()}
    from revlattice.plans.query_list import QUERIES
    from tests.conftest import SF

    assert QUERIES["materialise_layer"](spark, SF).count() > 0
    assert {d.name for d in spark.catalog.listDatabases()} == before
