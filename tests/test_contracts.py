import pytest

from riskmart.contracts import CSV_COLUMNS, ENTITIES, GOLD_GRAIN, SPARK_TYPE, csv_schema


def test_entities():
    assert [e.name for e in ENTITIES] == ["customers", "orders", "payments", "chargebacks"]
    assert len({e.topic for e in ENTITIES}) == len(ENTITIES)
    assert [len(e.fields) for e in ENTITIES] == [6, 7, 20, 5]


@pytest.mark.parametrize("entity", ENTITIES, ids=lambda e: e.name)
def test_fields(spark, entity):
    assert entity.key in entity.fields
    assert set(entity.fields.values()) <= set(SPARK_TYPE)
    assert entity.state_schema.names[: len(entity.fields)] == list(entity.fields)
    assert len(entity.state_schema) == len(entity.fields) + 6


def test_gold_grains():
    assert list(GOLD_GRAIN) == ["daily_business_kpis", "daily_fraud_kpis", "seller_performance", "customer_360"]
    assert all(GOLD_GRAIN.values())


def test_csv_columns_are_text():
    assert len(CSV_COLUMNS) == 9
    for table in CSV_COLUMNS:
        assert {f.dataType.simpleString() for f in csv_schema(table)} == {"string"}
