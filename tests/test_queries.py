import pytest

import __spark_entry__ as driver
from compare import connect, differences
from samples import SF_DIR
from duckdb_oracle import ORACLE
from tidemark.plans.registry import QUERIES
from tidemark.schema import GOLD


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", list(QUERIES))
def test_matches_sql(spark, duck, name):
    answer = QUERIES[name](spark, SF_DIR)
    assert differences(answer, duck, ORACLE[name]) == []
    plan = answer._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Python" not in plan


@pytest.mark.parametrize("name", [n for n in QUERIES if n != "gold_retention_orders" and n.startswith("gold_")])
def test_gold_schema(spark, name):
    table = "daily_user_metrics" if name == "gold_daily_from_bronze" else name.removeprefix("gold_")
    got = QUERIES[name](spark, SF_DIR).schema
    assert [(f.name, f.dataType) for f in got] == [(f.name, f.dataType) for f in GOLD[table]]


def test_scans_read_only_the_columns_they_need(spark):
    plan = QUERIES["gold_retention_cohorts"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint>" in plan


def test_entry(spark):
    first = driver.entry(spark)
    assert first.count() == 30 and first.schema == driver.entry(spark).schema
