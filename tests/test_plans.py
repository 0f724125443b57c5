"""What reaches the scan of a silver table, and how often rows are shuffled."""

import re

import pytest

from samples import at
from tidemark.operators.churn import lapsed_users
from tidemark.operators.daily import daily_user_metrics
from tidemark.operators.features import feature_usage
from tidemark.operators.funnel import funnel_metrics
from tidemark.operators.quality import all_checks, freshness_checks
from tidemark.operators.retention import retention_cohorts
from tidemark.operators.revenue import revenue_metrics
from tidemark.sources.lake import SILVER_ORDER, read_silver, write_by_date


@pytest.fixture(scope="module")
def table(spark, silver, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "silver")
    kept = {"event_type": "user_signup", "feature": "like"}  # else adaptive planning empties the plans
    events = [{"event_id": str(n), "event_timestamp": at(n), **kept} for n in range(1, 6)]
    write_by_date(silver(*events), path, SILVER_ORDER)
    return read_silver(spark, path)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def executed_plan_of(df):
    """The plan adaptive execution ended with (it drops pruning subqueries that cannot be reused)."""
    df.collect()
    return plan_of(df).split("Initial Plan")[0]


def scanned(plan):
    """Sorted column lists of the scans."""
    return sorted(sorted(re.findall(r"(\w+):", s)) for s in re.findall(r"ReadSchema: struct<(.*?)>\s", plan))


CASES = {
    daily_user_metrics: ([["duration_seconds", "session_id"], ["user_id"]], 7),
    retention_cohorts: ([["user_id"]], 3),
    funnel_metrics: ([["event_timestamp", "event_type", "user_id"]], 4),
    feature_usage: ([["feature", "user_id"]], 2),
    revenue_metrics: ([["event_type", "revenue", "user_id"]], 2),
    all_checks: ([["event_id"], ["event_timestamp", "event_type", "revenue"]], 4),
    freshness_checks: ([["event_timestamp", "event_type", "revenue"]], 2),
}


@pytest.mark.parametrize("build", CASES, ids=lambda b: b.__name__)
def test_columns_and_shuffles(table, build):
    columns, most_shuffles = CASES[build]
    plan = executed_plan_of(build(table))
    assert scanned(plan) == columns
    assert plan.count(" Exchange ") <= most_shuffles
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Python" not in plan


def test_filters_reach_the_scan(table):
    assert "PushedFilters: [In(event_type" in plan_of(funnel_metrics(table))
    assert "IsNotNull(feature)" in plan_of(feature_usage(table)).split("PushedFilters")[1]
    lapsed = plan_of(lapsed_users(table, "2024-01-01", "2024-01-02", "2024-01-03", "2024-01-04"))
    assert re.search(r"PartitionFilters: \[.*event_date", lapsed)
