"""A third of all rows on one key must not travel as a third of all rows."""

import pytest
from pyspark.sql import functions as F

from samples import AS_OF, EVENT
from tidemark.operators.clean import clean_events, quality_report
from tidemark.operators.daily import daily_user_metrics, session_days
from tidemark.operators.features import feature_usage
from tidemark.operators.funnel import funnel_metrics
from tidemark.operators.quality import all_checks
from tidemark.operators.retention import retention_cohorts
from tidemark.operators.revenue import revenue_metrics
from tidemark.schema import EVENT_COLUMNS

ROWS, MAPS, DAYS = 24_000, 4, 5


def _nodes(plan):
    yield plan
    name = plan.getClass().getSimpleName()
    inner = [plan.executedPlan()] if name == "AdaptiveSparkPlanExec" else [plan.plan()] if "QueryStage" in name else []
    children = plan.children()
    for child in inner + [children.apply(i) for i in range(children.size())]:
        yield from _nodes(child)


def shuffled_records(df):
    """Rows written by each shuffle of an executed query, largest first."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    written = [
        node.metrics().get("shuffleRecordsWritten").get().value()
        for node in _nodes(plan)
        if node.getClass().getSimpleName() == "ShuffleExchangeExec"
    ]
    return sorted(written, reverse=True)


@pytest.fixture(scope="module")
def events(spark, tmp_path_factory):
    """Every key column is hot: a third of the rows share one id, user, session and feature."""
    path = str(tmp_path_factory.mktemp("skew") / "events")
    hot = F.col("id") % 3 == 0
    key = lambda name: F.when(hot, F.lit(f"{name}_hot")).otherwise(F.concat(F.lit(f"{name}_"), "id"))
    second = F.timestamp_seconds(F.lit(1704067200) + (F.col("id") % DAYS) * 86400 + F.col("id"))
    values = {name: F.lit(value) for name, value in EVENT.items() if name != "metadata"}
    values |= {
        "event_id": key("e"),
        "user_id": key("u"),
        "session_id": key("s"),
        "feature": key("f"),
        "event_type": F.when(F.col("id") % 2 == 0, "user_signup").otherwise("profile_view"),
        "event_timestamp": F.date_format(second, "yyyy-MM-dd'T'HH:mm:ss'Z'"),
        "metadata": F.struct(F.lit("A").alias("experiment_group"), F.lit("x").alias("referrer")),
    }
    values |= {name: values[name].cast("string") for name in ("page", "post_id", "creator_id")}
    frame = spark.range(0, ROWS, 1, MAPS).select(*[values[c].alias(c) for c in EVENT_COLUMNS])
    frame.write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def clean(events):
    time = F.try_to_timestamp("event_timestamp")
    return events.withColumn("event_timestamp", time).withColumn("event_date", F.to_date("event_timestamp"))


COLD = ROWS * 2 // 3


@pytest.mark.parametrize(
    "build", [lambda e: clean_events(e, AS_OF), lambda e: quality_report(e, AS_OF), lambda e: all_checks(e, as_of=AS_OF)]
)
def test_a_hot_id_leaves_each_map_task_once(events, clean, build):
    source = clean if "all_checks" in build.__code__.co_names else events
    assert COLD < shuffled_records(build(source))[0] <= COLD + MAPS


@pytest.mark.parametrize(
    "build", [daily_user_metrics, retention_cohorts, funnel_metrics, feature_usage, revenue_metrics, session_days]
)
def test_hot_users_sessions_and_features_combine_before_the_shuffle(clean, build):
    # At most one row per date and map task for the hot key, and two grouped calendars beside it.
    assert shuffled_records(build(clean))[0] <= COLD + MAPS * (DAYS + 1) * 2


def test_hot_rows_are_all_counted(events, clean):
    lines = {r.line: r.row_count for r in quality_report(events, AS_OF).collect()}
    assert lines["dropped_duplicates"] == ROWS // 3 - 1 and lines["clean_count"] == COLD + 1
    assert daily_user_metrics(clean).agg(F.sum("total_events")).first()[0] == ROWS
    assert feature_usage(clean).agg(F.sum("event_count")).first()[0] == ROWS
