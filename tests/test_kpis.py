from datetime import date, timedelta

from samples import rows
from tidemark.plans import kpis
from tidemark.schema import GOLD


def d(n):
    return date(2024, 1, 1) + timedelta(days=n - 1)


def table(spark, name, *records):
    """Rows of a metric table; columns not given are zero."""
    schema = GOLD[name]
    zero = {"bigint": 0, "int": 0, "double": 0.0, "string": "", "boolean": False, "date": None}
    full = [{f.name: zero[f.dataType.simpleString()] for f in schema} | r for r in records]
    return spark.createDataFrame([tuple(r[f.name] for f in schema) for r in full], schema)


def ordered(df):
    return [tuple(r) for r in df.collect()]


def test_latest_rows_and_limits(spark):
    daily = table(spark, "daily_user_metrics", *[{"event_date": d(n), "daily_active_users": n} for n in (3, 1, 40, 2)])
    assert ordered(kpis.latest_active_users(daily))[0][:2] == (d(40), 40)
    assert [r[1] for r in ordered(kpis.dau_trend(daily, 3))] == [40, 3, 2]
    assert [r[0] for r in ordered(kpis.stickiness_trend(daily))] == [d(1), d(2), d(3), d(40)]


def test_new_vs_returning_adds_up(spark):
    daily = table(spark, "daily_user_metrics", {"event_date": d(1), "new_users": 2, "returning_users": 5})
    assert ordered(kpis.new_vs_returning(daily)) == [(d(1), 2, 5, 7)]


def test_growth_counts_rows_and_survives_zero(spark):
    users = [0, 10, 10, 10, 10, 10, 10, 5, 20]
    daily = table(
        spark, "daily_user_metrics", *[{"event_date": d(2 * n), "daily_active_users": u} for n, u in enumerate(users, 1)]
    )
    got = ordered(kpis.week_over_week_growth(daily))
    assert [r[2] for r in got] == [None] * 7 + [0, 10]
    assert [r[3] for r in got[7:]] == [None, 1.0]


def test_retention_averages_weigh_cohorts_that_have_a_row(spark):
    retention = table(
        spark,
        "retention_cohorts",
        {"signup_date": d(1), "retention_day": 0, "cohort_size": 10, "retained_users": 10, "retention_rate": 1.0},
        {"signup_date": d(2), "retention_day": 0, "cohort_size": 30, "retained_users": 30, "retention_rate": 1.0},
        {"signup_date": d(2), "retention_day": 1, "cohort_size": 30, "retained_users": 3, "retention_rate": 0.1},
    )
    assert ordered(kpis.average_retention(retention)) == [(0, 40, 40, 1.0), (1, 3, 30, 0.1)]
    assert ordered(kpis.overall_retention(retention)) == [(0, 1.0), (1, 0.1)]
    assert ordered(kpis.retention_pivot(retention)) == [(d(1), None, None, None), (d(2), 0.1, None, None)]
    assert ordered(kpis.retention_heatmap(retention)) == [(d(1), 1.0, None, None, None), (d(2), 1.0, 0.1, None, None)]
    empty = table(spark, "retention_cohorts", {"signup_date": d(1), "retention_day": 7})
    assert ordered(kpis.average_retention(empty)) == [(7, 0, 0, 0.0)]


def test_worst_cohorts_break_ties_by_date(spark):
    retention = table(
        spark,
        "retention_cohorts",
        *[{"signup_date": d(n), "retention_day": 1, "retention_rate": 0.5 if n > 1 else 0.9} for n in range(12, 0, -1)],
    )
    assert [r[0] for r in ordered(kpis.worst_cohorts(retention))] == [d(n) for n in range(2, 12)]


def test_funnel_reports(spark):
    steps = [("user_signup", 1, 1.0, 0.0), ("profile_view", 2, 0.5, 0.5), ("post_created", 3, 0.25, 0.5)]
    funnel = table(
        spark,
        "funnel_metrics",
        *[
            {"event_date": d(n), "funnel_step": s, "step_order": o, "conversion_rate": c, "drop_off_rate": x}
            for n in (1, 2)
            for s, o, c, x in steps[: 4 - n]
        ],
    )
    assert [r[0] for r in ordered(kpis.latest_funnel(funnel))] == ["user_signup", "profile_view"]
    assert len(ordered(kpis.funnel_for_cohort(funnel, "2024-01-01"))) == 3
    assert ordered(kpis.average_conversion(funnel))[1] == ("profile_view", 2, 0.5)
    assert [r[0] for r in ordered(kpis.worst_drop_off(funnel))] == ["profile_view", "post_created"]
    assert ordered(kpis.conversion_trend(funnel, "post_created")) == [(d(1), 0.25)]
    assert ordered(kpis.cohort_dates(funnel)) == [(d(2),), (d(1),)]
    assert len(ordered(kpis.drop_off_by_step(funnel))) == 3


def test_top_features_add_user_days_and_break_ties_by_name(spark):
    features = table(
        spark,
        "feature_usage",
        *[{"event_date": d(n), "feature": f, "event_count": 5, "unique_users": 2} for n in (1, 2) for f in "cab"],
    )
    assert ordered(kpis.top_features(features, 2)) == [("a", 10, 4), ("b", 10, 4)]
    daily = table(spark, "daily_user_metrics", {"event_date": d(1), "daily_active_users": 4})
    assert ordered(kpis.feature_adoption(features, daily))[0] == (d(1), "a", 2, 4, 0.5)


def test_revenue_reports(spark):
    revenue = table(
        spark,
        "revenue_metrics",
        {"event_date": d(1), "total_revenue": 9.0, "paying_users": 3, "subscription_starts": 2, "subscription_cancellations": 5},
        {"event_date": d(2)},
    )
    daily = table(spark, "daily_user_metrics", {"event_date": d(1), "daily_active_users": 4}, {"event_date": d(3), "total_events": 8})
    assert [r[3] for r in ordered(kpis.arpu_and_arppu(revenue))] == [None, 3.0]
    assert [r[3] for r in ordered(kpis.net_subscriptions(revenue))] == [-3, 0]
    assert [(r.event_date, r.total_revenue) for r in kpis.business_summary(daily, revenue).collect()] == [(d(3), None), (d(1), 9.0)]
    assert ordered(kpis.kpi_snapshot(daily, revenue)) == [(d(3), 0, 0, 8, 0.0)]
    assert rows(kpis.subscriptions_long(revenue))[0] == (d(1), "subscription_cancellations", 5)
    no_revenue = table(spark, "revenue_metrics")
    assert ordered(kpis.kpi_snapshot(daily, no_revenue)) == [(d(3), 0, 0, 8, None)]


def test_anomaly_reports(spark):
    anomalies = table(
        spark,
        "anomaly_detection",
        *[{"event_date": d(n), "metric_name": m, "is_anomaly": n == 2} for n in (1, 2) for m in ("b", "a")],
    )
    assert [r[:2] for r in ordered(kpis.flagged_anomalies(anomalies))] == [(d(2), "a"), (d(2), "b")]
    assert ordered(kpis.anomaly_counts(anomalies)) == [(2, 4)]
    assert ordered(kpis.metric_names(anomalies)) == [("a",), ("b",)]
    assert [r[3] for r in ordered(kpis.anomaly_series(anomalies, "a"))] == [False, True]
