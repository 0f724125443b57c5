import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from samples import at, rows
from tidemark.operators.anomaly import anomaly_report, anomaly_report_from_user_days, score_metric
from tidemark.operators.churn import lapsed_users
from tidemark.operators.daily import active_users, daily_user_metrics, session_days
from tidemark.operators.features import feature_usage
from tidemark.operators.funnel import first_steps_from_user_days, funnel_from_first_steps, funnel_metrics
from tidemark.operators.retention import retention_cohorts
from tidemark.operators.revenue import revenue_metrics
from tidemark.operators.user_days import user_days
from tidemark.schema import FUNNEL_STEPS, GOLD

DAY = date(2024, 1, 1)


def day(n):
    return DAY + timedelta(days=n - 1)


def daily_rows(spark, activity):
    df = spark.createDataFrame([(u, day(d)) for u, d in activity], "user_id string, event_date date")
    return {r.event_date: r for r in active_users(df.groupBy("user_id", "event_date").agg(F.count("*").alias("events"))).collect()}


def assert_schema(df, name):
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in GOLD[name]]


# --- daily ------------------------------------------------------------------------------


def test_window_edges(spark):
    table = daily_rows(spark, [("a", 1), ("b", 7), ("b", 8), ("b", 30), ("b", 31)])
    assert set(table) == {day(1), day(7), day(8), day(30), day(31)}
    assert [table[day(d)].weekly_active_users for d in (1, 7, 8, 30, 31)] == [1, 2, 1, 1, 1]
    assert [table[day(d)].monthly_active_users for d in (1, 7, 8, 30, 31)] == [1, 2, 2, 2, 1]
    assert [table[day(d)].new_users for d in (1, 7, 8, 30, 31)] == [1, 1, 0, 0, 0]
    assert [table[day(d)].returning_users for d in (1, 7, 8, 30, 31)] == [0, 0, 1, 1, 1]
    assert table[day(7)].dau_mau_stickiness == 0.5


@pytest.mark.parametrize("seed", range(4))
def test_rolling_counts_match_brute_force(spark, seed):
    rng = random.Random(seed)
    activity = [(f"u{rng.randrange(25)}", rng.randrange(1, 120)) for _ in range(rng.choice([5, 80, 400]))]
    table = daily_rows(spark, activity)
    seen = {(u, day(d)) for u, d in activity}
    assert set(table) == {d for _, d in seen}
    for when, row in table.items():
        for k, got in ((7, row.weekly_active_users), (30, row.monthly_active_users)):
            assert got == len({u for u, d in seen if timedelta(0) <= when - d < timedelta(days=k)})
        assert row.daily_active_users == len({u for u, d in seen if d == when})
        assert row.daily_active_users == row.new_users + row.returning_users
        assert row.daily_active_users <= row.weekly_active_users <= row.monthly_active_users


def test_sessions(silver):
    df = silver(
        {"event_id": "1", "session_id": "s", "duration_seconds": 10, "event_timestamp": at(1, "23:50:00")},
        {"event_id": "2", "session_id": "s", "duration_seconds": 30, "event_timestamp": at(1, "23:55:00")},
        {"event_id": "3", "session_id": "s", "duration_seconds": 7, "event_timestamp": at(2, "00:01:00")},
        {"event_id": "4", "session_id": None, "duration_seconds": 50, "event_timestamp": at(1)},
        {"event_id": "5", "session_id": "t", "duration_seconds": None, "event_timestamp": at(1)},
    )
    assert rows(session_days(df)) == [(day(1), 2, 40.0), (day(2), 1, 7.0)]
    table = daily_user_metrics(df)
    assert_schema(table, "daily_user_metrics")
    assert rows(table, "event_date", "total_sessions", "total_events") == [(day(1), 2, 4), (day(2), 1, 1)]


def test_user_days_with_one_hot_user(silver):
    df = silver(*[{"event_id": str(i), "user_id": "hot" if i % 3 else f"u{i}", "event_timestamp": at(1 + i % 2)} for i in range(60)])
    table = {r.event_date: r for r in daily_user_metrics(df).collect()}
    assert sum(r.total_events for r in table.values()) == 60
    assert table[day(1)].new_users == 11 and table[day(2)].returning_users == 1


def test_daily_plan_has_no_nested_loop_or_cartesian_join(silver):
    plan = daily_user_metrics(silver({}))._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert plan.count("Exchange hashpartitioning") <= 6


# --- retention --------------------------------------------------------------------------


def test_retention_is_sparse_and_counts_users_once(spark):
    activity = [("a", 1), ("a", 1), ("a", 2), ("a", 8), ("b", 1), ("c", 3), ("c", 33), (None, 1)]
    df = spark.createDataFrame([(u, day(d)) for u, d in activity], "user_id string, event_date date")
    table = retention_cohorts(df)
    assert_schema(table, "retention_cohorts")
    assert rows(table) == [
        (day(1), 0, 2, 2, 1.0),
        (day(1), 1, 2, 1, 0.5),
        (day(1), 7, 2, 1, 0.5),
        (day(3), 0, 1, 1, 1.0),
        (day(3), 30, 1, 1, 1.0),
    ]
    assert rows(retention_cohorts(df, days=(2, 7))) == [(day(1), 7, 2, 1, 0.5)]


# --- funnel -----------------------------------------------------------------------------

STEP = dict(zip("12345", FUNNEL_STEPS))


def path(user, *moves):
    """``("3@10:05:00", …)``: step 3 at that time of day 1."""
    for move in moves:
        step, time = move.split("@")
        yield {"event_id": f"{user}{move}", "user_id": user, "event_type": STEP[step], "event_timestamp": at(1, time)}


FUNNEL_CASES = [
    *path("full", "1@10:00:00", "2@10:01:00", "3@10:02:00", "4@10:03:00", "5@10:04:00"),
    *path("ties", "1@10:00:00", "2@10:00:00", "3@10:00:00"),
    *path("swapped", "1@10:00:00", "3@10:01:00", "2@10:02:00"),
    *path("no_signup", "2@10:00:00", "3@10:01:00"),
    *path("view_before_signup", "2@09:00:00", "1@10:00:00", "2@11:00:00"),
    *path("skips", "1@10:00:00", "4@10:01:00"),
]


def test_funnel_enforces_order(silver):
    table = funnel_metrics(silver(*FUNNEL_CASES))
    assert_schema(table, "funnel_metrics")
    got = {r.step_order: r for r in table.collect()}
    assert {k: r.users_reached for k, r in got.items()} == {1: 5, 2: 3, 3: 2, 4: 1, 5: 1}
    assert [got[k].funnel_step for k in range(1, 6)] == list(FUNNEL_STEPS)
    assert got[2].conversion_rate == 0.6 and got[2].drop_off_rate == pytest.approx(0.4)
    assert got[1].drop_off_rate == 0.0 and got[5].drop_off_rate == 0.0
    assert all(0 <= r.drop_off_rate <= 1 for r in got.values())


def test_funnel_leaves_out_steps_nobody_reached(silver):
    cases = [*path("a", "1@10:00:00", "2@10:01:00"), {"event_id": "x", "user_id": "b", "event_type": "user_signup", "event_timestamp": at(2)}]
    assert rows(funnel_metrics(silver(*cases)), "event_date", "step_order") == [(day(1), 1), (day(1), 2), (day(2), 1)]


def test_funnel_from_the_rollup_is_the_same(silver):
    df = silver(*FUNNEL_CASES)
    assert rows(funnel_from_first_steps(first_steps_from_user_days(user_days(df)))) == rows(funnel_metrics(df))


@pytest.mark.parametrize("seed", range(3))
def test_funnel_and_retention_match_brute_force(silver, seed):
    rng = random.Random(seed)
    kinds = [*FUNNEL_STEPS, "user_login"]
    drawn = [
        (f"u{rng.randrange(40)}", rng.choice(kinds), rng.randrange(1, 13), rng.randrange(4)) for _ in range(300)
    ]
    df = silver(
        *[
            {"event_id": str(i), "user_id": u, "event_type": kind, "event_timestamp": at(d, f"1{h}:00:00")}
            for i, (u, kind, d, h) in enumerate(drawn)
        ]
    )
    users = {u for u, *_ in drawn}
    first = {(u, s): min((d, h) for v, kind, d, h in drawn if (v, kind) == (u, s)) for u, s, *_ in drawn}
    reached: dict = {}
    for u in users:
        cohort, before = first.get((u, FUNNEL_STEPS[0])), (0, 0)
        for order, step in enumerate(FUNNEL_STEPS, 1):
            now = first.get((u, step))
            if cohort is None or now is None or now < before:
                break
            reached[(day(cohort[0]), order)] = reached.get((day(cohort[0]), order), 0) + 1
            before = now
    funnel = {(r.event_date, r.step_order): r for r in funnel_metrics(df).collect()}
    assert {k: r.users_reached for k, r in funnel.items()} == reached
    for (cohort, order), row in funnel.items():
        assert row.conversion_rate == pytest.approx(row.users_reached / reached[(cohort, 1)])
        drop = 1 - row.users_reached / reached[(cohort, order - 1)] if order > 1 else 0.0
        assert row.drop_off_rate == pytest.approx(drop)

    active = {(u, d) for u, _, d, _ in drawn}
    signup = {u: min(d for v, d in active if v == u) for u in users}
    expected: dict = {}
    for u, d in active:
        if d - signup[u] in (0, 1, 7, 30):
            key = (day(signup[u]), d - signup[u])
            expected[key] = expected.get(key, 0) + 1
    cohorts = {(r.signup_date, r.retention_day): r for r in retention_cohorts(df).collect()}
    assert {k: r.retained_users for k, r in cohorts.items()} == expected
    assert all(r.cohort_size == expected[(s, 0)] for (s, _), r in cohorts.items())


# --- features and revenue ---------------------------------------------------------------


def test_feature_usage_ignores_events_without_a_feature(silver):
    df = silver(
        {"event_id": "1", "feature": "like"},
        {"event_id": "2", "feature": "like"},
        {"event_id": "3", "feature": "like", "user_id": "u2"},
        {"event_id": "4", "feature": None},
    )
    table = feature_usage(df)
    assert_schema(table, "feature_usage")
    assert rows(table) == [(day(5), "like", 3, 2, 1.5)]


def test_revenue(silver):
    df = silver(
        {"event_id": "1", "revenue": 4.0, "event_type": "subscription_started"},
        {"event_id": "2", "revenue": 2.0, "event_type": "purchase_completed"},
        {"event_id": "3", "user_id": "u2", "event_type": "subscription_cancelled"},
        {"event_id": "4", "user_id": "u3", "event_timestamp": at(6)},
    )
    table = revenue_metrics(df)
    assert_schema(table, "revenue_metrics")
    assert rows(table) == [(day(5), 6.0, 1, 3.0, 1, 1), (day(6), 0.0, 0, 0.0, 0, 0)]


# --- anomalies --------------------------------------------------------------------------


def series(spark, values):
    return spark.createDataFrame([(day(i + 1), float(v)) for i, v in enumerate(values)], "event_date date, v double")


def test_anomaly_scores(spark):
    got = score_metric(series(spark, [10, 10, 10, 10]), "v", "flat").orderBy("event_date").collect()
    assert [(r.expected_value, r.anomaly_score, r.is_anomaly) for r in got] == [
        (None, 0.0, False),
        (10.0, 0.0, False),
        (10.0, 0.0, False),
        (10.0, 0.0, False),
    ]
    got = score_metric(series(spark, [10, 12, 10, 12, 100]), "v", "spike").orderBy("event_date").collect()
    assert [r.is_anomaly for r in got] == [False, False, False, False, True]
    assert got[4].anomaly_score == pytest.approx((100 - 11) / (4 / 3) ** 0.5)
    assert got[1].anomaly_score == 0.0 and got[1].expected_value == 10.0


def test_anomaly_window_and_threshold(spark):
    values = [100, 1, 2, 1, 2, 5]
    wide = score_metric(series(spark, values), "v", "m").orderBy("event_date").collect()[-1]
    narrow = score_metric(series(spark, values), "v", "m", window_size=4).orderBy("event_date").collect()[-1]
    assert not wide.is_anomaly and narrow.is_anomaly
    assert not score_metric(series(spark, values), "v", "m", 4, 10.0).orderBy("event_date").collect()[-1].is_anomaly
    just_at = score_metric(series(spark, [0, 2, 1 + 2 * 2**0.5]), "v", "m", threshold=2.0).orderBy("event_date").collect()[-1]
    assert just_at.anomaly_score == pytest.approx(2.0)


def test_anomaly_report_from_tables_and_from_the_rollup_agree(spark, sf_dir):
    from tidemark.sources.testtables import silver_events

    silver = silver_events(spark, sf_dir)
    report = anomaly_report(daily_user_metrics(silver), revenue_metrics(silver))
    assert_schema(report, "anomaly_detection")
    direct = anomaly_report_from_user_days(user_days(silver))
    for a, b in zip(rows(report), rows(direct), strict=True):
        assert a[:2] == b[:2] and a[5] == b[5]
        assert (a[3] is None) == (b[3] is None)
        assert [v or 0.0 for v in a[2:5]] == pytest.approx([v or 0.0 for v in b[2:5]], rel=1e-9)


# --- churn ------------------------------------------------------------------------------


def test_lapsed_users(spark):
    activity = [("gone", 1), ("gone", 3), ("stays", 2), ("stays", 9), ("later", 9), ("never", 20), (None, 1)]
    df = spark.createDataFrame([(u, day(d)) for u, d in activity], "user_id string, event_date date")
    assert rows(lapsed_users(df, "2024-01-01", "2024-01-07", "2024-01-08", "2024-01-14")) == [("gone",)]
