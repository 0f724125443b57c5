from datetime import date, datetime

from pyspark.sql import functions as F

from samples import AS_OF, at, rows
from tidemark.operators.clean import clean_events, quality_report, rejected_events, tag_events
from tidemark.schema import SILVER


def report_of(df, **options):
    return {r.line: r.row_count for r in quality_report(df, AS_OF, **options).collect()}


def dirty(bronze):
    return bronze(
        {"event_id": "ok"},
        {"event_id": "bad_time", "event_timestamp": "not-a-timestamp"},
        {"event_id": "null_time", "event_timestamp": None},
        {"event_id": "future", "event_timestamp": "2024-02-02T00:00:00Z"},
        {"event_id": "no_user", "user_id": None},
        {"event_id": "empty_user", "user_id": ""},
        {"event_id": None},
        {"event_id": "bad_type", "event_type": "unknown_event_xyz"},
        {"event_id": "null_type", "event_type": None},
        {"event_id": "negative", "revenue": -5.0},
        {"event_id": "two_rules", "event_timestamp": "nope", "revenue": -1.0, "user_id": None},
        {"event_id": "ok", "event_timestamp": at(5, "10:00:05")},
        {"event_id": "free", "revenue": None},
    )


def test_first_failing_rule_wins_and_drops_add_up(bronze):
    report = report_of(dirty(bronze))
    assert report == {
        "raw_count": 13,
        "dropped_bad_timestamp": 3,
        "dropped_future_timestamp": 1,
        "dropped_missing_ids": 3,
        "dropped_bad_event_type": 2,
        "dropped_negative_revenue": 1,
        "dropped_duplicates": 1,
        "clean_count": 2,
    }
    drops = sum(n for line, n in report.items() if line.startswith("dropped"))
    assert report["raw_count"] == report["clean_count"] + drops
    assert clean_events(dirty(bronze), AS_OF).count() == report["clean_count"]
    assert rejected_events(dirty(bronze), AS_OF).count() == drops - report["dropped_duplicates"]


def test_report_matches_filtering_rule_after_rule(spark, sf_dir):
    from tidemark.schema import EVENT_TYPES
    from tidemark.sources.testtables import bronze_events

    raw = bronze_events(spark, sf_dir, with_country=False)
    stages = [raw.withColumn("t", F.try_to_timestamp(F.col("event_timestamp")))]
    for condition in (
        F.col("t").isNotNull(),
        F.col("t") <= F.expr(f"timestamp '{AS_OF}' + interval 60 seconds"),
        F.expr("event_id is not null and event_id <> '' and user_id is not null and user_id <> ''"),
        F.col("event_type").isin(*EVENT_TYPES),
        F.expr("revenue is null or revenue >= 0"),
    ):
        stages.append(stages[-1].filter(condition))
    counts = [s.count() for s in stages]
    distinct = stages[-1].select("event_id").distinct().count()
    staged = [counts[0], *[a - b for a, b in zip(counts, counts[1:])], counts[-1] - distinct, distinct]
    assert list(report_of(raw).values()) == staged


def test_clock_skew_is_sixty_seconds_inclusive(bronze):
    df = bronze(
        {"event_id": "edge", "event_timestamp": "2024-02-01T00:01:00Z"},
        {"event_id": "over", "event_timestamp": "2024-02-01T00:01:00.000001Z"},
    )
    assert rows(clean_events(df, AS_OF), "event_id") == [("edge",)]
    assert clean_events(df, AS_OF, skew_seconds=61).count() == 2


def test_as_of_defaults_to_now_and_accepts_datetimes(bronze):
    df = bronze({"event_timestamp": "2024-02-02T00:00:00Z"}, {"event_id": "x", "event_timestamp": "2999-01-01T00:00:00Z"})
    assert rows(clean_events(df), "event_id") == [("e1",)]
    assert clean_events(df, datetime(2024, 2, 1)).count() == 0


def test_earliest_copy_wins(bronze):
    df = bronze(
        {"event_timestamp": at(5, "10:00:05"), "city": "late"},
        {"event_timestamp": at(5, "10:00:00"), "city": "early"},
    )
    assert rows(clean_events(df, AS_OF), "city") == [("early",)]


def test_equal_times_resolve_the_same_way_in_any_order(bronze):
    copies = [{"city": c, "page": p} for c in ("a", "b", "c") for p in (None, "x")]
    results = {tuple(rows(clean_events(bronze(*order).repartition(n), AS_OF))) for n, order in ((1, copies), (3, copies[::-1]))}
    assert len(results) == 1


def test_a_corrupt_copy_does_not_win_the_dedup(bronze):
    df = bronze({"event_timestamp": at(1), "revenue": -1.0}, {"event_timestamp": at(2)})
    assert rows(clean_events(df, AS_OF), "event_date") == [(date(2024, 1, 2),)]


def test_standardised_columns_and_schema(bronze):
    clean = clean_events(bronze({"revenue": None, "event_timestamp": "2024-01-05T23:30:00-05:00"}), AS_OF)
    assert [(f.name, f.dataType) for f in clean.schema] == [(f.name, f.dataType) for f in SILVER]
    row = clean.collect()[0]
    assert (row.platform, row.device_type, row.country, row.revenue) == ("ios", "mobile", "US", 0.0)
    assert row.event_date == date(2024, 1, 6)
    assert row.metadata.experiment_group == "B"


def test_range_keeps_unparsable_rows_in_the_report_and_the_last_microsecond(bronze):
    df = bronze(
        {"event_id": "before", "event_timestamp": "2024-01-04T23:59:59.999999Z"},
        {"event_id": "first", "event_timestamp": "2024-01-05T00:00:00Z"},
        {"event_id": "last", "event_timestamp": "2024-01-06T23:59:59.999999Z"},
        {"event_id": "after", "event_timestamp": "2024-01-07T00:00:00Z"},
        {"event_id": "junk", "event_timestamp": "?"},
    )
    chosen = dict(start_date="2024-01-05", end_date=date(2024, 1, 6))
    assert rows(clean_events(df, AS_OF, **chosen), "event_id") == [("first",), ("last",)]
    report = report_of(df, **chosen)
    assert (report["raw_count"], report["dropped_bad_timestamp"], report["clean_count"]) == (3, 1, 2)
    assert rows(clean_events(df, AS_OF, start_date="2024-01-07"), "event_id") == [("after",)]


def test_empty_input(bronze):
    assert set(report_of(bronze()).values()) == {0}
    assert clean_events(bronze(), AS_OF).count() == 0


def test_tagging_keeps_every_row(bronze):
    assert tag_events(dirty(bronze), AS_OF).count() == 13


def test_dedup_limits_copies_before_the_shuffle(bronze):
    plan = clean_events(bronze({}), AS_OF)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("row_number(), 1, Final") < plan.index("Exchange hashpartitioning") < plan.index("row_number(), 1, Partial")
