import json
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from samples import AS_OF, at, event, rows
from tidemark.operators import daily, features, funnel, retention, revenue
from tidemark.operators.clean import clean_events, quality_report
from tidemark.operators.validate import validate_events
from tidemark.plans import jobs
from tidemark.schema import BRONZE_WITH_CORRUPT, EVENT_COLUMNS, GOLD
from tidemark.sources import lake


def write_lines(root, *events, directory="year=2024/month=01/day=05", name="part.json"):
    folder = Path(root) / directory
    folder.mkdir(parents=True, exist_ok=True)
    lines = [e if isinstance(e, str) else json.dumps(e) for e in events]
    (folder / name).write_text("\n".join(lines) + "\n")


def ids(df):
    return [r[0] for r in rows(df, "event_id")]


# --- bronze -----------------------------------------------------------------------------


def test_read_bronze_root_glob_and_bad_lines(spark, tmp_path):
    write_lines(
        tmp_path,
        event(metadata={"experiment_group": "B", "referrer": "x", "extra": [1, 2]}),
        "{not json",
        {"event_id": "sparse"},
        directory="year=2024/month=01/day=05/hour=10",
    )
    for source in (str(tmp_path), f"{tmp_path}/*/*/*", f"{tmp_path}/*/*/*/*/*.json", [str(tmp_path)]):
        df = lake.read_bronze(spark, source)
        assert df.columns == BRONZE_WITH_CORRUPT.fieldNames()
        assert df.count() == 3
        assert [r.event_id for r in df.collect() if r._corrupt_record] == [None]
        clean = clean_events(df, AS_OF).collect()
        assert [(r.event_id, r.metadata.referrer, r.duration_seconds) for r in clean] == [("e1", "x", 10)]


def test_several_bronze_roots(spark, tmp_path):
    for name in ("batch", "stream"):
        write_lines(tmp_path / name, event(event_id=name), event(event_id="both"))
        write_lines(tmp_path / name, event(event_id="old", event_timestamp=at(1)), directory="year=2024/month=01/day=01")
    roots = [str(tmp_path / "batch"), str(tmp_path / "stream")]
    assert lake.read_bronze(spark, roots).count() == 6
    assert ids(lake.read_bronze(spark, roots, start_date="2024-01-05", prune_directories=True)) == ["batch", "both", "both", "stream"]
    assert ids(clean_events(lake.read_bronze(spark, roots), AS_OF)) == ["batch", "both", "old", "stream"]


def test_range_prunes_directories_with_a_day_of_margin_if_asked_to(spark, tmp_path):
    for d in range(1, 9):
        write_lines(tmp_path, event(event_id=f"d{d}", event_timestamp=at(d)), directory=f"year=2024/month=01/day={d:02d}")
    assert ids(lake.read_bronze(spark, str(tmp_path), "2024-01-04", "2024-01-05", prune_directories=True)) == ["d3", "d4", "d5", "d6"]
    assert ids(lake.read_bronze(spark, str(tmp_path), start_date="2024-01-08", prune_directories=True)) == ["d7", "d8"]
    assert lake.read_bronze(spark, str(tmp_path), "2024-01-04", "2024-01-05").count() == 8
    plan = lake.read_bronze(spark, str(tmp_path), "2024-01-04", "2024-01-05", prune_directories=True)._jdf.queryExecution().executedPlan()
    assert "make_date" in plan.toString().split("PartitionFilters")[1]


def test_bronze_round_trip_keeps_extra_metadata_and_layout(spark, tmp_path):
    source, target = tmp_path / "in", tmp_path / "out"
    write_lines(
        source,
        event(metadata={"experiment_group": "A", "ad": {"id": 7}}),
        event(event_id="junk", event_timestamp="?"),
        event(event_id="offset", event_timestamp="2024-01-05T23:30:00-02:00"),
    )
    lake.write_bronze(lake.read_bronze(spark, str(source)), str(target), as_of=AS_OF)
    folders = sorted(str(p.parent.relative_to(target)) for p in target.rglob("*.json"))
    assert folders == [
        "year=2024/month=01/day=05/hour=10",
        "year=2024/month=01/day=06/hour=01",
        "year=2024/month=02/day=01/hour=00",
    ]
    first = json.loads(next((target / folders[0]).glob("*.json")).read_text())
    assert first["metadata"] == {"experiment_group": "A", "ad": {"id": 7}} and "year" not in first
    lake.write_bronze(lake.read_bronze(spark, str(source)), str(target), as_of=AS_OF)
    assert lake.read_bronze(spark, str(target)).count() == 6


def test_rows_per_file(spark, tmp_path):
    source = tmp_path / "in"
    write_lines(source, *[event(event_id=str(i)) for i in range(10)])
    lake.write_bronze(lake.read_bronze(spark, str(source)).coalesce(1), str(tmp_path / "out"), AS_OF, events_per_file=4)
    sizes = [len(p.read_text().splitlines()) for p in (tmp_path / "out").rglob("*.json")]
    assert sum(sizes) == 10 and max(sizes) <= 4


# --- silver -----------------------------------------------------------------------------


def make_bronze(root, days=range(1, 6)):
    for d in days:
        write_lines(
            root,
            *[event(event_id=f"{d}-{u}", user_id=f"u{u}", event_timestamp=at(d), feature="like") for u in range(d)],
            directory=f"year=2024/month=01/day={d:02d}",
        )


def test_clean_writes_partitions_and_reports(spark, tmp_path):
    make_bronze(tmp_path / "bronze")
    report = jobs.clean_bronze(spark, str(tmp_path / "bronze"), str(tmp_path / "silver"), AS_OF)
    assert report["raw_count"] == report["clean_count"] == 15
    assert sorted(p.name for p in (tmp_path / "silver").glob("event_date=*"))[0] == "event_date=2024-01-01"
    pruned = lake.read_silver(spark, str(tmp_path / "silver"), "2024-01-04", "2024-01-05")
    assert pruned.count() == 9
    assert "PartitionFilters: [isnotnull(event_date" in pruned._jdf.queryExecution().executedPlan().toString()
    again = jobs.clean_bronze(spark, str(tmp_path / "bronze"), str(tmp_path / "silver"), AS_OF)
    assert again == report and lake.read_silver(spark, str(tmp_path / "silver")).count() == 15


def test_partitioned_write_splits_a_hot_date_and_keeps_others_whole(spark, tmp_path):
    df = spark.range(0, 60_000, 1, 4).selectExpr(
        "concat('u', id % 7) AS user_id",
        "uuid() AS event_id",
        "IF(id % 3 = 0, DATE '2024-01-01', date_add(DATE '2024-01-02', int(id % 9))) AS event_date",
    )
    key, before = "spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set(key, "12")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        lake.write_by_date(df, str(tmp_path / "t"), ("user_id", "event_id"))
    finally:
        spark.conf.set(key, before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = {p.name: len(list(p.glob("*.parquet"))) for p in (tmp_path / "t").glob("event_date=*")}
    assert files["event_date=2024-01-01"] >= 4
    assert len(files) == 7 and sum(files.values()) <= 12 + len(files)
    assert lake.read_silver(spark, str(tmp_path / "t")).count() == 60_000


def full_rebuild(spark, bronze):
    return clean_events(lake.read_bronze(spark, bronze), AS_OF)


def same_rows(left, right):
    columns = [*EVENT_COLUMNS, "event_date"]
    assert rows(left.select(*columns)) == rows(right.select(*columns))


def test_backfill_equals_a_full_rebuild(spark, tmp_path):
    bronze, silver = str(tmp_path / "bronze"), str(tmp_path / "silver")
    make_bronze(bronze)
    jobs.clean_bronze(spark, bronze, silver, AS_OF)
    # Corrections: day 2 empties, day 3 changes, day 4 gains copies of ids from days 1 and 5.
    write_lines(bronze, event(event_id="junk", event_timestamp="?"), directory="year=2024/month=01/day=02")
    write_lines(bronze, event(event_id="3-new", event_timestamp=at(3)), directory="year=2024/month=01/day=03")
    write_lines(
        bronze,
        event(event_id="1-0", event_timestamp=at(4)),
        event(event_id="5-0", event_timestamp=at(4), city="early copy"),
        event(event_id="4-0", event_timestamp=at(4)),
        directory="year=2024/month=01/day=04",
    )
    done = jobs.backfill_silver(spark, bronze, silver, "2024-01-02", "2024-01-04", AS_OF)
    table = lake.read_silver(spark, silver)
    same_rows(table, full_rebuild(spark, bronze))
    assert not (tmp_path / "silver" / "event_date=2024-01-02").exists()
    assert done.other_dates == {date(2024, 1, 5)}
    assert done.report["dropped_bad_timestamp"] == 1
    assert table.count() == table.select("event_id").distinct().count()
    assert jobs.backfill_silver(spark, bronze, silver, "2024-01-02", "2024-01-04", AS_OF).other_dates == set()
    same_rows(lake.read_silver(spark, silver), full_rebuild(spark, bronze))


def test_backfill_brings_back_copies_of_removed_ids(spark, tmp_path):
    bronze, silver = str(tmp_path / "bronze"), str(tmp_path / "silver")
    make_bronze(bronze)
    write_lines(
        bronze,
        event(event_id="twice", event_timestamp=at(3)),
        event(event_id="twice", event_timestamp=at(5), city="later copy"),
        event(event_id="twice", event_timestamp=at(6), city="last copy"),
        event(event_id="gone", event_timestamp=at(3)),
        name="copies.json",
    )
    jobs.clean_bronze(spark, bronze, silver, AS_OF)
    write_lines(
        bronze,
        event(event_id="twice", event_timestamp=at(5), city="later copy"),
        event(event_id="twice", event_timestamp=at(6), city="last copy"),
        name="copies.json",
    )
    done = jobs.backfill_silver(spark, bronze, silver, "2024-01-03", "2024-01-03", AS_OF)
    assert done.other_dates == {date(2024, 1, 5)}
    same_rows(lake.read_silver(spark, silver), full_rebuild(spark, bronze))


def test_backfill_cleans_up_its_staging(spark, tmp_path):
    make_bronze(tmp_path / "bronze")
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(shared.glob("tidemark-*")) if shared.exists() else set()
    jobs.backfill_silver(spark, str(tmp_path / "bronze"), str(tmp_path / "silver"), "2024-01-02", None, AS_OF)
    assert lake.read_silver(spark, str(tmp_path / "silver")).count() == 14
    assert (set(shared.glob("tidemark-*")) if shared.exists() else set()) == before


@pytest.mark.parametrize("start, end", [(None, None), ("2024-01-05", "2024-01-04"), ("yesterday", "2024-01-04")])
def test_bad_ranges(spark, tmp_path, start, end):
    with pytest.raises(ValueError):
        jobs.backfill_silver(spark, str(tmp_path), str(tmp_path / "s"), start, end)


def test_full_backfill_needs_both_dates(spark, tmp_path):
    with pytest.raises(ValueError, match="both"):
        jobs.run_backfill(spark, "b", "s", "g", "2024-01-01", None)


# --- gold -------------------------------------------------------------------------------

BUILDERS = {
    "daily_user_metrics": daily.daily_user_metrics,
    "retention_cohorts": retention.retention_cohorts,
    "funnel_metrics": funnel.funnel_metrics,
    "feature_usage": features.feature_usage,
    "revenue_metrics": revenue.revenue_metrics,
}


def assert_gold_matches_silver(spark, silver, gold):
    for name, build in BUILDERS.items():
        assert rows(lake.load_gold(spark, gold, name)) == rows(build(lake.read_silver(spark, silver))), name


def test_run_and_backfill_end_to_end(spark, tmp_path):
    bronze, silver, gold = (str(tmp_path / n) for n in ("bronze", "silver", "gold"))
    make_bronze(bronze)
    write_lines(
        bronze,
        event(event_id="s", event_type="user_signup", event_timestamp=at(5, "08:00:00")),
        event(event_id="v", event_type="profile_view", event_timestamp=at(5, "09:00:00")),
        event(event_id="p", event_type="subscription_started", event_timestamp=at(5), revenue=9.5),
        name="funnel.json",
    )
    report, checks = jobs.run_daily(spark, bronze, silver, gold, AS_OF)
    assert report["clean_count"] == 18 and checks.summary == "7/7 checks passed"
    assert_gold_matches_silver(spark, silver, gold)
    assert lake.load_gold(spark, gold, "anomaly_detection").count() == 15

    write_lines(bronze, event(event_id="junk", event_timestamp="?"), directory="year=2024/month=01/day=02")
    write_lines(bronze, event(event_id="5-1", event_timestamp=at(3)), directory="year=2024/month=01/day=03")
    jobs.run_backfill(spark, bronze, silver, gold, "2024-01-02", "2024-01-03", AS_OF)
    same_rows(lake.read_silver(spark, silver), full_rebuild(spark, bronze))
    assert_gold_matches_silver(spark, silver, gold)


def test_run_stops_at_a_failed_check(spark, tmp_path):
    bronze, silver, gold = (str(tmp_path / n) for n in ("bronze", "silver", "gold"))
    make_bronze(bronze, [3])
    write_lines(bronze, event(event_id="x", event_timestamp=at(4)), directory="year=2024/month=01/day=04")
    with pytest.raises(jobs.QualityCheckFailed, match="event_volume_not_unusually_low"):
        jobs.run_daily(spark, bronze, silver, gold, AS_OF)
    assert not (tmp_path / "gold").exists()


def test_gold_by_name_views_and_external_tables(spark, tmp_path):
    gold = str(tmp_path / "gold")
    for name, schema in GOLD.items():
        empty = lake.load_gold(spark, gold, name)
        assert empty.schema == schema and empty.count() == 0
    row = [(date(2024, 1, 5), 2, 1, 1, 2, 5.0, 9, 2, 2, 1.0), (date(2024, 1, 6), 3, 1, 2, 2, 5.0, 9, 3, 3, 1.0)]
    for _ in range(2):
        lake.write_gold(spark.createDataFrame(row, GOLD["daily_user_metrics"]), f"{gold}/daily_user_metrics")
    assert lake.load_gold(spark, gold, "daily_user_metrics").count() == 2
    assert len(list(Path(gold, "daily_user_metrics").glob("*.parquet"))) == 1
    lake.register_gold_views(spark, gold)
    newest = "SELECT event_date, daily_active_users FROM daily_user_metrics ORDER BY event_date DESC LIMIT 1"
    assert spark.sql(newest).collect()[0] == (date(2024, 1, 6), 3)
    assert spark.sql("SELECT count(*) FROM funnel_metrics").collect()[0][0] == 0
    lake.create_gold_tables(spark, gold, "metrics_test")
    try:
        assert spark.table("metrics_test.daily_user_metrics").count() == 2
        assert [f.dataType for f in spark.table("metrics_test.revenue_metrics").schema] == [
            f.dataType for f in GOLD["revenue_metrics"]
        ]
    finally:
        for name in GOLD:
            spark.sql(f"DROP TABLE metrics_test.{name}")
            spark.catalog.dropTempView(name)
        spark.sql("DROP DATABASE metrics_test")


def test_plain_sql_over_the_gold_views(spark, tmp_path):
    bronze, silver, gold = (str(tmp_path / n) for n in ("bronze", "silver", "gold"))
    make_bronze(bronze)
    for step in ("user_signup", "profile_view"):
        write_lines(bronze, event(event_id=step, event_type=step, event_timestamp=at(5), revenue=2.5), name=f"{step}.json")
    jobs.clean_bronze(spark, bronze, silver, AS_OF)
    jobs.refresh_rollups(spark, silver, gold)
    jobs.build_gold(spark, gold)
    lake.register_gold_views(spark, gold)

    def answer(statement):
        return [tuple(r) for r in spark.sql(statement).collect()]

    try:
        # day d has users u0 .. u(d-1), day 5 user u1's signup and first view as well
        assert answer("SELECT dayofmonth(event_date) AS d, daily_active_users, new_users FROM daily_user_metrics ORDER BY d") == [(d, d, 1) for d in range(1, 6)]
        steps = answer("SELECT funnel_step, users_reached FROM funnel_metrics WHERE users_reached > 0 ORDER BY step_order")
        assert steps == [("user_signup", 1), ("profile_view", 1)]
        assert answer("SELECT max(paying_users), sum(total_revenue) FROM revenue_metrics") == [(1, 5.0)]
        assert answer("SELECT sum(cohort_size) FROM retention_cohorts WHERE retention_day = 0") == [(5,)]
        assert answer("SELECT feature, sum(event_count), max(unique_users) FROM feature_usage GROUP BY feature") == [("like", 15, 5)]
        metrics = "SELECT count(DISTINCT metric_name), count(*), count_if(is_anomaly) FROM anomaly_detection"
        assert answer(metrics) == [(3, 15, len(answer("SELECT 1 FROM anomaly_detection WHERE abs(anomaly_score) > 2")))]
    finally:
        for name in GOLD:
            spark.catalog.dropTempView(name)


def test_report_of_a_path_matches_report_of_a_frame(spark, tmp_path):
    make_bronze(tmp_path / "bronze")
    frame = lake.read_bronze(spark, str(tmp_path / "bronze"))
    report = {r.line: r.row_count for r in quality_report(frame, AS_OF).collect()}
    assert report == jobs.clean_bronze(spark, str(tmp_path / "bronze"), str(tmp_path / "silver"), AS_OF)


def test_command_line_jobs(spark, tmp_path, capsys):
    from tidemark.__main__ import _parser, run

    bronze, silver, gold = (str(tmp_path / n) for n in ("bronze", "silver", "gold"))
    make_bronze(bronze)
    call = lambda *args: run(spark, _parser().parse_args(args))
    call("clean", "--input", f"{bronze}/*/*/*", "--output", silver)
    assert json.loads(capsys.readouterr().out)["clean_count"] == 15
    for job, name in zip(("daily", "retention", "funnel", "features", "revenue"), BUILDERS):
        call(job, "--input", silver, "--output", f"{gold}/{name}")
    assert_gold_matches_silver(spark, silver, gold)
    call(
        *("anomaly", "--daily-metrics", f"{gold}/daily_user_metrics", "--revenue-metrics", f"{gold}/revenue_metrics"),
        *("--output", f"{gold}/anomaly_detection", "--window", "3", "--threshold", "1.5"),
    )
    assert "/ 15 rows" in capsys.readouterr().out
    call("check", "--silver-path", silver, "--subset", "schema", "--block")
    assert json.loads(capsys.readouterr().out)["summary"] == "4/4 schema checks passed"
    call("clean", "--input", bronze, "--output", silver, "--start-date", "2024-01-02", "--end-date", "2024-01-03")
    assert json.loads(capsys.readouterr().out)["clean_count"] == 5
    assert lake.read_silver(spark, silver).count() == 15
    paths = ("--input", bronze, "--silver-path", silver, "--gold-root", f"{gold}2")
    call("backfill", *paths, "--start-date", "2024-01-02", "--end-date", "2024-01-03")
    assert_gold_matches_silver(spark, silver, f"{gold}2")  # no rollups before: all dates are built
    write_lines(bronze, event(event_id="more", event_timestamp=at(1)), directory="year=2024/month=01/day=01")
    call("clean", "--input", bronze, "--output", silver, "--start-date", "2024-01-01", "--end-date", "2024-01-01")
    call("gold", "--silver-path", silver, "--gold-root", f"{gold}2")
    assert_gold_matches_silver(spark, silver, f"{gold}2")


def test_numbers_of_other_json_types(spark, tmp_path):
    base = dict(user_id="u", session_id="s", event_type="post_liked", event_timestamp="2024-01-05T10:00:00Z")
    given = [dict(revenue="9.99", duration_seconds=18.0), dict(revenue="-4"), dict(duration_seconds="18"), dict(revenue="much"), dict(revenue=2), dict(duration_seconds="x")]
    lines = [json.dumps({"event_id": f"e{i}", **base, **g}) for i, g in enumerate(given)]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text("\n".join([*lines, "{broken"]))
    report = jobs.clean_bronze(spark, str(tmp_path / "in"), str(tmp_path / "out"), AS_OF)
    assert (report["raw_count"], report["dropped_negative_revenue"], report["dropped_mistyped_field"]) == (7, 1, 2)
    assert (report["dropped_bad_timestamp"], report["clean_count"]) == (1, 3)
    got = spark.read.parquet(str(tmp_path / "out")).orderBy("event_id").collect()
    assert [(r.event_id, r.revenue, r.duration_seconds) for r in got] == [("e0", 9.99, 18), ("e2", 0.0, 18), ("e4", 2.0, None)]


@pytest.mark.parametrize("text", ["NaN", "Infinity", "-Infinity", "9.99d", "1e400", "0x1p3", " 1"])
def test_texts_that_are_no_finite_numbers_never_become_revenue(spark, tmp_path, text):
    write_lines(tmp_path, event(revenue=text), event(event_id="good", revenue="2.5e0"))
    bronze = lake.read_bronze(spark, str(tmp_path))
    assert [(r.event_id, r.revenue) for r in clean_events(bronze, AS_OF).collect()] == [("good", 2.5)]
    report = {r.line: r.row_count for r in quality_report(bronze, AS_OF).collect()}
    assert (report["dropped_mistyped_field"], report["dropped_negative_revenue"]) == (1, 0)
    assert [r.reject_reasons for r in validate_events(bronze, AS_OF).where("event_id = 'e1'").collect()] == [["malformed_record"]]
