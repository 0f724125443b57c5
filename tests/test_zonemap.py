"""The zone map of bronze: which directories a date range reads, and that nothing is missed."""

import pytest

from samples import AS_OF, at, event, rows
from test_jobs import write_lines
from tidemark.operators.clean import clean_events, quality_report
from tidemark.plans import jobs
from tidemark.sources.lake import read_bronze, read_silver
from tidemark.sources.zonemap import ZoneMap


def day(d):
    return f"year=2024/month=01/day={d:02d}"


@pytest.fixture
def bronze(tmp_path):
    root = str(tmp_path / "bronze")
    for d in range(1, 9):
        write_lines(root, *(event(event_id=f"{d}-{u}", user_id=f"u{u}", event_timestamp=at(d)) for u in range(3)), directory=day(d))
    write_lines(root, event(event_id="misplaced", event_timestamp=at(3)), directory=day(8), name="late.json")
    return root


def directories(files):
    return sorted({f.split("day=")[1].split("/")[0] for f in files})


def test_only_directories_with_events_of_the_range_are_read(spark, bronze):
    zones = ZoneMap(spark, bronze)
    assert directories(zones.files("2024-01-03", "2024-01-03")) == [f"{d:02d}" for d in range(1, 9)]  # nothing is known yet
    assert zones.refresh() == 8 and zones.refresh() == 0
    assert directories(zones.files("2024-01-03", "2024-01-04")) == ["03", "04", "08"]
    assert directories(zones.files(None, "2024-01-02")) == ["01", "02"] and directories(zones.files("2024-01-07", None)) == ["07", "08"]
    assert len(zones.files(None, None)) == 9
    assert zones.files("2023-01-01", "2023-01-02") == [] and zones.read("2023-01-01", "2023-01-02").count() == 0
    got = zones.read("2024-01-03", "2024-01-03")
    assert directories(got.inputFiles()) == ["03", "08"]
    want = clean_events(read_bronze(spark, bronze), AS_OF).where("event_date = DATE'2024-01-03'")
    assert rows(clean_events(got, AS_OF, start_date="2024-01-03", end_date="2024-01-03")) == rows(want)


def test_changed_directories_and_lines_without_a_time_are_read(spark, bronze):
    zones = ZoneMap(spark, bronze)
    zones.refresh()
    write_lines(bronze, event(event_id="new", event_timestamp=at(3)), directory=day(6), name="more.json")
    write_lines(bronze, "{ no json", event(event_id="when", event_timestamp="not-a-timestamp"), directory=day(7), name="bad.json")
    assert directories(zones.files("2024-01-03", "2024-01-03")) == ["03", "06", "07", "08"]
    assert zones.refresh() == 2 and zones.refresh() == 0
    assert directories(zones.files("2024-01-03", "2024-01-03")) == ["03", "06", "07", "08"]
    assert directories(zones.files("2024-01-03", "2024-01-03", without_time=False)) == ["03", "06", "08"]
    around = ("2024-01-02", "2024-01-04")
    assert quality_report(zones.read(*around), AS_OF, start_date=around[0], end_date=around[1]).collect() == quality_report(read_bronze(spark, bronze), AS_OF, start_date=around[0], end_date=around[1]).collect()
    spark.read.parquet(zones.path).coalesce(1).write.mode("append").parquet(zones.path)  # as a run done again would
    assert len(zones.read("2024-01-03", "2024-01-03").inputFiles()) == 7  # one of the 3rd, two each of the 6th to 8th


def test_rejected_events_and_several_roots(spark, tmp_path):
    root = str(tmp_path / "both")
    write_lines(root, event(event_id="good", event_timestamp=at(2)), directory=f"outcome=accepted/{day(2)}")
    write_lines(root, event(event_id="bad", event_timestamp=at(2)), directory=f"outcome=rejected/{day(2)}")
    zones = ZoneMap(spark, root)
    assert zones.refresh() == 1 and zones.refresh() == 0
    assert rows(zones.read("2024-01-02", "2024-01-02"), "event_id") == [("good",)]


def test_backfill_by_zones_equals_one_that_reads_everything(spark, bronze, tmp_path):
    results = []
    for zones in (False, True):
        silver, gold = str(tmp_path / f"silver{zones}"), str(tmp_path / f"gold{zones}")
        jobs.run_daily(spark, bronze, silver, gold, AS_OF)
        if not results:
            late = str(tmp_path / "bronze")
            write_lines(late, event(event_id="4-1", event_timestamp=at(4)), event(event_id="fresh", event_timestamp=at(4)), directory=day(7), name="fresh.json")
        report = jobs.run_backfill(spark, bronze, silver, gold, "2024-01-04", "2024-01-05", AS_OF, zones=zones)
        results.append((report, rows(read_silver(spark, silver)), rows(spark.read.parquet(f"{gold}/daily_user_metrics"))))
    assert results[0] == results[1]
    assert ("fresh",) in rows(read_silver(spark, silver, "2024-01-04", "2024-01-04"), "event_id")
