from datetime import date

import pytest

from samples import AS_OF, at
from tidemark.operators import quality
from tidemark.plans.jobs import QualityCheckFailed, check_silver, run_checks


def checks_of(df, **options):
    return {r.name: r for r in quality.all_checks(df, as_of=AS_OF, **options).collect()}


def volume(silver, *per_day):
    return silver(*[{"event_id": f"{d}-{i}", "event_timestamp": at(d)} for d, n in per_day for i in range(n)])


def test_clean_table_passes_everything(silver):
    run = run_checks(silver({}), as_of=AS_OF)
    assert run.summary == "7/7 checks passed" and run.failed == []
    assert [c["name"] for c in run.checks] == list(quality.CHECKS)


def test_each_problem_fails_its_check(silver):
    df = silver(
        {"event_id": "a"},
        {"event_id": "a"},
        {"event_id": None},
        {"event_id": None},
        {"event_id": ""},
        {"event_id": "t", "event_type": "dance"},
        {"event_id": "n", "event_type": None},
        {"event_id": "f", "event_timestamp": "2024-02-01T00:00:01Z"},
        {"event_id": "r", "revenue": -1.0},
    )
    got = checks_of(df)
    details = {name: row.detail for name, row in got.items()}
    assert details["no_null_event_ids"] == "3 rows with null/empty event_id"
    assert details["no_duplicate_event_ids"] == "2 duplicate event_id rows"
    assert details["valid_event_types_only"] == "1 rows with unrecognized event_type"
    assert details["timestamps_not_in_future"] == "1 rows with future event_timestamp"
    assert details["revenue_not_negative"] == "1 rows with negative revenue"
    assert details["required_partitions_exist"] == "2 distinct event_date partitions found"
    assert [got[n].passed for n in quality.CHECKS[:5]] == [False] * 5


def test_skew_can_be_allowed(silver):
    df = silver({"event_timestamp": "2024-02-01T00:00:30Z"})
    assert not checks_of(df)["timestamps_not_in_future"].passed
    assert checks_of(df, skew_seconds=60)["timestamps_not_in_future"].passed


@pytest.mark.parametrize(
    "per_day, passed, detail",
    [
        ([(1, 4)], True, quality.TOO_FEW_DAYS),
        ([(1, 4), (2, 2)], False, "latest=2, trailing_avg=4.0, drop_pct=50.0%"),
        ([(1, 4), (2, 3)], True, "latest=3, trailing_avg=4.0, drop_pct=25.0%"),
        ([(1, 40), *[(d, 2) for d in range(2, 10)]], True, "latest=2, trailing_avg=2.0, drop_pct=0.0%"),
        ([(1, 2), (9, 5)], True, "latest=5, trailing_avg=2.0, drop_pct=-150.0%"),
    ],
)
def test_volume(silver, per_day, passed, detail):
    row = checks_of(volume(silver, *per_day))["event_volume_not_unusually_low"]
    assert (row.passed, row.detail) == (passed, detail)


def test_expected_date_and_empty_table(silver):
    assert checks_of(silver({}), expected_date="2024-01-05")["required_partitions_exist"].passed
    assert not checks_of(silver({}), expected_date=date(2024, 1, 6))["required_partitions_exist"].passed
    empty = checks_of(silver())
    assert not empty["required_partitions_exist"].passed
    assert all(row.passed for name, row in empty.items() if name != "required_partitions_exist")


def test_subsets(silver):
    schema = run_checks(silver({}), "schema", as_of=AS_OF)
    fresh = run_checks(silver({}), "freshness", as_of=AS_OF)
    assert [c["name"] for c in schema.checks] == list(quality.SCHEMA_CHECKS)
    assert [c["name"] for c in fresh.checks] == list(quality.FRESHNESS_CHECKS)
    assert schema.summary == "4/4 schema checks passed" and fresh.summary == "3/3 freshness checks passed"


def test_gate_blocks_and_monitor_reports(silver):
    bad = silver({"revenue": -1.0})
    run = run_checks(bad, mode="warn", as_of=AS_OF)
    assert [c["name"] for c in run.failed] == ["revenue_not_negative"] and run.summary == "6/7 checks passed"
    with pytest.raises(QualityCheckFailed, match="revenue_not_negative"):
        run_checks(bad, mode="raise", as_of=AS_OF)
    with pytest.raises(ValueError):
        run_checks(bad, mode="maybe")


def test_missing_table_fails_its_partition_check(spark, tmp_path):
    run = check_silver(spark, str(tmp_path / "nowhere"))
    assert run.failed[0]["name"] == "required_partitions_exist"
    with pytest.raises(QualityCheckFailed):
        check_silver(spark, str(tmp_path / "nowhere"), mode="raise")


def test_one_scan_per_column(silver):
    plan = quality.freshness_checks(silver({}), as_of=AS_OF)._jdf.queryExecution().optimizedPlan().toString()
    assert "event_id" not in plan.split("LogicalRDD")[0]
