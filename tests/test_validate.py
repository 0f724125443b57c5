import pytest

from samples import AS_OF, rows
from tidemark.operators.validate import accepted, ingest_counts, rejected, validate_events


@pytest.mark.parametrize(
    "change, reasons",
    [
        ({}, []),
        ({"event_id": ""}, ["missing_event_id"]),
        ({"user_id": None}, ["missing_user_id"]),
        ({"session_id": ""}, ["missing_session_id"]),
        ({"event_type": "dance"}, ["bad_event_type"]),
        ({"event_type": None}, ["bad_event_type"]),
        ({"event_timestamp": "later"}, ["bad_timestamp"]),
        ({"event_timestamp": None}, ["bad_timestamp"]),
        ({"event_timestamp": "2024-02-01T00:01:01Z"}, ["future_timestamp"]),
        ({"event_timestamp": "2024-02-01T00:01:00Z"}, []),
        ({"platform": None}, ["missing_platform"]),
        ({"device_type": None, "country": None}, ["missing_device_type", "missing_country"]),
        ({"city": None, "app_version": None}, ["missing_city", "missing_app_version"]),
        ({"city": ""}, []),
        ({"duration_seconds": -1}, ["negative_duration"]),
        ({"duration_seconds": 0}, []),
        ({"duration_seconds": None}, []),
        ({"revenue": -0.01}, ["negative_revenue"]),
        ({"revenue": float("nan")}, ["negative_revenue"]),
        ({"revenue": None}, []),
        ({"metadata": None, "page": None}, []),
        ({"event_id": None, "revenue": -1.0}, ["missing_event_id", "negative_revenue"]),
    ],
)
def test_rules(bronze, change, reasons):
    assert validate_events(bronze(change), AS_OF).collect()[0].reject_reasons == reasons


def test_split_and_counts(bronze):
    checked = validate_events(bronze({}, {"event_id": "b", "revenue": None}, {"event_id": "", "user_id": ""}), AS_OF)
    assert accepted(checked).count() == 2 and rejected(checked).count() == 1
    assert rows(accepted(checked), "revenue") == [(0.0,), (0.0,)]
    assert rows(ingest_counts(checked)) == [
        ("accepted", 2),
        ("missing_event_id", 1),
        ("missing_user_id", 1),
        ("rejected", 1),
    ]
