import json

import pytest

from samples import AS_OF, at, event, rows
from test_jobs import write_lines
from tidemark.operators.clean import clean_events
from tidemark.sources.lake import read_bronze, read_silver
from tidemark.streaming import landing

ONCE = landing.UNTIL_CAUGHT_UP


def finish(query):
    query.awaitTermination()
    return query


def test_landing_splits_lays_out_and_counts(spark, tmp_path):
    source, bronze, bad = (str(tmp_path / n) for n in ("in", "bronze", "bad"))
    write_lines(
        source,
        event(metadata={"experiment_group": "A", "ad": 7}),
        event(event_id="late", event_timestamp=at(6, "23:00:00"), revenue=None),
        event(event_id="x", event_type="dance"),
        event(event_id="y", duration_seconds="soon"),
        "{broken",
        directory=".",
    )
    arriving = landing.read_event_stream(spark, source)
    query = finish(landing.land_events(arriving, bronze, str(tmp_path / "c1"), AS_OF, ONCE))
    finish(landing.quarantine_events(arriving, bad, str(tmp_path / "c2"), AS_OF, ONCE))
    landed = [json.loads(line) for p in (tmp_path / "bronze").rglob("*.json") for line in p.read_text().splitlines()]
    assert {e["event_id"]: e["revenue"] for e in landed} == {"e1": 0.0, "late": 0.0}
    assert next(e for e in landed if e["event_id"] == "e1")["metadata"] == {"experiment_group": "A", "ad": 7}
    assert (tmp_path / "bronze/year=2024/month=01/day=06/hour=23").is_dir()
    reasons = sorted(spark.read.json(bad).select("reject_reasons").collect())
    assert [r[0][0] for r in reasons] == ["bad_event_type", "malformed_record", "malformed_record"]
    counts = [p["observedMetrics"]["ingest"] for p in map(lambda p: json.loads(p.json), query.recentProgress) if p.get("observedMetrics")]
    assert sum(c["received"] for c in counts) == 5 and sum(c["accepted"] for c in counts) == 2


def test_restart_lands_each_event_once(spark, tmp_path):
    source, bronze, checkpoint = (str(tmp_path / n) for n in ("in", "bronze", "c"))
    for batch in range(3):
        write_lines(source, event(event_id=f"b{batch}"), directory=".", name=f"{batch}.json")
        arriving = landing.read_event_stream(spark, source, max_files_per_trigger=1)
        finish(landing.land_events(arriving, bronze, checkpoint, AS_OF, ONCE))
    assert rows(read_bronze(spark, bronze), "event_id") == [("b0",), ("b1",), ("b2",)]


@pytest.mark.parametrize("salts", [0, 4])
def test_stream_to_silver_deduplicates_across_batches(spark, tmp_path, salts):
    source, silver, checkpoint = (str(tmp_path / n) for n in ("in", "silver", "c"))
    hot = [event(event_id="hot", event_timestamp=at(5, f"10:00:{i:02d}")) for i in range(40)]
    write_lines(source, event(), event(event_id="bad", revenue=-1.0), *hot, directory=".", name="0.json")
    run = lambda: finish(
        landing.stream_to_silver(
            landing.read_event_stream(spark, source), silver, checkpoint, "1 hour", AS_OF, salts, ONCE
        )
    )
    run()
    write_lines(source, event(), *hot[:5], event(event_id="new"), directory=".", name="1.json")
    run()
    table = read_silver(spark, silver)
    assert rows(table, "event_id") == [("e1",), ("hot",), ("new",)]
    batch = clean_events(landing_batch(spark, source), AS_OF)
    assert [(f.name, f.dataType) for f in table.select(*batch.columns).schema] == [(f.name, f.dataType) for f in batch.schema]
    assert rows(batch, "event_id") == rows(table, "event_id")


def landing_batch(spark, source):
    return read_bronze(spark, source)
