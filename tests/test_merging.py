"""Streamed batches with late rows, retries, and the merge into silver against cleaning everything at once."""

import json

import pytest

from samples import AS_OF, at, event, rows
from test_jobs import write_lines
from tidemark.operators.clean import clean_events
from tidemark.plans import jobs
from tidemark.sources.idindex import IdIndex
from tidemark.sources.lake import read_bronze, read_silver
from tidemark.streaming import landing, merging

ONCE = landing.UNTIL_CAUGHT_UP


def stream(spark, source, root, checkpoint):
    merging.stream_batches(landing.read_event_stream(spark, source, 1), root, checkpoint, as_of=AS_OF, trigger=ONCE).awaitTermination()


def ledger(spark, root):
    return [(r.batch, r.rows, r.late) for r in merging.read_ledger(spark, root).orderBy("query", "batch").collect()]


def folders(spark, root):
    """Rows and late rows of every batch folder, as files hold them."""
    lines = merging._unmerged(spark, root)
    return [(line.batch, d.count(), d.where("late").count()) for line in lines for d in [merging._batches(spark, root, [line])]]


@pytest.fixture
def streamed(spark, tmp_path):
    source, root, checkpoint = (str(tmp_path / n) for n in ("in", "stream", "c"))
    write_lines(source, event(), event(event_id="copy", event_timestamp=at(5, "10:05:00")), event(event_id="bad", revenue=-1.0), directory=".", name="0.json")
    stream(spark, source, root, checkpoint)
    # hours late, a day late, an earlier and a later copy of an id, a copy of an event of its own batch
    write_lines(source, event(event_id="late", event_timestamp=at(5, "02:00:00")), event(event_id="day", event_timestamp=at(3)), event(event_id="copy", event_timestamp=at(4)), directory=".", name="1.json")
    stream(spark, source, root, checkpoint)
    write_lines(source, event(event_timestamp=at(6)), event(event_id="new", event_timestamp=at(6)), event(event_id="new", event_timestamp=at(6)), directory=".", name="2.json")
    stream(spark, source, root, checkpoint)
    return source, root


def everything(df):
    return sorted(json.dumps(r.asDict(True), default=str, sort_keys=True) for r in df.collect())


def test_nothing_is_lost_and_the_merge_equals_batch(spark, streamed, tmp_path):
    source, root = streamed
    silver = str(tmp_path / "silver")
    assert ledger(spark, root) == folders(spark, root) == [(0, 2, 0), (1, 3, 3), (2, 2, 0)]
    want = clean_events(read_bronze(spark, source), AS_OF)
    assert everything(merging.read_streamed(spark, root)) == everything(want)
    assert rows(merging.read_streamed(spark, root, late=True), "event_id") == [("copy",), ("day",), ("late",)]
    merging.merge_stream(spark, root, silver)
    assert everything(read_silver(spark, silver).select(*want.columns)) == everything(want)
    assert merging.read_streamed(spark, root).count() == 0 and merging.merge_stream(spark, root, silver) == set()
    assert [tuple(r) for r in merging.read_ledger(spark, root).select("rows", "late", "merged").collect()] == [(7, 3, True)]


def test_a_retried_batch_changes_nothing(spark, streamed):
    source, root = streamed
    before = ledger(spark, root), everything(merging.read_streamed(spark, root))
    query = merging.read_ledger(spark, root).first()["query"]
    again = landing.typed_numbers(spark.read.schema(landing.BRONZE_AS_READ).json(f"{source}/1.json"))
    retried = merging.passing_events(merging.tag_events(again, AS_OF))
    merging.write_batch(retried, query, 1, root)
    assert (ledger(spark, root), everything(merging.read_streamed(spark, root))) == before
    assert ledger(spark, root) == folders(spark, root)


def test_rows_without_a_ledger_line_are_not_read(spark, streamed):
    _, root = streamed
    query = merging.read_ledger(spark, root).first()["query"]
    merging.read_streamed(spark, root).limit(1).withColumn("late", merging.F.lit(False)).write.partitionBy("late", "event_date").parquet(f"{root}/rows/{query}/batch=9")
    assert merging.read_streamed(spark, root).count() == 5


def test_merge_settles_copies_with_silver_and_refreshes_gold(spark, streamed, tmp_path):
    source, root = streamed
    silver, gold, bronze = (str(tmp_path / n) for n in ("silver", "gold", "bronze"))
    write_lines(bronze, event(event_id="late", event_timestamp=at(7)), event(event_id="new", event_timestamp=at(1)), event(event_id="own", event_timestamp=at(7)))
    jobs.run_daily(spark, bronze, silver, gold, AS_OF)
    touched = jobs.run_merge(spark, lambda: merging.merge_stream(spark, root, silver), silver, gold, AS_OF)
    want = clean_events(read_bronze(spark, [bronze, source]), AS_OF)
    assert everything(read_silver(spark, silver).select(*want.columns)) == everything(want)
    assert {d.day for d in touched} == {1, 3, 4, 5, 6, 7}
    with IdIndex(spark, silver).dates_of(want) as held:
        assert rows(held) == rows(want.select("event_id", "event_date"))
    daily = spark.read.parquet(f"{gold}/daily_user_metrics").agg({"total_events": "sum"}).first()[0]
    assert daily == want.count()


def test_both_outcomes_by_one_query(spark, tmp_path):
    source, root = str(tmp_path / "in"), str(tmp_path / "landed")
    write_lines(source, event(revenue=None), event(event_id="x", event_type="dance"), "{broken", directory=".", name="0.json")
    arriving = landing.read_event_stream(spark, source)
    for _ in range(2):
        query = landing.land_both(arriving, root, str(tmp_path / "c"), AS_OF, ONCE)
        query.awaitTermination()
    lines = [(p.relative_to(root).parts[0], json.loads(line)) for p in (tmp_path / "landed").rglob("*.json") for line in p.read_text().splitlines()]
    assert sorted((o, e.get("event_id"), e.get("revenue")) for o, e in lines if "event_id" in e) == [("outcome=accepted", "e1", 0.0), ("outcome=rejected", "x", 0.0)]
    assert len(lines) == 3 and not any("reject_reasons" in e for o, e in lines if o == "outcome=accepted")
    assert rows(read_bronze(spark, root), "event_id") == [("e1",)]
    assert all(len(json.loads(p.json)["sources"]) == 1 for p in query.recentProgress)
