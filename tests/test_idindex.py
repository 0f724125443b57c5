"""The id index and the counters of the checks: where they read, and that they follow silver."""

import json

import pytest
from pyspark.sql import functions as F

from samples import AS_OF, at, event, rows
from test_jobs import write_lines
from tidemark.operators import quality
from tidemark.operators.clean import clean_events, quality_report
from tidemark.plans import jobs
from tidemark.sources.idindex import IdIndex
from tidemark.sources.lake import read_bronze, read_silver


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString().splitlines()


def depth(line):
    return len(line) - len(line.lstrip(" :+-"))


@pytest.fixture
def lake(spark, tmp_path):
    bronze, silver, gold = (str(tmp_path / n) for n in ("bronze", "silver", "gold"))
    for d in range(1, 9):
        events = [event(event_id=f"{d}-{u}", user_id=f"u{u}", event_timestamp=at(d)) for u in range(12)]
        write_lines(bronze, *events, event(event_id="everywhere", event_timestamp=at(d)), event(event_id="bad", revenue=-1.0, event_timestamp=at(d)), directory=f"year=2024/month=01/day={d:02d}")
    report, checks = jobs.run_daily(spark, bronze, silver, gold, AS_OF)
    return bronze, silver, gold, report, checks


def held(spark, silver, ids):
    with IdIndex(spark, silver).dates_of(ids) as found:
        return rows(found)


def pairs(df):
    return rows(df.select("event_id", "event_date"))


def test_lookups_shuffle_only_the_ids_asked_for(spark, lake):
    _, silver, *_ = lake
    table = read_silver(spark, silver)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold"), spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "150")
    try:
        with IdIndex(spark, silver).dates_of(table.where("event_date = DATE'2024-01-03'")) as found:
            lines = plan(found)
            scan = next(k for k, line in enumerate(lines) if "Bucketed: true" in line)
            shuffles = [k for k, line in enumerate(lines) if "Exchange" in line]
            # no shuffle above the index's scan: all lie on the other, later side of the join
            assert shuffles and all(k > scan for k in shuffles)
            assert pairs(found) == pairs(table.where("event_date = DATE'2024-01-03'"))
        with IdIndex(spark, silver).repeats() as repeats:
            assert sum("Exchange" in line for line in plan(repeats)) == 1 and "SinglePartition" in "".join(plan(repeats))
            assert repeats.first()[0] == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before[0])
        spark.conf.set("spark.sql.shuffle.partitions", before[1])


def test_index_follows_backfills_and_is_rebuilt_after_a_failure(spark, lake, monkeypatch):
    bronze, silver, gold, *_ = lake
    write_lines(bronze, event(event_id="5-1", event_timestamp=at(4)), event(event_id="fresh", event_timestamp=at(4)), directory="year=2024/month=01/day=04")
    jobs.run_backfill(spark, bronze, silver, gold, "2024-01-04", "2024-01-04", AS_OF)
    want = pairs(clean_events(read_bronze(spark, bronze), AS_OF))
    assert pairs(read_silver(spark, silver)) == held(spark, silver, read_silver(spark, silver)) == want

    write_lines(bronze, event(event_id="6-1", event_timestamp=at(2)), directory="year=2024/month=01/day=02")
    with monkeypatch.context() as broken:
        broken.setattr(IdIndex, "_append", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            jobs.backfill_silver(spark, bronze, silver, "2024-01-02", "2024-01-02", AS_OF)
    assert IdIndex(spark, silver)._state() is None
    jobs.run_backfill(spark, bronze, silver, gold, "2024-01-02", "2024-01-02", AS_OF)
    want = pairs(clean_events(read_bronze(spark, bronze), AS_OF))
    assert pairs(read_silver(spark, silver)) == held(spark, silver, read_silver(spark, silver)) == want


def test_counts_of_the_write_equal_the_report(spark, lake):
    bronze, silver, _, report, _ = lake
    frame = read_bronze(spark, bronze)
    want = {r.line: r.row_count for r in quality_report(frame, AS_OF).collect()}
    assert report == want and list(report) == [r.line for r in quality_report(frame, AS_OF).orderBy("line_order").collect()]
    ranged = jobs.backfill_silver(spark, bronze, silver, "2024-01-03", "2024-01-05", AS_OF).report
    assert ranged == {r.line: r.row_count for r in quality_report(frame, AS_OF, start_date="2024-01-03", end_date="2024-01-05").collect()}


def verdicts(df):
    return [(r.name, r.passed, r.detail) for r in df.orderBy("check_order").collect()]


@pytest.mark.parametrize("as_of", [AS_OF, "2024-01-07T12:00:00Z", "2024-01-01T00:00:00Z"])
def test_counters_give_the_verdicts_of_the_full_checks(spark, lake, as_of):
    _, silver, *_ = lake
    table = read_silver(spark, silver)
    dirty = table.unionByName(table.where("event_date = DATE'2024-01-02'").withColumn("event_type", F.lit("odd")).limit(5))
    dirty = dirty.unionByName(table.limit(3).withColumn("event_id", F.lit(""))).unionByName(table.limit(2).withColumn("revenue", F.lit(-2.0)))
    for frame in (table, dirty):
        across = frame.select("event_id", "event_date").distinct().groupBy("event_id").agg((F.count("*") - 1).alias("more"))
        repeats = across.agg(F.sum("more").alias("repeats"))
        got = quality.checks_of_counters(quality.day_counters(frame), frame, repeats, as_of=as_of, expected_date="2024-01-08")
        assert verdicts(got) == verdicts(quality.all_checks(frame, as_of=as_of, expected_date="2024-01-08"))


def test_the_gate_of_a_backfill_reads_the_dates_that_changed(spark, lake):
    _, silver, _, _, checks = lake
    assert [c["passed"] for c in checks.checks] == [True] * 7
    counters = jobs.counters_path(silver)
    stamp = {p: p.stat().st_mtime_ns for p in __import__("pathlib").Path(counters).glob("event_date=*/*.parquet")}
    scope = F.col("event_date") == "2024-01-03"
    run = jobs.check_changes(spark, silver, scope, as_of=AS_OF)
    after = {p: p.stat().st_mtime_ns for p in __import__("pathlib").Path(counters).glob("event_date=*/*.parquet")}
    kept = {p for p in stamp if stamp[p] == after.get(p)}
    assert {p.parent.name for p in set(stamp) - kept} == {"event_date=2024-01-03"}
    assert json.dumps(run.checks) == json.dumps(jobs.check_silver(spark, silver, as_of=AS_OF).checks)
