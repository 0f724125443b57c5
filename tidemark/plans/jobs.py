"""Jobs: clean, check, roll up, build metric tables, backfill.

Between silver and gold sit three rollups partitioned by date (user-days, session-days and
feature usage). A run over a date range re-reads only those silver partitions and replaces
only those rollup partitions; the metric tables are then rebuilt from the rollups, which are
orders of magnitude smaller than the events.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date, datetime, timezone
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import quality
from tidemark.operators.anomaly import anomaly_report
from tidemark.operators.clean import clean_events, earliest_per_id, merge_events, parse_date, passing_events, rules_for, tag_events, to_silver
from tidemark.operators.daily import active_users, assemble_daily, session_days
from tidemark.operators.features import feature_days, usage_from_feature_days
from tidemark.operators.funnel import first_steps_from_user_days, funnel_from_first_steps
from tidemark.operators.retention import retention_from_active_days
from tidemark.operators.revenue import revenue_from_user_days
from tidemark.operators.user_days import user_days
from tidemark.schema import ANOMALY_THRESHOLD, ANOMALY_WINDOW
from tidemark.session import shuffles_sized_for
from tidemark.sources.idindex import IdIndex, delete
from tidemark.sources.lake import (
    SILVER_ORDER,
    gold_path,
    load_gold,
    read_bronze,
    read_silver,
    write_by_date,
    write_gold,
)
from tidemark.sources.zonemap import ZoneMap

Day = date | str


class QualityCheckFailed(ValueError):
    """Raised by a blocking quality run; carries the failed check rows."""

    def __init__(self, failed: list[dict]):
        super().__init__(f"silver does not pass its checks: {failed}")
        self.failed = failed


# --- files ------------------------------------------------------------------------------


def _path_missing(error: AnalysisException) -> bool:
    return error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def _read_if_present(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return read_silver(spark, path)
    except AnalysisException as error:
        if _path_missing(error):
            return None
        raise


def _dates(table: DataFrame | None, scope: Column) -> set[date]:
    """Distinct partition dates within a scope; one value per day at most."""
    if table is None:
        return set()
    return {row.event_date for row in table.filter(scope).select("event_date").distinct().collect()}


def _staging_path(spark: SparkSession, beside: str) -> str:
    """A fresh folder on shared storage: the cluster's checkpoint folder, else beside the table."""
    shared = spark.conf.get("spark.checkpoint.dir", "") or f"{beside.rstrip('/')}_staging"
    return f"{shared.rstrip('/')}/tidemark-{uuid.uuid4().hex}"


def _replace_dates(
    spark: SparkSession, fresh: DataFrame, filled: set[date], path: str, cluster_by: tuple[str, ...], scope: Column
) -> None:
    """Make a table hold exactly ``fresh`` on the dates of ``scope``.

    Dates in ``filled`` are overwritten; other dates of the scope lose their partition.
    """
    before = _dates(_read_if_present(spark, path), scope)
    write_by_date(fresh, path, cluster_by, only_touched_dates=True)
    for day in sorted(before - filled):
        delete(spark, f"{path.rstrip('/')}/event_date={day.isoformat()}")


def _before(start: date | None) -> Column:
    return F.col("event_date") < F.lit(start) if start else F.lit(False)


def _after(end: date | None) -> Column:
    return F.col("event_date") > F.lit(end) if end else F.lit(False)


def _within(start: date | None, end: date | None, also: set[date] = frozenset()) -> Column:
    scope = ~(_before(start) | _after(end))
    return scope | F.col("event_date").isin(sorted(also)) if also else scope


def checked_range(start_date: Day | None, end_date: Day | None) -> tuple[date | None, date | None]:
    """Bounds as dates; either may be open, but not both."""
    start = parse_date(start_date) if start_date else None
    end = parse_date(end_date) if end_date else None
    if not (start or end):
        raise ValueError("a date range needs start_date or end_date (YYYY-MM-DD)")
    if start and end and start > end:
        raise ValueError(f"start_date {start} is after end_date {end}")
    return start, end


# --- bronze to silver -------------------------------------------------------------------


@dataclass(frozen=True)
class _Passing:
    """Staged rows that pass every row rule, and the report's lines up to the dedup."""

    rows: DataFrame
    counts: dict[str, int]

    def report(self, clean_count: int) -> dict[str, int]:
        passed = self.counts["raw_count"] - sum(n for line, n in self.counts.items() if line != "raw_count")
        return {**self.counts, "dropped_duplicates": passed - clean_count, "clean_count": clean_count}


def _stage_passing(bronze: DataFrame, path: str, now: datetime | str, start: date | None = None, end: date | None = None) -> _Passing:
    """Parse and tag bronze once: passing rows go to ``path``, and the same job counts rows in and rows dropped.

    The job has no shuffle, so its counts are taken by the tasks of an action, once for each partition
    whatever is retried; the sampling of a later range partitioning reads the staged rows.
    """
    tagged = tag_events(bronze, now, start_date=start, end_date=end)
    reason, seen = F.col("reject_reason"), Observation()
    dropped = [F.count_if(reason == rule).alias(f"dropped_{rule}") for rule in rules_for(bronze)]
    passing = passing_events(tagged.observe(seen, F.count(F.lit(1)).alias("raw_count"), *dropped))
    passing.write.parquet(path)
    return _Passing(bronze.sparkSession.read.schema(passing.schema).parquet(path), dict(seen.get))


def _deduplicated(passing: DataFrame) -> DataFrame:
    return to_silver(earliest_per_id(passing, "event_id", "event_timestamp"))


def clean_bronze(
    spark: SparkSession, bronze_path: str | list[str], silver_path: str, as_of: datetime | str | None = None
) -> dict[str, int]:
    """Rebuild the silver table and its id index from all of bronze; returns the drop report.

    Bronze is parsed once. The counts come from that pass and from the rows written.
    """
    now = as_of or datetime.now(timezone.utc)
    bronze = read_bronze(spark, bronze_path)
    staging = _staging_path(spark, silver_path)
    try:
        with shuffles_sized_for(bronze):
            passing = _stage_passing(bronze, staging, now)
            write_by_date(_deduplicated(passing.rows), silver_path, SILVER_ORDER)
            silver = read_silver(spark, silver_path) if passing.rows.take(1) else _deduplicated(passing.rows)
            IdIndex(spark, silver_path).build(silver)
            return passing.report(silver.count())
    finally:
        delete(spark, staging)


@dataclass(frozen=True)
class Backfill:
    """What a silver backfill did: the drop report and the dates it rewrote beyond its range."""

    report: dict[str, int]
    other_dates: set[date]


def backfill_silver(
    spark: SparkSession,
    bronze_path: str | list[str],
    silver_path: str,
    start_date: Day | None,
    end_date: Day | None,
    as_of: datetime | str | None = None,
    zones: bool = False,
) -> Backfill:
    """Replace the silver partitions of a date range from bronze.

    An event id stays unique in the whole table, and the earliest copy is the one kept, as a
    full rebuild would: rows whose id sits on an earlier date are left out, and later dates
    holding a copy of a row in the range are rewritten without it. Ids that the range no longer
    holds come back from their copies on other dates. Which other dates hold an id is looked up in
    the table's id index, whose entries stay where they lie; the event rows of untouched dates are not read. The
    range is staged on shared storage first, so no table is read while overwritten. With ``zones``, the
    zone map beside bronze says which directories hold events of the range, and only these are read.
    """
    start, end = checked_range(start_date, end_date)
    now = as_of or datetime.now(timezone.utc)
    bronze = read_bronze(spark, bronze_path, start, end)
    in_reach = _from_zones(spark, bronze_path, start, end) if zones else bronze
    silver = _read_if_present(spark, silver_path)
    staging = _staging_path(spark, silver_path)
    try:
        with shuffles_sized_for(in_reach):
            passing = _stage_passing(in_reach, f"{staging}/passing", now, start, end)
            range_rows = _staged(spark, f"{staging}/range", _deduplicated(passing.rows))
            other_dates = _replace_silver(spark, bronze, silver, range_rows, silver_path, staging, start, end, now)
            return Backfill(passing.report(range_rows.count()), other_dates)
    finally:
        delete(spark, staging)


def _from_zones(spark: SparkSession, bronze_path: str | list[str], start: date | None, end: date | None) -> DataFrame:
    parts = []
    for root in [bronze_path] if isinstance(bronze_path, str) else bronze_path:
        zones = ZoneMap(spark, root)
        zones.refresh()
        parts.append(zones.read(start, end))
    return reduce(DataFrame.unionByName, parts)


def _staged(spark: SparkSession, path: str, df: DataFrame) -> DataFrame:
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _replace_silver(
    spark: SparkSession,
    bronze: DataFrame,
    silver: DataFrame | None,
    fresh: DataFrame,
    silver_path: str,
    staging: str,
    start: date | None,
    end: date | None,
    now: datetime | str,
) -> set[date]:
    """Put ``fresh`` in the place of the range, keeping ids unique; returns the other dates that were rewritten."""
    index = IdIndex(spark, silver_path)
    if silver is None:
        _replace_dates(spark, fresh, _dates(fresh, F.lit(True)), silver_path, SILVER_ORDER, _within(start, end))
        index.build(fresh)
        return set()
    index.ready(silver)
    with index.dates_of(fresh) as held:
        shared_ids = _staged(spark, f"{staging}/shared_ids", held.filter(~_within(start, end)))
    returning = _staged(spark, f"{staging}/returning", _returning(bronze, silver, fresh, start, end, now))
    earlier = shared_ids.filter(_before(start)).select("event_id")
    fresh = fresh.join(earlier, "event_id", "left_anti")
    other_dates = _dates(shared_ids, _after(end)) | _dates(returning, F.lit(True))
    if other_dates:
        displaced = shared_ids.filter(_after(end)).select("event_id")
        on_those_dates = silver.filter(F.col("event_date").isin(sorted(other_dates)))
        kept = on_those_dates.join(displaced, "event_id", "left_anti")
        fresh = fresh.unionByName(_staged(spark, f"{staging}/kept", kept.unionByName(returning)))
    scope = _within(start, end, other_dates)
    fresh = _staged(spark, f"{staging}/fresh", fresh)
    before = _staged(spark, f"{staging}/before", silver.filter(scope).select("event_id", "event_date"))
    with index.changing(before, fresh):
        _replace_dates(spark, fresh, _dates(fresh, scope), silver_path, SILVER_ORDER, scope)
    return other_dates


def _returning(
    bronze: DataFrame, silver: DataFrame, fresh: DataFrame, start: date | None, end: date | None, now: datetime | str
) -> DataFrame:
    """Clean copies on dates outside the range of ids that silver had in the range and the fresh range has not."""
    gone = silver.filter(_within(start, end)).select("event_id").join(fresh.select("event_id"), "event_id", "left_anti")
    if gone.isEmpty():
        return fresh.limit(0)
    copies = clean_events(bronze.join(gone, "event_id", "left_semi"), now)
    return copies.select(*fresh.columns).filter(~_within(start, end))


def merge_into_silver(spark: SparkSession, rows: DataFrame, silver_path: str) -> set[date]:
    """Add rows of the silver schema; of every id the earliest copy stays. Returns the dates that were rewritten.

    Only dates that get rows, or that hold a copy of an id among them, are read and written.
    """
    silver = _read_if_present(spark, silver_path)
    staging = _staging_path(spark, silver_path)
    index = IdIndex(spark, silver_path)
    try:
        with shuffles_sized_for(rows):
            fresh = _staged(spark, f"{staging}/rows", rows)
            dates = _dates(fresh, F.lit(True))
            if silver is not None:
                index.ready(silver)
                with index.dates_of(fresh) as held:
                    dates |= _dates(held, F.lit(True))
            if not dates:
                return dates
            scope = F.col("event_date").isin(sorted(dates))
            present = fresh.limit(0) if silver is None else silver.filter(scope)
            after = _staged(spark, f"{staging}/after", merge_events(present.select(*fresh.columns), fresh))
            if silver is None:
                write_by_date(after, silver_path, SILVER_ORDER, only_touched_dates=True)
                index.build(after)
                return dates
            before = _staged(spark, f"{staging}/before", present.select("event_id", "event_date"))
            with index.changing(before, after):
                _replace_dates(spark, after, _dates(after, scope), silver_path, SILVER_ORDER, scope)
            return dates
    finally:
        delete(spark, staging)


def run_merge(spark: SparkSession, rows_into_silver: Callable[[], set[date]], silver_path: str, gold_root: str, as_of: datetime | str | None = None) -> set[date]:
    """Merge rows into silver, check it, and bring rollups and metric tables up to date with the dates that changed."""
    touched = rows_into_silver()
    if touched:
        check_changes(spark, silver_path, F.col("event_date").isin(sorted(touched)), as_of=as_of)
        refresh_rollups(spark, silver_path, gold_root, only=touched)
        build_gold(spark, gold_root)
    return touched


# --- quality ----------------------------------------------------------------------------


@dataclass(frozen=True)
class QualityRun:
    checks: list[dict]
    summary: str
    run_at: str

    @property
    def failed(self) -> list[dict]:
        return [check for check in self.checks if not check["passed"]]


_SUBSETS = {
    "all": (quality.all_checks, "checks passed"),
    "schema": (quality.schema_checks, "schema checks passed"),
    "freshness": (quality.freshness_checks, "freshness checks passed"),
}


def run_checks(
    silver: DataFrame, subset: str = "all", mode: str = "warn", as_of: datetime | str | None = None, **options
) -> QualityRun:
    """Run the checks of a subset; ``mode="raise"`` blocks on any failure, ``"warn"`` reports."""
    if mode not in ("raise", "warn"):
        raise ValueError(f"mode must be 'raise' or 'warn', not {mode!r}")
    build, label = _SUBSETS[subset]
    now = as_of or datetime.now(timezone.utc)
    with shuffles_sized_for(silver):
        rows = build(silver, as_of=now, **options).orderBy("check_order").collect()  # at most seven rows
    checks = [{"name": r.name, "passed": r.passed, "detail": r.detail} for r in rows]
    return _conclude(checks, label, mode)


def check_silver(spark: SparkSession, silver_path: str, subset: str = "all", mode: str = "warn", **options) -> QualityRun:
    """The same for a silver path; an unreadable table fails its partition check."""
    silver = _read_if_present(spark, silver_path)
    if silver is None:
        detail = f"{quality.UNREADABLE}: nothing at {silver_path}"
        missing = [{"name": "required_partitions_exist", "passed": False, "detail": detail}]
        return _conclude(missing, _SUBSETS[subset][1], mode)
    return run_checks(silver, subset, mode, **options)


def counters_path(silver_path: str) -> str:
    return f"{silver_path.rstrip('/')}_quality"


def refresh_counters(spark: SparkSession, silver_path: str, scope: Column | None = None) -> None:
    """Counters of the checks for the dates of a scope, or for all if there are none yet or no scope is given."""
    silver, path = read_silver(spark, silver_path), counters_path(silver_path)
    if scope is None or _read_if_present(spark, path) is None:
        with shuffles_sized_for(silver):
            write_by_date(quality.day_counters(silver), path)
        return
    chosen = silver.filter(scope)
    with shuffles_sized_for(chosen):
        _replace_dates(spark, quality.day_counters(chosen), _dates(chosen, F.lit(True)), path, (), scope)


def check_changes(
    spark: SparkSession, silver_path: str, scope: Column | None, mode: str = "raise", as_of: datetime | str | None = None, **options
) -> QualityRun:
    """The verdicts of all checks after a change: only the dates of the scope are read again (all without one).

    Repeats of an id across dates come from the id index.
    """
    refresh_counters(spark, silver_path, scope)
    silver, index = read_silver(spark, silver_path), IdIndex(spark, silver_path)
    index.ready(silver)
    counters = spark.read.parquet(counters_path(silver_path))
    now = as_of or datetime.now(timezone.utc)
    with index.repeats() as repeats:
        rows = quality.checks_of_counters(counters, silver, repeats, as_of=now, **options).orderBy("check_order").collect()  # seven rows
    return _conclude([{"name": r.name, "passed": r.passed, "detail": r.detail} for r in rows], _SUBSETS["all"][1], mode)


def _conclude(checks: list[dict], label: str, mode: str) -> QualityRun:
    passed = sum(check["passed"] for check in checks)
    run = QualityRun(checks, f"{passed}/{len(checks)} {label}", datetime.now(timezone.utc).isoformat())
    if mode == "raise" and run.failed:
        raise QualityCheckFailed(run.failed)
    return run


# --- silver to gold ---------------------------------------------------------------------

# name -> (builder from silver events, order within a date)
ROLLUPS = {
    "user_days": (user_days, ("user_id",)),
    "session_days": (session_days, ()),
    "feature_days": (feature_days, ("feature",)),
}


def rollup_path(gold_root: str, name: str) -> str:
    return f"{gold_root.rstrip('/')}/_rollups/{name}"


def refresh_rollups(
    spark: SparkSession,
    silver_path: str,
    gold_root: str,
    start_date: Day | None = None,
    end_date: Day | None = None,
    also: set[date] = frozenset(),
    only: set[date] | None = None,
) -> None:
    """Rebuild the rollups: all of them, only the dates of a range and those in ``also``, or those in ``only``.

    A range needs rollups that already cover the other dates; where one is missing, all are built.
    """
    silver = read_silver(spark, silver_path)
    missing = any(_read_if_present(spark, rollup_path(gold_root, name)) is None for name in ROLLUPS)
    if missing or (start_date is None and end_date is None and only is None):
        with shuffles_sized_for(silver):
            for name, (build, order) in ROLLUPS.items():
                write_by_date(build(silver), rollup_path(gold_root, name), order)
        return
    scope = F.col("event_date").isin(sorted(only)) if only is not None else _within(*checked_range(start_date, end_date), also)
    filled = _dates(silver, scope)
    chosen = silver.filter(scope)
    with shuffles_sized_for(chosen):
        for name, (build, order) in ROLLUPS.items():
            # Every rollup has a row on every date with events, so silver's dates are theirs.
            _replace_dates(spark, build(chosen), filled, rollup_path(gold_root, name), order, scope)


def build_gold(
    spark: SparkSession,
    gold_root: str,
    window_size: int = ANOMALY_WINDOW,
    threshold: float = ANOMALY_THRESHOLD,
) -> None:
    """Rebuild all six metric tables from the rollups.

    The five independent ones are submitted together so that their stages overlap.
    """
    days, sessions, features = (spark.read.parquet(rollup_path(gold_root, name)) for name in ROLLUPS)
    tables = {
        "daily_user_metrics": assemble_daily(active_users(days), sessions),
        "retention_cohorts": retention_from_active_days(days),
        "funnel_metrics": funnel_from_first_steps(first_steps_from_user_days(days)),
        "feature_usage": usage_from_feature_days(features),
        "revenue_metrics": revenue_from_user_days(days),
    }
    with shuffles_sized_for(days), ThreadPoolExecutor(len(tables)) as pool:
        writes = [pool.submit(write_gold, table, gold_path(gold_root, name)) for name, table in tables.items()]
        for write in writes:
            write.result()
    daily, revenue = (load_gold(spark, gold_root, name) for name in ("daily_user_metrics", "revenue_metrics"))
    report = anomaly_report(daily, revenue, window_size, threshold)
    write_gold(report, gold_path(gold_root, "anomaly_detection"))


def rebuild_gold(spark: SparkSession, silver_path: str, gold_root: str) -> None:
    """Rollups and metric tables from all of silver, for use after silver changed by other means."""
    refresh_rollups(spark, silver_path, gold_root)
    build_gold(spark, gold_root)


def run_daily(
    spark: SparkSession,
    bronze_path: str | list[str],
    silver_path: str,
    gold_root: str,
    as_of: datetime | str | None = None,
) -> tuple[dict[str, int], QualityRun]:
    """Clean everything, stop if a quality check fails, then rebuild rollups and metric tables."""
    report = clean_bronze(spark, bronze_path, silver_path, as_of)
    checks = check_changes(spark, silver_path, None, as_of=as_of)
    rebuild_gold(spark, silver_path, gold_root)
    return report, checks


def run_backfill(
    spark: SparkSession,
    bronze_path: str | list[str],
    silver_path: str,
    gold_root: str,
    start_date: Day,
    end_date: Day,
    as_of: datetime | str | None = None,
    mode: str = "raise",
    zones: bool = False,
) -> dict[str, int]:
    """Redo a date range from bronze through all six metric tables.

    Silver is checked in between, at the cost of the dates that changed; a failing check stops the run before gold unless ``mode`` is ``"warn"``.
    """
    if not (start_date and end_date):
        raise ValueError("a backfill needs both start_date and end_date (YYYY-MM-DD)")
    done = backfill_silver(spark, bronze_path, silver_path, start_date, end_date, as_of, zones)
    check_changes(spark, silver_path, _within(*checked_range(start_date, end_date), done.other_dates), mode, as_of)
    refresh_rollups(spark, silver_path, gold_root, start_date, end_date, done.other_dates)
    build_gold(spark, gold_root)
    return done.report
