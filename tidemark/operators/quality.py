"""Data-quality checks of the silver table as one DataFrame of check rows.

Two narrow aggregations feed all seven checks: one over ``event_id`` alone and one per
date over the remaining columns, so no column is read twice.
"""

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import moment
from tidemark.operators.clean import parse_date
from tidemark.schema import EVENT_TYPES, VOLUME_DROP_THRESHOLD, VOLUME_TRAILING_DAYS

# Check names, in report order.
CHECKS = (
    "no_null_event_ids",
    "no_duplicate_event_ids",
    "valid_event_types_only",
    "timestamps_not_in_future",
    "revenue_not_negative",
    "event_volume_not_unusually_low",
    "required_partitions_exist",
)
# Which checks belong to which subset.
SCHEMA_CHECKS = (
    "no_null_event_ids",
    "no_duplicate_event_ids",
    "valid_event_types_only",
    "revenue_not_negative",
)
FRESHNESS_CHECKS = (
    "timestamps_not_in_future",
    "event_volume_not_unusually_low",
    "required_partitions_exist",
)

# What each check says about what it found.
FOUND = {
    "no_null_event_ids": "rows with null/empty event_id",
    "no_duplicate_event_ids": "duplicate event_id rows",
    "valid_event_types_only": "rows with unrecognized event_type",
    "timestamps_not_in_future": "rows with future event_timestamp",
    "revenue_not_negative": "rows with negative revenue",
}
TOO_FEW_DAYS = "not enough days of data to evaluate"
VOLUME_FOUND = "latest=%d, trailing_avg=%.1f, drop_pct=%.1f%%"
DATES_FOUND = "distinct event_date partitions found"
UNREADABLE = "could not read silver table"


def _check_row(name: str, passed: Column, detail: Column) -> Column:
    return F.struct(
        F.lit(CHECKS.index(name)).alias("check_order"),
        F.lit(name).alias("name"),
        passed.alias("passed"),
        detail.alias("detail"),
    )


def _counting_check(name: str, bad: Column) -> Column:
    found = F.coalesce(bad, F.lit(0))
    return _check_row(name, found == 0, F.concat(found.cast("string"), F.lit(" " + FOUND[name])))


def id_checks(silver: DataFrame) -> DataFrame:
    per_id = silver.groupBy("event_id").agg(F.count("*").alias("copies"))
    return _id_rows(per_id.agg(F.sum(F.when(_empty_id(), F.col("copies"))).alias("empty_ids"), F.sum(F.col("copies") - 1).alias("repeats")))


def _empty_id() -> Column:
    return F.col("event_id").isNull() | (F.col("event_id") == "")


def _id_rows(totals: DataFrame) -> DataFrame:
    rows = F.array(
        _counting_check("no_null_event_ids", F.col("empty_ids")),
        _counting_check("no_duplicate_event_ids", F.col("repeats")),
    )
    return totals.select(F.inline(rows))


def day_checks(
    silver: DataFrame,
    as_of: datetime | str | Column | None = None,
    skew_seconds: int = 0,
    drop_threshold: float = VOLUME_DROP_THRESHOLD,
    expected_date: date | str | None = None,
) -> DataFrame:
    latest_allowed = moment(as_of) + F.make_dt_interval(secs=F.lit(skew_seconds))
    per_day = silver.groupBy("event_date").agg(*_day_counts(), F.count_if(F.col("event_timestamp") > latest_allowed).alias("in_future"))
    return _day_rows(per_day, drop_threshold, expected_date)


def _day_counts() -> list[Column]:
    return [
        F.count("*").alias("events"),
        F.count_if(~F.col("event_type").isin(*EVENT_TYPES)).alias("unknown_types"),
        F.count_if(F.col("revenue") < 0).alias("negative"),
    ]


def _day_rows(per_day: DataFrame, drop_threshold: float, expected_date: date | str | None) -> DataFrame:
    # From here on one row per date: the running mean and the roll-up are calendar-sized.
    earlier = Window.orderBy("event_date").rowsBetween(-VOLUME_TRAILING_DAYS, -1)
    newest = lambda c: F.max_by(c, "event_date")
    present = F.lit(True)
    if expected_date is not None:
        present = F.coalesce(F.bool_or(F.col("event_date") == F.lit(parse_date(expected_date))), F.lit(False))
    totals = per_day.withColumn("trailing_avg", F.avg("events").over(earlier)).agg(
        F.sum("unknown_types").alias("unknown_types"),
        F.sum("in_future").alias("in_future"),
        F.sum("negative").alias("negative"),
        F.count("*").alias("dates"),
        newest("events").alias("latest"),
        newest("trailing_avg").alias("trailing_avg"),
        present.alias("expected_present"),
    )
    latest, average = F.col("latest"), F.col("trailing_avg")
    drop = 1 - latest / average
    steady = F.when(average > 0, drop < drop_threshold).otherwise(F.lit(True))
    volume_detail = F.when(
        average > 0,
        F.format_string(VOLUME_FOUND, latest, average, drop * 100),
    ).otherwise(F.lit(TOO_FEW_DAYS))
    rows = F.array(
        _counting_check("valid_event_types_only", F.col("unknown_types")),
        _counting_check("timestamps_not_in_future", F.col("in_future")),
        _counting_check("revenue_not_negative", F.col("negative")),
        _check_row("event_volume_not_unusually_low", steady, volume_detail),
        _check_row(
            "required_partitions_exist",
            (F.col("dates") > 0) & F.col("expected_present"),
            F.concat(F.col("dates").cast("string"), F.lit(" " + DATES_FOUND)),
        ),
    )
    return totals.select(F.inline(rows))


def all_checks(silver: DataFrame, **options) -> DataFrame:
    """Seven rows ``(check_order, name, passed, detail)``; options as in ``day_checks``."""
    return id_checks(silver).unionByName(day_checks(silver, **options))


def day_counters(silver: DataFrame) -> DataFrame:
    """One row for each date, made of that date's rows alone: what the checks need to know of it.

    ``repeats`` counts rows beyond the first of an id on the date; ``newest`` is its latest event time.
    """
    per_id = silver.groupBy("event_date", "event_id").agg(*_day_counts(), F.max("event_timestamp").alias("newest"))
    return per_id.groupBy("event_date").agg(
        F.sum(F.when(_empty_id(), F.col("events")).otherwise(0)).alias("empty_ids"),
        F.sum(F.col("events") - 1).alias("repeats"),
        *(F.sum(c).alias(c) for c in ("events", "unknown_types", "negative")),
        F.max("newest").alias("newest"),
    )


def checks_of_counters(
    counters: DataFrame,
    silver: DataFrame,
    repeats: DataFrame,
    as_of: datetime | str | Column | None = None,
    skew_seconds: int = 0,
    drop_threshold: float = VOLUME_DROP_THRESHOLD,
    expected_date: date | str | None = None,
) -> DataFrame:
    """The rows of ``all_checks`` from the counters of all dates and the ids' repeats across dates (one row).

    Of silver, only dates whose newest event lies in the future are counted again.
    """
    latest_allowed = moment(as_of) + F.make_dt_interval(secs=F.lit(skew_seconds))
    open_dates = sorted(r.event_date for r in counters.where(F.col("newest") > latest_allowed).select("event_date").collect())
    ahead = silver.where(F.col("event_date").isin(open_dates) & (F.col("event_timestamp") > latest_allowed))
    ahead = ahead.groupBy("event_date").agg(F.count("*").alias("in_future"))
    per_day = counters.join(F.broadcast(ahead), "event_date", "left").withColumn("in_future", F.coalesce("in_future", F.lit(0)))
    counted = counters.select("empty_ids", "repeats").unionByName(repeats.select(F.lit(0).alias("empty_ids"), "repeats"))
    totals = counted.agg(F.sum("empty_ids").alias("empty_ids"), F.sum("repeats").alias("repeats"))
    return _id_rows(totals).unionByName(_day_rows(per_day, drop_threshold, expected_date))


def schema_checks(silver: DataFrame, **options) -> DataFrame:
    return all_checks(silver, **options).filter(F.col("name").isin(*SCHEMA_CHECKS))


def freshness_checks(silver: DataFrame, **options) -> DataFrame:
    """Needs only the per-date aggregation, so ids are not read at all."""
    return day_checks(silver, **options).filter(F.col("name").isin(*FRESHNESS_CHECKS))


def summary(checks: DataFrame) -> DataFrame:
    """One row: how many checks passed out of how many."""
    return checks.agg(F.count_if("passed").alias("passed"), F.count("*").alias("total")).withColumn(
        "summary",
        F.concat(F.col("passed").cast("string"), F.lit("/"), F.col("total").cast("string"), F.lit(" checks passed")),
    )
