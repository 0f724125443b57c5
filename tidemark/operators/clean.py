"""Bronze to silver: row rules, deduplication, standardised columns, and the drop report.

Every row gets the name of the first rule it breaks, so the drop counts equal those of
filtering rule after rule, in one pass over the input. Deduplication keeps one row per
``event_id`` through ``row_number() = 1``: Spark then applies the limit before the shuffle
as well, so a hot id leaves each map task as a single row.
"""

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import event_time, first_reason, is_blank, known_metadata, moment, no_amount
from tidemark.schema import CLOCK_SKEW_SECONDS, CORRUPT, EVENT_COLUMNS, EVENT_TYPES, SILVER

# Rules in the order they are applied.
RULES = (
    "bad_timestamp",
    "future_timestamp",
    "missing_ids",
    "bad_event_type",
    "negative_revenue",
)

# The last rule of input read from files: a number that is none.
MISTYPED = "mistyped_field"


def rules_for(bronze: DataFrame) -> tuple[str, ...]:
    return (*RULES, MISTYPED) if CORRUPT in bronze.columns else RULES


def parse_date(value: date | str) -> date:
    if isinstance(value, datetime):
        return value.date()
    return value if isinstance(value, date) else date.fromisoformat(value)


def in_date_range(time: Column, start: date | str | None, end: date | str | None) -> Column:
    """Both bounds inclusive; the end date counts through its last microsecond."""
    inside = F.lit(True)
    if start is not None:
        inside = inside & (time >= F.lit(parse_date(start).isoformat()).cast("timestamp"))
    if end is not None:
        day_after = parse_date(end) + timedelta(days=1)
        inside = inside & (time < F.lit(day_after.isoformat()).cast("timestamp"))
    return inside


def tag_events(
    bronze: DataFrame,
    as_of: datetime | str | Column | None = None,
    skew_seconds: int = CLOCK_SKEW_SECONDS,
    start_date: date | str | None = None,
    end_date: date | str | None = None,
) -> DataFrame:
    """Add ``event_time`` and ``reject_reason`` (NULL for rows that pass every row rule).

    With a date range, rows outside it leave the frame; rows whose time does not parse
    belong to no date and stay, so that they are still counted.
    """
    time = F.col("event_time")
    latest = moment(as_of) + F.make_dt_interval(secs=F.lit(skew_seconds))
    failed = {
        "bad_timestamp": time.isNull(),
        "future_timestamp": time > latest,
        "missing_ids": is_blank(F.col("event_id")) | is_blank(F.col("user_id")),
        "bad_event_type": ~F.coalesce(F.col("event_type").isin(*EVENT_TYPES), F.lit(False)),
        "negative_revenue": no_amount(F.col("revenue")),
    }
    if CORRUPT in bronze.columns:
        failed[MISTYPED] = F.col(CORRUPT).isNotNull()
    parsed = bronze.withColumn("event_time", event_time(F.col("event_timestamp")))
    if start_date is not None or end_date is not None:
        parsed = parsed.filter(time.isNull() | in_date_range(time, start_date, end_date))
    return parsed.withColumn("reject_reason", first_reason({rule: failed[rule] for rule in rules_for(bronze)}))


def earliest_per_id(events: DataFrame, key: str, time: str) -> DataFrame:
    """One row per ``key``: the earliest by ``time``, ties settled by the row's content.

    Leading with the hash settles most comparisons of the sort on its 8-byte prefix, where
    ids sharing their first characters would not be.
    """
    content = [c for c in events.columns if c not in (key, time)]
    order = Window.partitionBy(F.xxhash64(key), key).orderBy(time, *content)
    return events.withColumn("_copy", F.row_number().over(order)).filter("_copy = 1").drop("_copy")


def clean_events(
    bronze: DataFrame,
    as_of: datetime | str | Column | None = None,
    skew_seconds: int = CLOCK_SKEW_SECONDS,
    start_date: date | str | None = None,
    end_date: date | str | None = None,
) -> DataFrame:
    """The silver table: valid events, one per id, in the silver schema."""
    passed = passing_events(tag_events(bronze, as_of, skew_seconds, start_date, end_date))
    return to_silver(earliest_per_id(passed, "event_id", "event_timestamp"))


def merge_events(silver: DataFrame, fresh: DataFrame) -> DataFrame:
    """Both tables' rows with one row per id, the earliest, whichever table it is in."""
    return earliest_per_id(silver.unionByName(fresh), "event_id", "event_timestamp")


def passing_events(tagged: DataFrame) -> DataFrame:
    """Rows that pass every row rule, with the parsed timestamp and the known metadata."""
    return (
        tagged.filter("reject_reason IS NULL")
        .withColumn("metadata", known_metadata(tagged))
        .withColumn("event_timestamp", F.col("event_time"))
        .select(*EVENT_COLUMNS)
    )


def to_silver(events: DataFrame) -> DataFrame:
    """Standardised columns and the partition date, in the silver schema."""
    return events.select(*[_standardised(f.name).cast(f.dataType).alias(f.name) for f in SILVER])


def _standardised(name: str) -> Column:
    if name in ("platform", "device_type"):
        return F.lower(name)
    if name == "country":
        return F.upper(name)
    if name == "revenue":
        return F.coalesce(F.col(name), F.lit(0.0))
    if name == "event_date":
        return F.to_date("event_timestamp")
    return F.col(name)


def rejected_events(
    bronze: DataFrame, as_of: datetime | str | Column | None = None, skew_seconds: int = CLOCK_SKEW_SECONDS
) -> DataFrame:
    """Rows that break a row rule, with the first rule they break."""
    return tag_events(bronze, as_of, skew_seconds).filter("reject_reason IS NOT NULL").drop("event_time")


def quality_report(
    bronze: DataFrame,
    as_of: datetime | str | Column | None = None,
    skew_seconds: int = CLOCK_SKEW_SECONDS,
    start_date: date | str | None = None,
    end_date: date | str | None = None,
) -> DataFrame:
    """Rows in, rows dropped per rule and rows kept: ``(line_order, line, row_count)``.

    Only ids of passing rows and a count are shuffled, combined map-side first.
    """
    tagged = tag_events(bronze, as_of, skew_seconds, start_date, end_date)
    reason = F.col("reject_reason")
    per_id = tagged.groupBy(reason, F.when(reason.isNull(), F.col("event_id")).alias("passing_id")).agg(
        F.count("*").alias("copies")
    )
    copies, passes = F.col("copies"), reason.isNull()
    values = {
        "raw_count": F.sum(copies),
        **{f"dropped_{rule}": F.sum(F.when(reason == rule, copies)) for rule in rules_for(bronze)},
        "dropped_duplicates": F.sum(F.when(passes, copies - 1)),
        "clean_count": F.count_if(passes),
    }
    totals = per_id.agg(*[F.coalesce(value, F.lit(0)).alias(line) for line, value in values.items()])
    lines = F.array(
        *[
            F.struct(F.lit(i).alias("line_order"), F.lit(line).alias("line"), F.col(line).alias("row_count"))
            for i, line in enumerate(values)
        ]
    )
    return totals.select(F.inline(lines))
