"""Rules an event must meet on arrival. The same columns serve batch and streaming input."""

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import all_reasons, event_time, is_blank, moment, no_amount
from tidemark.schema import CLOCK_SKEW_SECONDS, CORRUPT, EVENT_TYPES


def validate_events(
    bronze: DataFrame, as_of: datetime | str | Column | None = None, skew_seconds: int = CLOCK_SKEW_SECONDS
) -> DataFrame:
    """Add ``reject_reasons``: every arrival rule the event breaks (empty if accepted).

    Text fields may be empty unless they are identifiers. A missing revenue counts as 0.0.
    """
    time = event_time(F.col("event_timestamp"))
    latest = moment(as_of) + F.make_dt_interval(secs=F.lit(skew_seconds))
    broken: dict[str, Column] = {}
    if CORRUPT in bronze.columns:
        broken["malformed_record"] = F.col(CORRUPT).isNotNull()
    for name in ("event_id", "user_id", "session_id"):
        broken[f"missing_{name}"] = is_blank(F.col(name))
    broken["bad_event_type"] = ~F.coalesce(F.col("event_type").isin(*EVENT_TYPES), F.lit(False))
    broken["bad_timestamp"] = time.isNull()
    broken["future_timestamp"] = time > latest
    for name in ("platform", "device_type", "country", "city", "app_version"):
        broken[f"missing_{name}"] = F.col(name).isNull()
    broken["negative_duration"] = F.col("duration_seconds") < 0
    broken["negative_revenue"] = no_amount(F.col("revenue"))
    return bronze.withColumn("reject_reasons", all_reasons(broken))


def accepted(validated: DataFrame) -> DataFrame:
    return (
        validated.filter(F.size("reject_reasons") == 0)
        .drop("reject_reasons", CORRUPT)
        .withColumn("revenue", F.coalesce("revenue", F.lit(0.0)))
    )


def rejected(validated: DataFrame) -> DataFrame:
    return validated.filter(F.size("reject_reasons") > 0)


def ingest_counts(validated: DataFrame) -> DataFrame:
    """How many events were accepted and rejected, and how many broke each rule."""
    outcome = F.when(F.size("reject_reasons") == 0, F.lit("accepted")).otherwise(F.lit("rejected"))
    labels = F.concat(F.array(outcome), F.col("reject_reasons"))
    return validated.select(F.explode(labels).alias("outcome")).groupBy("outcome").agg(F.count("*").alias("events"))
