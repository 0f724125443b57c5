"""The user-day rollup: one row per user and active date.

Most metric tables need events only at this grain. The grouping key includes the date and
combines map-side, so a user with a third of all events costs no task more than its share,
and everything after it handles at most one row per user and date. Unused measures are
pruned by Catalyst, so each consumer reads only the columns behind the measures it selects.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.schema import FUNNEL_STEPS


def first_time_column(step: str) -> str:
    return f"first_{step}"


def active_days(activity: DataFrame) -> DataFrame:
    """Distinct ``(user_id, event_date)`` of known users."""
    return activity.select("user_id", "event_date").filter("user_id IS NOT NULL").distinct()


def user_days(silver: DataFrame) -> DataFrame:
    is_type = lambda name: F.col("event_type") == name
    paid = F.col("revenue") > 0
    return silver.groupBy("user_id", "event_date").agg(
        F.count("*").alias("events"),
        F.sum(F.when(paid, F.col("revenue"))).alias("revenue"),
        F.count_if(paid).alias("payments"),
        F.count_if(is_type("subscription_started")).alias("subscription_starts"),
        F.count_if(is_type("subscription_cancelled")).alias("subscription_cancellations"),
        *[
            F.min(F.when(is_type(step), F.col("event_timestamp"))).alias(first_time_column(step))
            for step in FUNNEL_STEPS
        ],
    )
