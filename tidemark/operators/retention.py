"""Retention cohorts: of the users first active on a date, how many came back k days later."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import safe_ratio
from tidemark.operators.user_days import active_days
from tidemark.schema import GOLD, RETENTION_DAYS


def retention_cohorts(activity: DataFrame, days: Sequence[int] = RETENTION_DAYS) -> DataFrame:
    """The gold ``retention_cohorts`` table from any frame with ``user_id`` and ``event_date``."""
    return retention_from_active_days(active_days(activity), days)


def retention_from_active_days(active: DataFrame, days: Sequence[int] = RETENTION_DAYS) -> DataFrame:
    """The same from rows already distinct per user and date.

    Rows exist only where at least one user came back. Each user counts once per offset
    because user-days are distinct, so plain counts suffice and no join is needed.
    """
    first_day = F.min("event_date").over(Window.partitionBy("user_id"))
    came_back = lambda day: F.count_if(F.col("offset") == day)
    cohorts = (
        active.select("user_id", "event_date")
        .filter("user_id IS NOT NULL")
        .withColumn("signup_date", first_day)
        .withColumn("offset", F.datediff("event_date", "signup_date"))
        .groupBy("signup_date")
        .agg(came_back(0).alias("cohort_size"), *[came_back(d).alias(f"back_{d}") for d in days])
    )
    by_day = F.array(
        *[F.struct(F.lit(d).alias("retention_day"), F.col(f"back_{d}").alias("retained_users")) for d in days]
    )
    return (
        cohorts.select("signup_date", "cohort_size", F.inline(by_day))
        .filter("retained_users > 0")
        .withColumn("retention_rate", safe_ratio(F.col("retained_users"), F.col("cohort_size")))
        .select(*GOLD["retention_cohorts"].fieldNames())
    )
