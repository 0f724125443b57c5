"""Churn proxy: users active in one stretch of dates and absent from a later one."""

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.clean import parse_date


def lapsed_users(
    activity: DataFrame,
    active_from: date | str,
    active_to: date | str,
    absent_from: date | str,
    absent_to: date | str,
) -> DataFrame:
    """Users seen in the first date range and not in the second, one row each.

    A single aggregation over the two ranges; the date filter prunes partitions.
    """

    def between(first, last):
        return F.col("event_date").between(F.lit(parse_date(first)), F.lit(parse_date(last)))

    was_active, is_back = between(active_from, active_to), between(absent_from, absent_to)
    return (
        activity.filter("user_id IS NOT NULL")
        .filter(was_active | is_back)
        .groupBy("user_id")
        .agg(F.bool_or(was_active).alias("was_active"), F.bool_or(is_back).alias("is_back"))
        .filter("was_active AND NOT is_back")
        .select("user_id")
    )
