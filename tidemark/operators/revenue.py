"""Revenue and subscriptions per day."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import safe_ratio
from tidemark.operators.daily import active_users
from tidemark.operators.user_days import user_days
from tidemark.schema import GOLD


def _measures() -> dict[str, Column]:
    """What a date's revenue row adds up from its user-days."""
    pays = (F.col("payments") > 0) & F.col("user_id").isNotNull()
    return {
        "total_revenue": F.sum("revenue"),
        "paying_users": F.count_if(pays),
        "subscription_starts": F.sum("subscription_starts"),
        "subscription_cancellations": F.sum("subscription_cancellations"),
    }


def revenue_from_user_days(days: DataFrame) -> DataFrame:
    """Revenue is spread over every active user of the day, payer or not."""
    measures = {**_measures(), "active_users": F.count("user_id")}
    return (
        days.groupBy("event_date")
        .agg(*[value.alias(name) for name, value in measures.items()])
        .withColumn("total_revenue", F.coalesce("total_revenue", F.lit(0.0)))
        .withColumn("arpu", safe_ratio(F.col("total_revenue"), F.col("active_users")))
        .select(*GOLD["revenue_metrics"].fieldNames())
    )


def users_and_revenue(days: DataFrame) -> DataFrame:
    """The daily table without sessions and the revenue table side by side, from one pass over user-days."""
    return active_users(days, _measures()).withColumn("arpu", safe_ratio(F.col("total_revenue"), F.col("daily_active_users")))


def revenue_metrics(silver: DataFrame) -> DataFrame:
    """The gold ``revenue_metrics`` table from silver events."""
    return revenue_from_user_days(user_days(silver))
