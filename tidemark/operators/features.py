"""Feature usage per day."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.schema import GOLD


def feature_days(silver: DataFrame) -> DataFrame:
    """Usage per date and feature, events without a feature included under NULL.

    The first grouping carries the user, which spreads a hot feature over all tasks; the
    second one starts from counts already combined map-side.
    """
    per_user = silver.groupBy("event_date", "feature", "user_id").agg(F.count("*").alias("uses"))
    return (
        per_user.groupBy("event_date", "feature")
        .agg(
            F.sum("uses").alias("event_count"),
            F.count("user_id").alias("unique_users"),
            F.avg("uses").alias("avg_events_per_user"),
        )
        .select(*GOLD["feature_usage"].fieldNames())
    )


def feature_usage(silver: DataFrame) -> DataFrame:
    """The gold ``feature_usage`` table from silver events; the filter reaches the scan."""
    return usage_from_feature_days(feature_days(silver))


def usage_from_feature_days(days: DataFrame) -> DataFrame:
    return days.filter("feature IS NOT NULL").select(*GOLD["feature_usage"].fieldNames())


def feature_adoption_days(silver: DataFrame) -> DataFrame:
    """Users of each feature and all active users, per date, from one pass over events."""
    per_user = silver.groupBy("event_date", "user_id").agg(F.collect_set("feature").alias("features"))
    users = F.count("user_id")
    # one row for the user and one for each of the user's features, which are few
    used = per_user.select("event_date", "user_id", F.explode_outer(F.concat(F.array(F.lit(None).cast("string")), "features")).alias("feature"))
    per_date = used.groupBy("event_date", "feature").agg(users.alias("unique_users"))
    whole = F.max(F.when(F.col("feature").isNull(), F.col("unique_users"))).over(Window.partitionBy("event_date"))
    return per_date.withColumn("daily_active_users", whole).filter("feature IS NOT NULL")
