"""The query library over the metric tables.

Each function takes metric tables (calendar-sized: rows per date, feature, cohort or step)
and returns the answer. Window functions without a partition run over one row per date.
Ordering is part of the answer of a report; ties are settled by the row's key.
"""

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import safe_ratio
from tidemark.operators.clean import parse_date
from tidemark.schema import GOLD, RETENTION_DAYS


def _by_date(table: DataFrame, *columns: str | Column) -> DataFrame:
    return table.select("event_date", *columns).orderBy("event_date")


def _latest(table: DataFrame, rows: int, *columns: str | Column) -> DataFrame:
    return table.select("event_date", *columns).orderBy(F.desc("event_date")).limit(rows)


# --- active users -----------------------------------------------------------------------


def latest_active_users(daily: DataFrame) -> DataFrame:
    return _latest(
        daily, 1, "daily_active_users", "weekly_active_users", "monthly_active_users", "dau_mau_stickiness"
    )


def dau_trend(daily: DataFrame, days: int = 30) -> DataFrame:
    return _latest(daily, days, "daily_active_users")


def stickiness_trend(daily: DataFrame) -> DataFrame:
    return _by_date(daily, "dau_mau_stickiness")


def new_vs_returning(daily: DataFrame, days: int = 14) -> DataFrame:
    total = (F.col("new_users") + F.col("returning_users")).alias("total_active_users")
    return _latest(daily, days, "new_users", "returning_users", total)


def latest_product_kpis(daily: DataFrame) -> DataFrame:
    """The headline cards of the newest day, session length included."""
    return _latest(
        daily,
        1,
        "daily_active_users",
        "weekly_active_users",
        "monthly_active_users",
        "dau_mau_stickiness",
        "avg_session_duration",
    )


def events_per_day(daily: DataFrame) -> DataFrame:
    return _by_date(daily, "total_events")


def week_over_week_growth(daily: DataFrame) -> DataFrame:
    """Growth against the row seven rows earlier (rows, not calendar days)."""
    week_ago = F.lag("daily_active_users", 7).over(Window.orderBy("event_date"))
    now, before = F.col("daily_active_users"), F.col("dau_7_days_ago")
    return (
        daily.select("event_date", "daily_active_users")
        .withColumn("dau_7_days_ago", week_ago)
        .withColumn("wow_growth_rate", F.try_divide((now - before).cast("double"), before.cast("double")))
        .orderBy("event_date")
    )


def active_users_long(daily: DataFrame) -> DataFrame:
    kinds = ["daily_active_users", "weekly_active_users", "monthly_active_users"]
    return daily.unpivot("event_date", kinds, "metric", "users")


def user_status_long(daily: DataFrame) -> DataFrame:
    return daily.unpivot("event_date", ["new_users", "returning_users"], "user_type", "count")


# --- retention --------------------------------------------------------------------------


def average_retention(retention: DataFrame) -> DataFrame:
    """Retention per day weighted by cohort size, over the cohorts that have a row."""
    return (
        retention.groupBy("retention_day")
        .agg(F.sum("retained_users").alias("total_retained"), F.sum("cohort_size").alias("total_cohort_size"))
        .withColumn("avg_retention_rate", safe_ratio(F.col("total_retained"), F.col("total_cohort_size")))
        .orderBy("retention_day")
    )


def overall_retention(retention: DataFrame) -> DataFrame:
    return average_retention(retention).select("retention_day", "avg_retention_rate")


def retention_on_day(retention: DataFrame, day: int = 7) -> DataFrame:
    return (
        retention.filter(F.col("retention_day") == day)
        .select("signup_date", "cohort_size", "retained_users", "retention_rate")
        .orderBy(F.desc("signup_date"))
    )


def worst_cohorts(retention: DataFrame, day: int = 1, rows: int = 10) -> DataFrame:
    return (
        retention.filter(F.col("retention_day") == day)
        .select("signup_date", "cohort_size", "retention_rate")
        .orderBy("retention_rate", "signup_date")
        .limit(rows)
    )


def retention_trend(retention: DataFrame) -> DataFrame:
    return retention.select("signup_date", "retention_day", "retention_rate").orderBy("signup_date", "retention_day")


def retention_pivot(retention: DataFrame, days: tuple[int, ...] = (1, 7, 30)) -> DataFrame:
    rate_on = lambda d: F.max(F.when(F.col("retention_day") == d, F.col("retention_rate")))
    return (
        retention.groupBy("signup_date")
        .agg(*[rate_on(d).alias(f"day_{d}_retention") for d in days])
        .orderBy("signup_date")
    )


def retention_heatmap(retention: DataFrame, days: tuple[int, ...] = RETENTION_DAYS) -> DataFrame:
    """Mean rate per cohort and day, one column per day."""
    wide = retention.groupBy("signup_date").pivot("retention_day", list(days)).agg(F.avg("retention_rate"))
    return wide.select("signup_date", *[F.col(str(d)).alias(f"day_{d}") for d in days]).orderBy("signup_date")


# --- funnel -----------------------------------------------------------------------------

_FUNNEL_COLUMNS = ("funnel_step", "step_order", "users_reached", "conversion_rate", "drop_off_rate")


def latest_funnel(funnel: DataFrame) -> DataFrame:
    """The newest cohort's funnel. The table holds one row per cohort and step."""
    newest = F.max("event_date").over(Window.partitionBy())
    return (
        funnel.withColumn("newest", newest)
        .filter(F.col("event_date") == F.col("newest"))
        .select(*_FUNNEL_COLUMNS)
        .orderBy("step_order")
    )


def funnel_for_cohort(funnel: DataFrame, cohort: date | str) -> DataFrame:
    return funnel.filter(F.col("event_date") == F.lit(parse_date(cohort))).select(*_FUNNEL_COLUMNS).orderBy("step_order")


def cohort_dates(funnel: DataFrame) -> DataFrame:
    """Cohorts to choose from, newest first."""
    return funnel.select("event_date").distinct().orderBy(F.desc("event_date"))


def conversion_by_step(funnel: DataFrame) -> DataFrame:
    return funnel.select("event_date", "funnel_step", "conversion_rate").orderBy("event_date", "funnel_step")


def average_conversion(funnel: DataFrame) -> DataFrame:
    return (
        funnel.groupBy("funnel_step", "step_order")
        .agg(F.avg("conversion_rate").alias("avg_conversion_rate"))
        .orderBy("step_order")
    )


def worst_drop_off(funnel: DataFrame, rows: int = 5) -> DataFrame:
    return (
        funnel.filter("step_order > 1")
        .groupBy("funnel_step", "step_order")
        .agg(F.avg("drop_off_rate").alias("avg_drop_off_rate"))
        .orderBy(F.desc("avg_drop_off_rate"), "step_order")
        .limit(rows)
    )


def drop_off_by_step(funnel: DataFrame) -> DataFrame:
    return (
        funnel.filter("step_order > 1")
        .select("event_date", "funnel_step", "drop_off_rate")
        .orderBy("event_date", "funnel_step")
    )


def conversion_trend(funnel: DataFrame, step: str = "subscription_started") -> DataFrame:
    return (
        funnel.filter(F.col("funnel_step") == step)
        .select("event_date", F.col("conversion_rate").alias("signup_to_subscription_rate"))
        .orderBy("event_date")
    )


# --- features ---------------------------------------------------------------------------


def top_features(features: DataFrame, rows: int = 15) -> DataFrame:
    """All-time totals. ``total_unique_users`` adds daily uniques, so it counts user-days."""
    return (
        features.groupBy("feature")
        .agg(F.sum("event_count").alias("total_events"), F.sum("unique_users").alias("total_unique_users"))
        .orderBy(F.desc("total_events"), "feature")
        .limit(rows)
    )


def feature_trend(features: DataFrame, feature: str) -> DataFrame:
    return _by_date(features.filter(F.col("feature") == feature), "event_count", "unique_users")


def feature_adoption(features: DataFrame, daily: DataFrame) -> DataFrame:
    users = daily.select("event_date", "daily_active_users")
    return adoption_rates(features.select("event_date", "feature", "unique_users").join(users, "event_date"))


def adoption_rates(feature_users: DataFrame) -> DataFrame:
    """The same where a date's active users stand beside its features."""
    rate = safe_ratio(F.col("unique_users"), F.col("daily_active_users")).alias("feature_adoption_rate")
    return feature_users.select("event_date", "feature", "unique_users", "daily_active_users", rate).orderBy(
        F.desc("event_date"), F.desc("feature_adoption_rate"), "feature"
    )


# --- revenue and business ---------------------------------------------------------------


def business_summary(daily: DataFrame, revenue: DataFrame) -> DataFrame:
    users = daily.select("event_date", "daily_active_users", "monthly_active_users", "dau_mau_stickiness")
    return users.join(revenue, "event_date", "left").orderBy(F.desc("event_date"))


def business_days(users_and_revenue: DataFrame) -> DataFrame:
    """The same from a table that has both sides of a date."""
    users = ("daily_active_users", "monthly_active_users", "dau_mau_stickiness")
    revenue = GOLD["revenue_metrics"].fieldNames()[1:]
    return users_and_revenue.select("event_date", *users, *revenue).orderBy(F.desc("event_date"))


def latest_business_day(users_and_revenue: DataFrame) -> DataFrame:
    """``kpi_snapshot`` from a table that has both sides of a date."""
    columns = ("daily_active_users", "monthly_active_users", "total_events", "total_revenue")
    return users_and_revenue.agg(F.max("event_date").alias("event_date"), *[F.max_by(c, "event_date").alias(c) for c in columns])


def arpu_and_arppu(revenue: DataFrame) -> DataFrame:
    per_payer = F.try_divide(F.col("total_revenue"), F.col("paying_users").cast("double")).alias("arppu")
    return revenue.select("event_date", "total_revenue", "paying_users", per_payer, "arpu").orderBy(
        F.desc("event_date")
    )


def latest_revenue(revenue: DataFrame) -> DataFrame:
    """The headline cards of the newest day."""
    net = (F.col("subscription_starts") - F.col("subscription_cancellations")).alias("net_subscriptions")
    return _latest(revenue, 1, "total_revenue", "paying_users", "arpu", net)


def revenue_trend(revenue: DataFrame) -> DataFrame:
    return _by_date(revenue, "total_revenue", "arpu")


def net_subscriptions(revenue: DataFrame) -> DataFrame:
    net = F.col("subscription_starts") - F.col("subscription_cancellations")
    return _by_date(revenue, "subscription_starts", "subscription_cancellations", net.alias("net_subscriptions"))


def subscriptions_long(revenue: DataFrame) -> DataFrame:
    return revenue.unpivot("event_date", ["subscription_starts", "subscription_cancellations"], "type", "count")


def kpi_snapshot(daily: DataFrame, revenue: DataFrame) -> DataFrame:
    """Newest users, events and revenue in one row; each table contributes its own newest day."""
    newest = lambda c: F.max_by(c, "event_date").alias(c)
    users = daily.agg(
        F.max("event_date").alias("event_date"),
        newest("daily_active_users"),
        newest("monthly_active_users"),
        newest("total_events"),
    )
    both = users.unionByName(revenue.agg(newest("total_revenue")), allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in both.columns])


# --- anomalies --------------------------------------------------------------------------


def flagged_anomalies(anomalies: DataFrame) -> DataFrame:
    return (
        anomalies.filter("is_anomaly")
        .select("event_date", "metric_name", "actual_value", "expected_value", "anomaly_score")
        .orderBy(F.desc("event_date"), "metric_name")
    )


def metric_names(anomalies: DataFrame) -> DataFrame:
    """Metrics to choose from."""
    return anomalies.select("metric_name").distinct().orderBy("metric_name")


def anomaly_series(anomalies: DataFrame, metric_name: str) -> DataFrame:
    return _by_date(
        anomalies.filter(F.col("metric_name") == metric_name), "actual_value", "expected_value", "is_anomaly"
    )


def anomaly_counts(anomalies: DataFrame) -> DataFrame:
    return anomalies.agg(F.count_if("is_anomaly").alias("anomalies_flagged"), F.count("*").alias("total_rows"))
