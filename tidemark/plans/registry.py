"""Every query by name, from the test tables: ``{name: fn(spark, sf_dir) -> DataFrame}``."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import event_time
from tidemark.operators import quality, validate
from tidemark.operators.anomaly import anomaly_report_from_user_days
from tidemark.operators.churn import lapsed_users
from tidemark.operators.clean import clean_events, in_date_range, merge_events, quality_report, rejected_events
from tidemark.operators.daily import active_users, daily_user_metrics
from tidemark.operators.features import feature_adoption_days, feature_usage
from tidemark.operators.funnel import funnel_metrics
from tidemark.operators.retention import retention_cohorts
from tidemark.operators.revenue import revenue_metrics, users_and_revenue
from tidemark.operators.user_days import user_days
from tidemark.plans import kpis
from tidemark.sources import testtables
from tidemark.sources.lake import BRONZE_LEVELS, hourly_directories

Query = Callable[[SparkSession, str], DataFrame]

BACKFILL = ("2024-01-10", "2024-01-16")
COHORT = "2024-01-01"
FEATURE = "feature_1"
METRIC = "daily_active_users"
CHURN_RANGES = ("2024-01-28", "2024-01-29", "2024-01-30", "2024-01-30")
ORDER_CHURN_RANGES = ("1998-06-08", "1998-06-14", "1998-06-15", "1998-06-21")


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return testtables.silver_events(spark, sf_dir)


def _full_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_user_metrics(_silver(spark, sf_dir))


def _daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily table without its session columns, for queries that do not need them."""
    return active_users(user_days(_silver(spark, sf_dir)))


def _retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retention_cohorts(_silver(spark, sf_dir))


def _order_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retention_cohorts(testtables.order_activity(spark, sf_dir))


def _funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return funnel_metrics(_silver(spark, sf_dir))


def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feature_usage(_silver(spark, sf_dir))


def _revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return revenue_metrics(_silver(spark, sf_dir))


def _daily_and_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both tables from one pass over the events."""
    return users_and_revenue(user_days(_silver(spark, sf_dir)))


def _anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anomaly_report_from_user_days(user_days(_silver(spark, sf_dir)))


def _printable(silver: DataFrame) -> DataFrame:
    """Silver rows with the timestamp as text and the metadata flattened."""
    text = F.date_format("event_timestamp", testtables.TEXT_FORMAT)
    return silver.withColumn("event_timestamp", text).select(
        *[c for c in silver.columns if c != "metadata"], "metadata.experiment_group", "metadata.referrer"
    )


def _on(table: Query, answer: Callable[..., DataFrame], *args) -> Query:
    return lambda spark, sf_dir: answer(table(spark, sf_dir), *args)


def _bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return testtables.bronze_events(spark, sf_dir)


def _clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_events(_bronze(spark, sf_dir), as_of=testtables.AS_OF)


def _clean_without_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_events(testtables.bronze_events(spark, sf_dir, with_country=False), as_of=testtables.AS_OF)


def _report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(testtables.bronze_events(spark, sf_dir, with_country=False), as_of=testtables.AS_OF)


def _rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejected_events(_bronze(spark, sf_dir), as_of=testtables.AS_OF).select(
        "event_id", "user_id", "event_type", "event_timestamp", "revenue", "reject_reason"
    )


def _validated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.validate_events(_bronze(spark, sf_dir), as_of=testtables.AS_OF)


def _validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _validated(spark, sf_dir).select(
        "event_id",
        "event_timestamp",
        (F.size("reject_reasons") == 0).alias("accepted"),
        F.concat_ws(",", "reject_reasons").alias("reject_reasons"),
    )


def _hourly_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = testtables.bronze_events(spark, sf_dir, with_country=False)
    landed = hourly_directories(bronze, as_of=testtables.AS_OF)
    return landed.groupBy(*BRONZE_LEVELS).agg(F.count("*").alias("events"))


def _backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    start, end = BACKFILL
    bronze = _bronze(spark, sf_dir)
    return _printable(clean_events(bronze, as_of=testtables.AS_OF, start_date=start, end_date=end))


def _backfill_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A silver table that was cleaned without the days of the range, and the range merged into it: a full rebuild."""
    start, end = BACKFILL
    bronze = _bronze(spark, sf_dir)
    in_range = in_date_range(event_time(F.col("event_timestamp")), start, end)
    old = clean_events(bronze.filter(~F.coalesce(in_range, F.lit(False))), as_of=testtables.AS_OF)
    fresh = clean_events(bronze, as_of=testtables.AS_OF, start_date=start, end_date=end)
    return _printable(merge_events(old, fresh))


def _backfill_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    start, end = BACKFILL
    bronze = testtables.bronze_events(spark, sf_dir, with_country=False)
    return quality_report(bronze, as_of=testtables.AS_OF, start_date=start, end_date=end)


def _checks(checks: Callable[..., DataFrame]) -> Query:
    return lambda spark, sf_dir: checks(_silver(spark, sf_dir), as_of=testtables.AS_OF)


def _raw_as_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze rows typed like silver but not cleaned, so that checks have something to find."""
    time = F.try_to_timestamp(F.col("event_timestamp"))
    bronze = testtables.bronze_events(spark, sf_dir, with_country=False)
    return bronze.withColumn("event_timestamp", time).withColumn("event_date", F.to_date("event_timestamp"))


def _checks_on_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.all_checks(_raw_as_silver(spark, sf_dir), as_of=testtables.AS_OF)


QUERIES: dict[str, Query] = {
    # bronze and silver
    "bronze_validate_events": _validation,
    "bronze_ingest_counts": _on(_validated, validate.ingest_counts),
    "bronze_hourly_layout": _hourly_layout,
    "silver_clean_events": _on(_clean, _printable),
    "silver_rejected_events": _rejects,
    "silver_quality_report": _report,
    "silver_backfill_range": _backfill,
    "silver_backfill_merged": _backfill_merged,
    "silver_backfill_report": _backfill_report,
    # rollup and metric tables
    "silver_user_days": lambda spark, sf_dir: user_days(_silver(spark, sf_dir)).select(
        "user_id", "event_date", "events", "revenue", "payments", "subscription_starts", "subscription_cancellations"
    ),
    "gold_daily_user_metrics": _full_daily,
    "gold_daily_from_bronze": _on(_clean_without_country, daily_user_metrics),
    "gold_retention_cohorts": _retention,
    "gold_retention_orders": _order_retention,
    "gold_funnel_metrics": _funnel,
    "gold_feature_usage": _features,
    "gold_revenue_metrics": _revenue,
    "gold_anomaly_detection": _anomalies,
    # quality checks
    "dq_all_checks": _checks(quality.all_checks),
    "dq_schema_checks": _checks(quality.schema_checks),
    "dq_freshness_checks": _checks(quality.freshness_checks),
    "dq_summary": lambda spark, sf_dir: quality.summary(_checks(quality.all_checks)(spark, sf_dir)),
    "dq_checks_on_dirty": _checks_on_dirty,
    # query library
    "q_latest_active_users": _on(_daily, kpis.latest_active_users),
    "q_dau_trend_30": _on(_daily, kpis.dau_trend),
    "q_stickiness_trend": _on(_daily, kpis.stickiness_trend),
    "q_new_vs_returning_14": _on(_daily, kpis.new_vs_returning),
    "q_latest_product_kpis": _on(_full_daily, kpis.latest_product_kpis),
    "q_events_per_day": _on(_daily, kpis.events_per_day),
    "q_wow_growth": _on(_daily, kpis.week_over_week_growth),
    "q_active_users_long": _on(_daily, kpis.active_users_long),
    "q_user_status_long": _on(_daily, kpis.user_status_long),
    "q_avg_retention": _on(_retention, kpis.average_retention),
    "q_avg_retention_orders": _on(_order_retention, kpis.average_retention),
    "q_overall_retention": _on(_retention, kpis.overall_retention),
    "q_day7_retention": _on(_retention, kpis.retention_on_day),
    "q_worst_day1_cohorts": _on(_retention, kpis.worst_cohorts),
    "q_retention_trend": _on(_order_retention, kpis.retention_trend),
    "q_retention_pivot": _on(_retention, kpis.retention_pivot),
    "q_retention_heatmap": _on(_order_retention, kpis.retention_heatmap),
    "q_latest_funnel": _on(_funnel, kpis.latest_funnel),
    "q_funnel_for_cohort": _on(_funnel, kpis.funnel_for_cohort, COHORT),
    "q_cohort_dates": _on(_funnel, kpis.cohort_dates),
    "q_conversion_by_step": _on(_funnel, kpis.conversion_by_step),
    "q_avg_conversion": _on(_funnel, kpis.average_conversion),
    "q_worst_dropoff": _on(_funnel, kpis.worst_drop_off),
    "q_dropoff_by_step": _on(_funnel, kpis.drop_off_by_step),
    "q_subscription_conversion_trend": _on(_funnel, kpis.conversion_trend),
    "q_top_features": _on(_features, kpis.top_features),
    "q_feature_trend": _on(_features, kpis.feature_trend, FEATURE),
    "q_feature_adoption": lambda spark, sf_dir: kpis.adoption_rates(feature_adoption_days(_silver(spark, sf_dir))),
    "q_business_summary": _on(_daily_and_revenue, kpis.business_days),
    "q_arpu_arppu": _on(_revenue, kpis.arpu_and_arppu),
    "q_latest_revenue": _on(_revenue, kpis.latest_revenue),
    "q_revenue_trend": _on(_revenue, kpis.revenue_trend),
    "q_net_subscriptions": _on(_revenue, kpis.net_subscriptions),
    "q_subscriptions_long": _on(_revenue, kpis.subscriptions_long),
    "q_kpi_snapshot": _on(_daily_and_revenue, kpis.latest_business_day),
    "q_flagged_anomalies": _on(_anomalies, kpis.flagged_anomalies),
    "q_metric_names": _on(_anomalies, kpis.metric_names),
    "q_anomaly_series": _on(_anomalies, kpis.anomaly_series, METRIC),
    "q_anomaly_counts": _on(_anomalies, kpis.anomaly_counts),
    "q_churn_proxy": _on(_silver, lapsed_users, *CHURN_RANGES),
    "q_churn_proxy_orders": _on(testtables.order_activity, lapsed_users, *ORDER_CHURN_RANGES),
}
