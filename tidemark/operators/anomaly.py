"""Trailing z-score anomalies of daily metrics.

Input here is one row per date and metric, so a window per metric stays calendar-sized.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.schema import ANOMALY_THRESHOLD, ANOMALY_WINDOW, GOLD

DAILY_METRICS = ("daily_active_users", "total_events")
REVENUE_METRICS = ("total_revenue",)


def metric_series(table: DataFrame, metrics: tuple[str, ...]) -> DataFrame:
    """Metric columns of a daily table in long form, as doubles."""
    as_doubles = table.select("event_date", *[F.col(m).cast("double").alias(m) for m in metrics])
    return as_doubles.unpivot("event_date", list(metrics), "metric_name", "actual_value")


def score_series(
    series: DataFrame, window_size: int = ANOMALY_WINDOW, threshold: float = ANOMALY_THRESHOLD
) -> DataFrame:
    """Score each value against the mean and sample deviation of the rows before it.

    The window counts rows, not calendar days. Fewer than two earlier rows, or no spread,
    give score 0.0.
    """
    earlier = Window.partitionBy("metric_name").orderBy("event_date").rowsBetween(-window_size, -1)
    spread = F.stddev_samp("actual_value").over(earlier)
    score = F.when(spread > 0, (F.col("actual_value") - F.col("expected_value")) / spread)
    return (
        series.withColumn("expected_value", F.avg("actual_value").over(earlier))
        .withColumn("anomaly_score", F.coalesce(score, F.lit(0.0)))
        .withColumn("is_anomaly", F.abs("anomaly_score") > threshold)
        .select(*GOLD["anomaly_detection"].fieldNames())
    )


def score_metric(
    table: DataFrame,
    column: str,
    metric_name: str,
    window_size: int = ANOMALY_WINDOW,
    threshold: float = ANOMALY_THRESHOLD,
) -> DataFrame:
    """Anomalies of one column of a daily table, under the given metric name."""
    renamed = table.select("event_date", F.col(column).alias(metric_name))
    return score_series(metric_series(renamed, (metric_name,)), window_size, threshold)


def anomaly_report(
    daily: DataFrame,
    revenue: DataFrame,
    window_size: int = ANOMALY_WINDOW,
    threshold: float = ANOMALY_THRESHOLD,
) -> DataFrame:
    """The gold ``anomaly_detection`` table from the daily and revenue tables."""
    series = metric_series(daily, DAILY_METRICS).unionByName(metric_series(revenue, REVENUE_METRICS))
    return score_series(series, window_size, threshold)


def daily_totals(days: DataFrame) -> DataFrame:
    """The three watched metrics straight from user-days, in one aggregation."""
    return days.groupBy("event_date").agg(
        F.count("user_id").alias("daily_active_users"),
        F.sum("events").alias("total_events"),
        F.coalesce(F.sum("revenue"), F.lit(0.0)).alias("total_revenue"),
    )


def anomaly_report_from_user_days(
    days: DataFrame, window_size: int = ANOMALY_WINDOW, threshold: float = ANOMALY_THRESHOLD
) -> DataFrame:
    """The same report without building the daily and revenue tables first."""
    return score_series(metric_series(daily_totals(days), DAILY_METRICS + REVENUE_METRICS), window_size, threshold)
