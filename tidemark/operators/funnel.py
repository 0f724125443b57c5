"""Strict ordered funnel per signup cohort.

A user's depth is the number of leading steps whose first occurrences come in order, ties
included. Users collapse to (cohort, depth) counts before steps are laid out, so nothing
user-sized is ever multiplied by the number of steps.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import safe_ratio
from tidemark.operators.user_days import first_time_column
from tidemark.schema import FUNNEL_STEPS, GOLD


def first_steps(silver: DataFrame, steps: Sequence[str] = FUNNEL_STEPS) -> DataFrame:
    """Per user: the cohort date and the first time of each step, from silver events."""
    is_type = lambda step: F.col("event_type") == step
    return (
        silver.filter(F.col("event_type").isin(*steps))
        .groupBy("user_id")
        .agg(
            F.min(F.when(is_type(steps[0]), F.col("event_date"))).alias("cohort_date"),
            *[F.min(F.when(is_type(s), F.col("event_timestamp"))).alias(first_time_column(s)) for s in steps],
        )
    )


def first_steps_from_user_days(days: DataFrame, steps: Sequence[str] = FUNNEL_STEPS) -> DataFrame:
    """The same from the user-day rollup."""
    signed_up = F.col(first_time_column(steps[0])).isNotNull()
    return days.groupBy("user_id").agg(
        F.min(F.when(signed_up, F.col("event_date"))).alias("cohort_date"),
        *[F.min(first_time_column(s)).alias(first_time_column(s)) for s in steps],
    )


def _depth(steps: Sequence[str]) -> Column:
    times = [F.col(first_time_column(s)) for s in steps]
    reached = times[0].isNotNull()
    depth = reached.cast("int")
    for before, after in zip(times, times[1:]):
        reached = reached & F.coalesce(after >= before, F.lit(False))
        depth = depth + reached.cast("int")
    return depth


def funnel_from_first_steps(firsts: DataFrame, steps: Sequence[str] = FUNNEL_STEPS) -> DataFrame:
    per_depth = (
        firsts.filter("cohort_date IS NOT NULL AND user_id IS NOT NULL")
        .withColumn("depth", _depth(steps))
        .groupBy("cohort_date", "depth")
        .agg(F.count("*").alias("users"))
    )
    names = F.array(*[F.lit(s) for s in steps])
    in_cohort = Window.partitionBy("cohort_date").orderBy("step_order")
    before = F.lag("users_reached").over(in_cohort)
    cohort_size = F.first("users_reached").over(in_cohort)
    return (
        per_depth.filter("depth > 0")
        .withColumn("step_order", F.explode(F.sequence(F.lit(1), "depth")))
        .groupBy("cohort_date", "step_order")
        .agg(F.sum("users").alias("users_reached"))
        .withColumn("conversion_rate", safe_ratio(F.col("users_reached"), cohort_size))
        .withColumn("drop_off_rate", F.when(before > 0, 1 - F.col("users_reached") / before).otherwise(F.lit(0.0)))
        .withColumn("funnel_step", F.element_at(names, F.col("step_order")))
        .withColumnRenamed("cohort_date", "event_date")
        .select(*GOLD["funnel_metrics"].fieldNames())
    )


def funnel_metrics(silver: DataFrame, steps: Sequence[str] = FUNNEL_STEPS) -> DataFrame:
    """The gold ``funnel_metrics`` table from silver events."""
    return funnel_from_first_steps(first_steps(silver, steps), steps)
