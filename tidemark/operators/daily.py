"""Daily user metrics: active, new and returning users, rolling 7- and 30-day users, sessions.

Rolling distinct counts need neither a range join nor a distinct per window. A user active
on date ``d`` and next on ``n`` belongs to the trailing-k set on the dates ``[d, min(n, d+k))``,
and for one user these stretches never overlap. So each user-day adds one at ``d`` and takes
one away at ``min(n, d+k)``; the running sum over dates is the exact count.

User-days collapse to (date, gap to the next active date) before any of that, a table of at
most dates x 30 rows, and only this calendar-sized table reaches a single task.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import safe_ratio
from tidemark.operators.user_days import user_days
from tidemark.schema import GOLD, MONTH_DAYS, WEEK_DAYS


def activity_gaps(days: DataFrame, longest: int = MONTH_DAYS, more: dict[str, Column] | None = None) -> DataFrame:
    """Users, first-timers and events per date and gap (in days, capped at ``longest``).

    ``days`` is a user-day rollup with an ``events`` measure; ``more`` are further aggregates of its columns.
    """
    more = more or {}
    in_order = Window.partitionBy("user_id").orderBy("event_date")
    known = F.col("user_id").isNotNull()
    to_next = F.datediff(F.lead("event_date").over(in_order), "event_date")
    return (
        days.withColumn("gap", F.least(F.coalesce(to_next, F.lit(longest)), F.lit(longest)))
        .withColumn("is_first", F.lag("event_date").over(in_order).isNull() & known)
        .groupBy("event_date", "gap")
        .agg(
            F.count("user_id").alias("users"),
            F.count_if("is_first").alias("first_timers"),
            F.sum("events").alias("events"),
            *(value.alias(name) for name, value in more.items()),
        )
    )


def active_users(days: DataFrame, more: dict[str, Column] | None = None) -> DataFrame:
    """Everything in the daily table that follows from user-days (all but the sessions).

    ``more`` are further aggregates of user-days that add up over parts of a date; NULL counts as 0.
    """
    zero, users = F.lit(0).cast("bigint"), F.col("users")
    names = list(more or ())

    def change(date, dau=zero, new=zero, events=zero, week=zero, month=zero, own=False):
        return F.struct(
            date.alias("event_date"),
            dau.alias("daily_active_users"),
            new.alias("new_users"),
            events.alias("total_events"),
            week.alias("week_change"),
            month.alias("month_change"),
            *(F.when(F.lit(own), F.col(name)).alias(name) for name in names),
        )

    def leaves_after(k: int):
        return F.date_add("event_date", F.least("gap", F.lit(k)))

    changes = F.array(
        change(F.col("event_date"), users, F.col("first_timers"), F.col("events"), users, users, own=True),
        change(leaves_after(WEEK_DAYS), week=-users),
        change(leaves_after(MONTH_DAYS), month=-users),
    )
    up_to_date = Window.orderBy("event_date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    per_date = (
        activity_gaps(days, more=more)
        .repartition(1)  # calendar-sized: dates x 30 rows at most
        .select(F.inline(changes))
        .groupBy("event_date")
        .agg(
            F.sum("daily_active_users").alias("daily_active_users"),
            F.sum("new_users").alias("new_users"),
            F.sum("total_events").alias("total_events"),
            F.sum("week_change").alias("week_change"),
            F.sum("month_change").alias("month_change"),
            *(F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in names),
        )
    )
    return (
        per_date.withColumn("weekly_active_users", F.sum("week_change").over(up_to_date))
        .withColumn("monthly_active_users", F.sum("month_change").over(up_to_date))
        .filter("total_events > 0")
        .select(
            "event_date",
            "daily_active_users",
            "new_users",
            (F.col("daily_active_users") - F.col("new_users")).alias("returning_users"),
            "total_events",
            "weekly_active_users",
            "monthly_active_users",
            safe_ratio(F.col("daily_active_users"), F.col("monthly_active_users")).alias("dau_mau_stickiness"),
            *names,
        )
    )


def session_days(silver: DataFrame) -> DataFrame:
    """Sessions per date and the mean of their longest event duration.

    A session without an id takes part in the mean but is not counted.
    """
    per_session = silver.groupBy("event_date", "session_id").agg(F.max("duration_seconds").alias("longest"))
    return per_session.groupBy("event_date").agg(
        F.count("session_id").alias("total_sessions"),
        F.avg("longest").alias("avg_session_duration"),
    )


def assemble_daily(active: DataFrame, sessions: DataFrame) -> DataFrame:
    columns = GOLD["daily_user_metrics"].fieldNames()
    return active.join(sessions, "event_date", "left").select(*columns)


def daily_user_metrics(silver: DataFrame) -> DataFrame:
    """The gold ``daily_user_metrics`` table from silver events."""
    return assemble_daily(active_users(user_days(silver)), session_days(silver))
