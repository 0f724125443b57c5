"""Event model and table schemas shared by every job."""

from pyspark.sql import types as T

# The recognised event types.
EVENT_TYPES = (
    "user_signup",
    "user_login",
    "profile_view",
    "post_created",
    "post_liked",
    "post_shared",
    "comment_created",
    "video_viewed",
    "message_sent",
    "friend_request_sent",
    "ad_impression",
    "ad_click",
    "purchase_completed",
    "subscription_started",
    "subscription_cancelled",
    "app_error",
    "session_started",
    "session_ended",
)

# The product funnel, first step to last.
FUNNEL_STEPS = (
    "user_signup",
    "profile_view",
    "post_created",
    "post_liked",
    "subscription_started",
)

# Days after first activity at which retention is measured.
RETENTION_DAYS = (0, 1, 7, 30)

# Trailing windows (in days) and tolerances.
WEEK_DAYS = 7
MONTH_DAYS = 30
CLOCK_SKEW_SECONDS = 60
ANOMALY_WINDOW = 7
ANOMALY_THRESHOLD = 2.0
VOLUME_DROP_THRESHOLD = 0.5
VOLUME_TRAILING_DAYS = 7

METADATA = T.StructType(
    [
        T.StructField("experiment_group", T.StringType()),
        T.StructField("referrer", T.StringType()),
    ]
)

_PLAIN_EVENT_FIELDS = [
    T.StructField("event_id", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("session_id", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("event_timestamp", T.StringType()),
    T.StructField("platform", T.StringType()),
    T.StructField("device_type", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("app_version", T.StringType()),
    T.StructField("page", T.StringType()),
    T.StructField("feature", T.StringType()),
    T.StructField("post_id", T.StringType()),
    T.StructField("creator_id", T.StringType()),
    T.StructField("duration_seconds", T.IntegerType()),
    T.StructField("revenue", T.DoubleType()),
]

# ``metadata`` is a variant in bronze so that ad-hoc keys survive landing.
CORRUPT = "_corrupt_record"
BRONZE = T.StructType([*_PLAIN_EVENT_FIELDS, T.StructField("metadata", T.VariantType())])
BRONZE_WITH_CORRUPT = T.StructType([*BRONZE.fields, T.StructField(CORRUPT, T.StringType())])

# As read from NDJSON: numbers keep their text, whatever JSON type they came in.
BRONZE_AS_READ = T.StructType(
    [f if isinstance(f.dataType, T.VariantType) else T.StructField(f.name, T.StringType()) for f in BRONZE_WITH_CORRUPT]
)

EVENT_COLUMNS = tuple(BRONZE.fieldNames())

SILVER = T.StructType(
    [
        *[
            T.StructField("event_timestamp", T.TimestampType()) if f.name == "event_timestamp" else f
            for f in _PLAIN_EVENT_FIELDS
        ],
        T.StructField("metadata", METADATA),
        T.StructField("event_date", T.DateType()),
    ]
)


def _table(*columns: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns])


_DATE, _LONG, _INT = T.DateType(), T.LongType(), T.IntegerType()
_DOUBLE, _STRING, _BOOL = T.DoubleType(), T.StringType(), T.BooleanType()

GOLD = {
    "daily_user_metrics": _table(
        ("event_date", _DATE),
        ("daily_active_users", _LONG),
        ("new_users", _LONG),
        ("returning_users", _LONG),
        ("total_sessions", _LONG),
        ("avg_session_duration", _DOUBLE),
        ("total_events", _LONG),
        ("weekly_active_users", _LONG),
        ("monthly_active_users", _LONG),
        ("dau_mau_stickiness", _DOUBLE),
    ),
    "feature_usage": _table(
        ("event_date", _DATE),
        ("feature", _STRING),
        ("event_count", _LONG),
        ("unique_users", _LONG),
        ("avg_events_per_user", _DOUBLE),
    ),
    "retention_cohorts": _table(
        ("signup_date", _DATE),
        ("retention_day", _INT),
        ("cohort_size", _LONG),
        ("retained_users", _LONG),
        ("retention_rate", _DOUBLE),
    ),
    "funnel_metrics": _table(
        ("event_date", _DATE),
        ("funnel_step", _STRING),
        ("step_order", _INT),
        ("users_reached", _LONG),
        ("conversion_rate", _DOUBLE),
        ("drop_off_rate", _DOUBLE),
    ),
    "revenue_metrics": _table(
        ("event_date", _DATE),
        ("total_revenue", _DOUBLE),
        ("paying_users", _LONG),
        ("arpu", _DOUBLE),
        ("subscription_starts", _LONG),
        ("subscription_cancellations", _LONG),
    ),
    "anomaly_detection": _table(
        ("event_date", _DATE),
        ("metric_name", _STRING),
        ("actual_value", _DOUBLE),
        ("expected_value", _DOUBLE),
        ("anomaly_score", _DOUBLE),
        ("is_anomaly", _BOOL),
    ),
}
