"""The driver's test tables seen as the event model (rules in FIXTURES.md).

Everything is a projection of ``events`` read once, plus a lookup of the user's nation where
the country is wanted, so work grows with the tables.
"""

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from tidemark.schema import EVENT_COLUMNS, SILVER
from tidemark.session import pin_utc

AS_OF = "2024-02-01T00:00:00Z"
BAD_TIMESTAMP = "not-a-timestamp"
FUTURE_TIMESTAMP = "2024-02-02T00:00:00.000000Z"
UNKNOWN_TYPE = "unknown_event_xyz"
TEXT_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def _parquet(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return pin_utc(spark).read.parquet(f"{sf_dir}/{table}.parquet")


# Each event-model column as an expression over (raw_id, raw_user, time, kind, value, k, nation).
_MODEL = {
    "event_id": "concat('evt_', raw_id)",
    "user_id": "concat('user_', raw_user)",
    "session_id": "concat_ws('_', 'sess', raw_user, date_format(time, 'yyyyMMdd'), hour(time) div 6)",
    "event_type": """CASE kind
        WHEN 'signup' THEN 'user_signup'
        WHEN 'view' THEN 'profile_view'
        WHEN 'click' THEN if(k % 2 = 0, 'post_created', 'post_liked')
        WHEN 'purchase' THEN
            CASE k % 3 WHEN 0 THEN 'subscription_started' WHEN 1 THEN 'purchase_completed' ELSE 'subscription_cancelled' END
        WHEN 'error' THEN 'app_error' END""",
    "event_timestamp": "time",
    "platform": "CASE raw_user % 3 WHEN 0 THEN 'iOS' WHEN 1 THEN 'Android' ELSE 'Web' END",
    "device_type": "if(raw_user % 3 = 2, 'Desktop', 'Mobile')",
    "country": "nation",
    "city": "'Springfield'",
    "app_version": "'2.4.1'",
    "page": "concat('page_', k % 7)",
    "feature": "if(k % 10 <> 0, concat('feature_', k % 10), NULL)",
    "post_id": "CAST(NULL AS STRING)",
    "creator_id": "CAST(NULL AS STRING)",
    "duration_seconds": "if(kind <> 'purchase', CAST(floor(value) AS INT), NULL)",
    "revenue": "if(kind = 'purchase' AND k % 3 <> 2, value, 0.0D)",
    "metadata": """named_struct(
        'experiment_group', CASE raw_user % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'B' ELSE 'C' END,
        'referrer', 'organic')""",
}

# What a clean table changes, and what the documented kinds of dirt change.
_CLEAN = {
    "platform": f"lower({_MODEL['platform']})",
    "device_type": f"lower({_MODEL['device_type']})",
    "country": "upper(nation)",
    "event_date": "to_date(time)",
}
_DIRTY = {
    "user_id": f"if(raw_id % 50 = 7, NULL, {_MODEL['user_id']})",
    "event_type": f"""CASE WHEN raw_id % 50 = 17 THEN '{UNKNOWN_TYPE}' WHEN raw_id % 997 = 5 THEN NULL
        ELSE {_MODEL['event_type']} END""",
    "event_timestamp": f"""CASE raw_id % 50 WHEN 11 THEN '{BAD_TIMESTAMP}' WHEN 23 THEN '{FUTURE_TIMESTAMP}'
        ELSE date_format(time + make_dt_interval(0, 0, 0, delay), "{TEXT_FORMAT}") END""",
    "revenue": f"if(raw_id % 50 = 13, -5.0D, {_MODEL['revenue']})",
}


def _columns(names: Iterable[str], *layers: dict[str, str]) -> list[str]:
    expressions = {name: text for layer in layers for name, text in layer.items()}
    return [f"{expressions[name]} AS {name}" for name in names]


def _raw_events(spark: SparkSession, sf_dir: str, with_country: bool) -> DataFrame:
    events = _parquet(spark, sf_dir, "events").selectExpr(
        "event_id AS raw_id",
        "user_id AS raw_user",
        "CAST(ts AS TIMESTAMP) AS time",
        "event_type AS kind",
        "value",
        "CAST(get_json_object(props, '$.k') AS INT) AS k",
    )
    if not with_country:
        return events.selectExpr("*", "CAST(NULL AS STRING) AS nation")
    nations = _parquet(spark, sf_dir, "nation").selectExpr("n_nationkey AS c_nationkey", "n_name AS nation")
    homes = (
        _parquet(spark, sf_dir, "customer").join(nations, "c_nationkey", "left").selectExpr("c_custkey AS raw_user", "nation")
    )
    return events.join(homes, "raw_user", "left")


def silver_events(spark: SparkSession, sf_dir: str, with_country: bool = False) -> DataFrame:
    """The events as a silver table: platform and country standardised, dates derived."""
    columns = _columns(SILVER.fieldNames(), _MODEL, _CLEAN)
    return _raw_events(spark, sf_dir, with_country).selectExpr(*columns)


def bronze_events(spark: SparkSession, sf_dir: str, with_country: bool = True) -> DataFrame:
    """The events as raw bronze rows, with the documented kinds of dirt worked in.

    Delayed copies come from the same scan: a duplicated event explodes into delays 0 and 5.
    """
    delays = "explode(if(raw_id % 50 = 19, array(0, 5), array(0))) AS delay"
    columns = _columns(EVENT_COLUMNS, _MODEL, _DIRTY)
    return _raw_events(spark, sf_dir, with_country).selectExpr("*", delays).selectExpr(*columns)


def order_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order dates as user activity: a second spine that spans years."""
    orders = _parquet(spark, sf_dir, "orders")
    return orders.selectExpr("concat('user_', o_custkey) AS user_id", "to_date(o_orderdate) AS event_date")
