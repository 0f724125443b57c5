"""Sample events and small helpers that the tests share."""

SF_DIR = "/root/testdata/sf0.01"
AS_OF = "2024-02-01T00:00:00Z"

EVENT = {
    "event_id": "e1",
    "user_id": "u1",
    "session_id": "s1",
    "event_type": "user_login",
    "event_timestamp": "2024-01-05T10:00:00Z",
    "platform": "iOS",
    "device_type": "Mobile",
    "country": "us",
    "city": "Springfield",
    "app_version": "2.4.1",
    "page": None,
    "feature": None,
    "post_id": None,
    "creator_id": None,
    "duration_seconds": 10,
    "revenue": 0.0,
    "metadata": {"experiment_group": "B", "referrer": "mail"},
}


def event(**changes):
    return {**EVENT, **changes}


def at(day, time="10:00:00"):
    return f"2024-01-{day:02d}T{time}Z"


def rows(df, *columns):
    chosen = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in chosen.collect()), key=lambda r: tuple((v is not None, str(v)) for v in r))
