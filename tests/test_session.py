import pytest

from tidemark import session
from tidemark.sources.lake import read_silver, write_by_date

KEY = "spark.sql.shuffle.partitions"


def test_shuffles_grow_with_the_input_and_are_restored(spark, monkeypatch, tmp_path):
    path = str(tmp_path / "t")
    write_by_date(spark.range(2000).selectExpr("id", "date_add(DATE '2024-01-01', int(id % 10)) AS event_date"), path)
    table = read_silver(spark, path)
    size = session.input_bytes(table)
    assert size > 5000
    before = spark.conf.get(KEY)
    with session.shuffles_sized_for(table):
        assert spark.conf.get(KEY) == before
    monkeypatch.setattr(session, "BYTES_PER_SHUFFLE_PARTITION", size // 50)
    with pytest.raises(RuntimeError), session.shuffles_sized_for(table):
        assert 50 <= int(spark.conf.get(KEY)) <= 52
        raise RuntimeError
    assert spark.conf.get(KEY) == before
    with session.shuffles_sized_for(table, table):
        assert int(spark.conf.get(KEY)) >= 100  # no ceiling
    assert session.input_bytes(table.select("event_date")) < size


def test_session_keeps_given_settings_and_runs_in_utc(spark):
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert "RocksDB" in spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    assert session.pin_utc(spark).conf.get("spark.sql.session.timeZone") == "UTC"
