"""Arriving NDJSON to bronze, and bronze to silver, as streaming queries.

Both use the file sink, whose commit log with the checkpoint makes each event land exactly
once even when a batch is retried. Pass a checkpoint folder on shared storage. The sink keeps
its own list of the files it committed, and readers of the folder follow that list, so give
each streaming query a folder no batch job writes into; ``read_bronze`` takes several roots.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions import typed_numbers
from tidemark.operators.clean import passing_events, tag_events, to_silver
from tidemark.operators.validate import accepted, rejected, validate_events
from tidemark.schema import BRONZE_AS_READ, BRONZE_WITH_CORRUPT, CORRUPT
from tidemark.sources.lake import BRONZE_LEVELS, EVENTS_PER_FILE, hourly_directories

# Fixed value: how often arriving events are flushed.
FLUSH_INTERVAL = "10 seconds"
EVERY_FLUSH = {"processingTime": FLUSH_INTERVAL}
UNTIL_CAUGHT_UP = {"availableNow": True}
HOT_ID_SALTS = 8


def read_event_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Events from NDJSON files as they appear under a folder."""
    reader = spark.readStream.schema(BRONZE_AS_READ).option("columnNameOfCorruptRecord", CORRUPT)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return typed_numbers(reader.json(path).select(*BRONZE_WITH_CORRUPT.fieldNames()))


def _files(df: DataFrame, kind: str, path: str, checkpoint: str, trigger: dict, partitions: tuple[str, ...]) -> StreamingQuery:
    writer = df.writeStream.format(kind).option("path", path).option("checkpointLocation", checkpoint)
    if kind == "json":
        writer = writer.option("maxRecordsPerFile", EVENTS_PER_FILE)
    return writer.outputMode("append").partitionBy(*partitions).trigger(**trigger).start()


def with_ingest_counts(validated: DataFrame) -> DataFrame:
    """Publish per-batch counters as the query's observed metric ``ingest``.

    They feed monitoring: a batch that is retried may report again.
    """
    is_accepted = F.size("reject_reasons") == 0
    return validated.observe(
        "ingest",
        F.count("*").alias("received"),
        F.count_if(is_accepted).alias("accepted"),
        F.count_if(~is_accepted).alias("rejected"),
    )


def land_events(
    arriving: DataFrame,
    bronze_path: str,
    checkpoint: str,
    as_of: datetime | str | Column | None = None,
    trigger: dict = EVERY_FLUSH,
) -> StreamingQuery:
    """Write accepted events to hourly bronze directories."""
    valid = accepted(with_ingest_counts(validate_events(arriving, as_of)))
    return _files(hourly_directories(valid, as_of), "json", bronze_path, checkpoint, trigger, BRONZE_LEVELS)


def quarantine_events(
    arriving: DataFrame,
    quarantine_path: str,
    checkpoint: str,
    as_of: datetime | str | Column | None = None,
    trigger: dict = EVERY_FLUSH,
) -> StreamingQuery:
    """Write rejected events, with all their reasons, to hourly directories."""
    invalid = rejected(validate_events(arriving, as_of))
    return _files(hourly_directories(invalid, as_of), "json", quarantine_path, checkpoint, trigger, BRONZE_LEVELS)


def land_both(
    arriving: DataFrame,
    path: str,
    checkpoint: str,
    as_of: datetime | str | Column | None = None,
    trigger: dict = EVERY_FLUSH,
) -> StreamingQuery:
    """Accepted and rejected events by one query that parses each line once: ``outcome=accepted`` and
    ``outcome=rejected`` under one folder, hourly directories below. ``read_bronze`` of the folder reads the accepted.
    """
    validated = with_ingest_counts(validate_events(arriving, as_of))
    is_accepted = F.size("reject_reasons") == 0
    # a line leaves out columns that are null, so accepted ones have no reasons
    both = validated.withColumns(
        {
            "outcome": F.when(is_accepted, F.lit("accepted")).otherwise(F.lit("rejected")),
            "revenue": F.when(is_accepted, F.coalesce("revenue", F.lit(0.0))).otherwise(F.col("revenue")),
            "reject_reasons": F.when(~is_accepted, F.col("reject_reasons")),
        }
    )
    return _files(hourly_directories(both, as_of), "json", path, checkpoint, trigger, ("outcome", *BRONZE_LEVELS))


def clean_stream(
    bronze: DataFrame,
    watermark: str = "1 hour",
    as_of: datetime | str | Column | None = None,
    hot_id_salts: int = HOT_ID_SALTS,
) -> DataFrame:
    """Silver events from a bronze stream, the first copy seen of each id within the watermark.

    State is bounded by the watermark, so events later than that are left out; ``merging.stream_batches`` keeps
    them. A first deduplication keyed by id and input task
    spreads an id that makes up much of the stream over ``hot_id_salts`` tasks; the second one
    then sees at most one row per salt. It doubles the state, so pass 0 to leave it out where
    no id repeats that much.
    """
    rows = passing_events(tag_events(bronze, as_of)).withWatermark("event_timestamp", watermark)
    if hot_id_salts:
        salted = rows.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(hot_id_salts)))
        rows = salted.dropDuplicatesWithinWatermark(["event_id", "_salt"]).drop("_salt")
    return to_silver(rows.dropDuplicatesWithinWatermark(["event_id"]))


def stream_to_silver(
    bronze: DataFrame,
    silver_path: str,
    checkpoint: str,
    watermark: str = "1 hour",
    as_of: datetime | str | Column | None = None,
    hot_id_salts: int = HOT_ID_SALTS,
    trigger: dict = EVERY_FLUSH,
) -> StreamingQuery:
    """Append clean events to the date-partitioned silver table."""
    clean = clean_stream(bronze, watermark, as_of, hot_id_salts)
    return _files(clean, "parquet", silver_path, checkpoint, trigger, ("event_date",))


def await_all(spark: SparkSession, queries: list[StreamingQuery]) -> None:
    """Wait until every query has ended; if one fails, stop the others and raise its error."""
    try:
        while any(query.isActive for query in queries):
            spark.streams.awaitAnyTermination()
            spark.streams.resetTerminated()
        for query in queries:
            if error := query.exception():
                raise error
    finally:
        for query in queries:
            query.stop()
