"""Bronze NDJSON, silver Parquet and gold Parquet: readers, writers and table registration."""

from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import event_time, moment, typed_numbers
from tidemark.operators.clean import parse_date
from tidemark.schema import BRONZE_AS_READ, BRONZE_WITH_CORRUPT, CORRUPT, GOLD

# Bronze directory levels and rows per NDJSON file.
BRONZE_LEVELS = ("year", "month", "day", "hour")
EVENTS_PER_FILE = 50_000

# How silver rows lie within a date. The last columns let even one user's day be split.
SILVER_ORDER = ("user_id", "event_timestamp", "event_id")


def read_bronze(
    spark: SparkSession,
    path: str | list[str],
    start_date: date | str | None = None,
    end_date: date | str | None = None,
    prune_directories: bool = False,
    files: list[str] | None = None,
) -> DataFrame:
    """Raw events from NDJSON files under a root, a glob, or several of these together.

    The schema is given, so nothing is inferred; lines that do not parse keep their text in
    ``_corrupt_record``, and so do numbers that are none. All directories are read whatever the date range, since an event may lie
    under the hour of its landing; the cleaning job filters rows by their parsed timestamps.
    ``prune_directories`` is for lakes known to keep events under their own date: with a date range
    and a ``year=/month=/day=`` layout, only directories from one day before to one day after the
    range are read, and those without a date. ``files`` names the files under the root to read, as a zone map gives them.
    """
    if not isinstance(path, str):
        roots = [read_bronze(spark, root, start_date, end_date, prune_directories) for root in path]
        return reduce(DataFrame.unionByName, roots)
    reader = spark.read.schema(BRONZE_AS_READ).option("columnNameOfCorruptRecord", CORRUPT)
    if files is None:
        raw = reader.json(path)
    elif files:
        raw = reader.option("basePath", path).json(files)
    else:
        raw = spark.createDataFrame([], BRONZE_AS_READ)
    if "outcome" in raw.columns:  # a folder of accepted and rejected events
        raw = raw.filter("outcome = 'accepted'")
    if prune_directories and set(BRONZE_LEVELS[:3]) <= set(raw.columns):
        directory = F.make_date("year", "month", "day")
        if start_date is not None:
            raw = raw.filter(directory.isNull() | (directory >= F.lit(parse_date(start_date) - timedelta(days=1))))
        if end_date is not None:
            raw = raw.filter(directory.isNull() | (directory <= F.lit(parse_date(end_date) + timedelta(days=1))))
    return typed_numbers(raw.select(*BRONZE_WITH_CORRUPT.fieldNames()))


def hourly_directories(events: DataFrame, as_of: datetime | str | Column | None = None) -> DataFrame:
    """Add the bronze directory columns of each event's hour (UTC, zero-padded text).

    An event whose timestamp does not parse goes under the hour of the run.
    """
    landed_at = F.coalesce(event_time(F.col("event_timestamp")), moment(as_of))
    formats = ("yyyy", "MM", "dd", "HH")
    return events.withColumns({c: F.date_format(landed_at, f) for c, f in zip(BRONZE_LEVELS, formats)})


def write_bronze(
    events: DataFrame,
    path: str,
    as_of: datetime | str | Column | None = None,
    events_per_file: int = EVENTS_PER_FILE,
) -> None:
    """Append events as NDJSON in hourly directories.

    The rebalance gives each hour a few well-sized files and splits an hour that is hot.
    """
    (
        hourly_directories(events.drop(CORRUPT), as_of)
        .hint("rebalance", *BRONZE_LEVELS)
        .write.mode("append")
        .option("maxRecordsPerFile", events_per_file)
        .partitionBy(*BRONZE_LEVELS)
        .json(path)
    )


def read_silver(
    spark: SparkSession, path: str, start_date: date | str | None = None, end_date: date | str | None = None
) -> DataFrame:
    """Clean events; a date range prunes partitions."""
    silver = spark.read.parquet(path)
    if start_date is not None:
        silver = silver.filter(F.col("event_date") >= F.lit(parse_date(start_date)))
    if end_date is not None:
        silver = silver.filter(F.col("event_date") <= F.lit(parse_date(end_date)))
    return silver


def write_by_date(
    df: DataFrame, path: str, cluster_by: tuple[str, ...] = (), only_touched_dates: bool = False
) -> None:
    """Overwrite a table partitioned by ``event_date``: all of it, or just the dates in ``df``.

    Rows are range-partitioned by date and ``cluster_by``, so files come out evenly sized: a
    hot date spreads over many tasks, and at most one task holds the border of two dates.
    Within a date, rows of one user lie together, which lets later aggregations by user
    combine nearly everything before their shuffle.
    """
    order = ("event_date", *cluster_by)
    (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic" if only_touched_dates else "static")
        .partitionBy("event_date")
        .parquet(path)
    )


def write_gold(table: DataFrame, path: str) -> None:
    """Overwrite a metric table; the rebalance leaves one file unless it grows large."""
    table.hint("rebalance").write.mode("overwrite").parquet(path)


def gold_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def load_gold(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A metric table by name; an empty frame with its schema if it was never written."""
    schema = GOLD[name]
    try:
        table = spark.read.parquet(gold_path(root, name))
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return spark.createDataFrame([], schema)
    return table.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def register_gold_views(spark: SparkSession, root: str) -> None:
    """Temp views under the metric tables' names, for plain SQL."""
    for name in GOLD:
        load_gold(spark, root, name).createOrReplaceTempView(name)


def create_gold_tables(spark: SparkSession, root: str, database: str | None = None) -> None:
    """External catalog tables over the metric tables' files."""
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{root}'")
    for name, schema in GOLD.items():
        full_name = f"{database}.{name}" if database else name
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {full_name} ({columns}) USING PARQUET LOCATION '{gold_path(root, name)}'"
        )
