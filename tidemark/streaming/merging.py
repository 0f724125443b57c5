"""Bronze to silver by micro-batches that lose nothing: every valid event lands, late ones on a side, and a merge settles ids.

Each batch is written to a folder of its own, ``rows/<query>/batch=N``, split at the query's watermark into
``late=false`` and ``late=true``; then its line goes into the ledger. A retried batch overwrites both, so
the ledger always equals the folders. The watermark of a batch is the newest event time of the batches before it,
taken from the ledger, less the lateness, so a retry splits as the first try did. Readers and the merge
see only batches that the ledger has.

Copies of an id in one batch are settled in the batch; copies in different batches, or in silver already, by the merge
(``merge_stream``), which keeps the earliest as cleaning all of bronze would. ``read_streamed`` shows
what is not merged yet, settled among itself.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.clean import earliest_per_id, passing_events, tag_events, to_silver
from tidemark.plans.jobs import merge_into_silver
from tidemark.schema import SILVER
from tidemark.sources.idindex import delete
from tidemark.streaming.landing import EVERY_FLUSH

LATENESS = timedelta(hours=1)
LEDGER = "query string, batch long, rows long, late long, newest timestamp, merged boolean"


def _rows_path(root: str, query: str, batch: int) -> str:
    return f"{root.rstrip('/')}/rows/{query}/batch={batch}"


def read_ledger(spark: SparkSession, root: str) -> DataFrame:
    """One line for each batch: rows written, late ones among them, newest event time; merged batches are summed up in lines of their own."""
    try:
        return spark.read.schema(LEDGER).json(f"{root.rstrip('/')}/ledger/*")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER)


def _write_line(spark: SparkSession, root: str, name: str, line: tuple) -> None:
    spark.createDataFrame([line], LEDGER).coalesce(1).write.mode("overwrite").json(f"{root.rstrip('/')}/ledger/{name}")


def write_batch(rows: DataFrame, query: str, batch: int, root: str, lateness: timedelta = LATENESS) -> None:
    """Write one batch of events that pass the rules, and its ledger line. Running it again changes nothing."""
    spark = rows.sparkSession
    earlier = read_ledger(spark, root).where((F.col("query") != query) | (F.col("batch") < batch))
    newest = earlier.agg(F.max("newest").cast("string").alias("newest")).first().newest
    watermark = F.lit(newest).cast("timestamp") - F.lit(lateness)
    own = to_silver(earliest_per_id(rows, "event_id", "event_timestamp"))
    late = F.coalesce(F.col("event_timestamp") < watermark, F.lit(False))
    written = Observation()
    split = own.withColumn("late", late).hint("rebalance", "late", "event_date")
    counted = split.observe(written, F.count(F.lit(1)).alias("rows"), F.count_if("late").alias("late"), F.max("event_timestamp").cast("string").alias("newest"))
    counted.write.mode("overwrite").partitionBy("late", "event_date").parquet(_rows_path(root, query, batch))
    seen = written.get
    line = spark.sql("SELECT CAST(:n AS TIMESTAMP) AS newest", {"n": seen["newest"]}).first().newest
    _write_line(spark, root, f"{query}-{batch}", (query, batch, seen["rows"], seen["late"], line, False))


def stream_batches(
    bronze: DataFrame,
    root: str,
    checkpoint: str,
    lateness: timedelta = LATENESS,
    as_of: datetime | str | Column | None = None,
    trigger: dict = EVERY_FLUSH,
) -> StreamingQuery:
    """Valid events of a bronze stream into batches and a ledger under ``root``."""

    def write(rows: DataFrame, batch: int) -> None:
        # the id that the checkpoint holds: the same after a restart, another one with another checkpoint
        query = rows.sparkSession.read.schema("id string").json(f"{checkpoint.rstrip('/')}/metadata").first().id
        write_batch(rows, query, batch, root, lateness)

    passing = passing_events(tag_events(bronze, as_of))
    return passing.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def _unmerged(spark: SparkSession, root: str) -> list:
    """The ledger's lines of batches that wait for a merge."""
    return read_ledger(spark, root).where("NOT merged").orderBy("query", "batch").collect()


def _batches(spark: SparkSession, root: str, lines: list) -> DataFrame:
    schema = T.StructType([*SILVER.fields, T.StructField("late", T.BooleanType())])
    paths = [_rows_path(root, line.query, line.batch) for line in lines if line.rows]
    if not paths:
        return spark.createDataFrame([], schema)
    parts = [spark.read.schema(schema).parquet(path) for path in paths]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def read_streamed(spark: SparkSession, root: str, late: bool | None = None) -> DataFrame:
    """Events of the batches that wait for a merge, the earliest copy of each id; ``late`` chooses one side."""
    rows = _batches(spark, root, _unmerged(spark, root))
    if late is not None:
        rows = rows.where(F.col("late") == late)
    return earliest_per_id(rows.drop("late"), "event_id", "event_timestamp").select(*SILVER.fieldNames())


def merge_stream(spark: SparkSession, root: str, silver_path: str) -> set[date]:
    """Merge all waiting batches, late rows included, into silver; returns the dates that were rewritten.

    Silver then holds what cleaning all events at once would give, up to copies of one time that differ only
    before they are standardised. A merge that fails in between can be run again: rows that
    silver already has meet themselves.
    """
    lines = _unmerged(spark, root)
    touched = merge_into_silver(spark, _batches(spark, root, lines).drop("late"), silver_path) if lines else set()
    if lines:
        totals = [sum(line[c] for line in lines) for c in ("rows", "late")]
        newest = max((line.newest for line in lines if line.newest), default=None)
        first = lines[0]
        _write_line(spark, root, f"merged-{first.query}-{first.batch}", (first.query, first.batch, *totals, newest, True))
        for line in lines:
            delete(spark, f"{root.rstrip('/')}/ledger/{line.query}-{line.batch}")
            delete(spark, _rows_path(root, line.query, line.batch))
    return touched
