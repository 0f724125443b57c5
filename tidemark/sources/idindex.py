"""Which date of the silver table holds an event id: a table bucketed by id, kept beside the silver table.

Runs append what they changed, so a lookup takes the newest entry of an id and date. The files are bucketed
and sorted by ``event_id``: joined with the ids of a run they are read where they lie, and only the
run's own ids are shuffled. A marker says that the index has everything silver has; it is taken away before silver
changes and put back after the index has followed, so an index that a failed run left behind is built anew.
"""

from __future__ import annotations

import hashlib
import math
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import input_bytes

ID_BUCKETS = 64  # at least
BYTES_PER_BUCKET = 256 << 20
ENTRIES = "event_id string, event_date date, run bigint, present boolean"


def delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.delete(target, True) and files.exists(target):
        raise OSError(f"could not delete {path}")


@dataclass(frozen=True)
class IdIndex:
    """The index of one silver table. ``buckets`` is fixed when the index is built."""

    spark: SparkSession
    silver_path: str

    @property
    def root(self) -> str:
        return f"{self.silver_path.rstrip('/')}_ids"

    @property
    def _marker(self) -> str:
        return f"{self.root}/complete"

    def _state(self) -> tuple[int, str] | None:
        """Buckets and folder of a complete index, None if there is none."""
        try:
            row = self.spark.read.schema("buckets int, folder string").json(self._marker).first()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        return (row.buckets, row.folder) if row else None

    def _mark(self, buckets: int, folder: str) -> None:
        self.spark.createDataFrame([(buckets, folder)], "buckets int, folder string").coalesce(1).write.mode("overwrite").json(self._marker)

    @contextmanager
    def _table(self, buckets: int, folder: str) -> Iterator[str]:
        """The files as a bucketed table of the session, under a name of its own."""
        name = f"ids_{hashlib.md5(folder.encode()).hexdigest()[:8]}_{uuid.uuid4().hex[:8]}"
        columns = ENTRIES.replace(" string", " STRING")
        self.spark.sql(f"CREATE TABLE {name} ({columns}) USING PARQUET CLUSTERED BY (event_id) SORTED BY (event_id) INTO {buckets} BUCKETS LOCATION '{folder}'")
        try:
            yield name
        finally:
            self.spark.sql(f"DROP TABLE {name}")

    def _append(self, entries: DataFrame, buckets: int, folder: str) -> None:
        dealt = entries.select("event_id", "event_date", F.lit(time.time_ns()).alias("run"), "present").repartition(buckets, "event_id")
        with self._table(buckets, folder) as name:
            dealt.write.mode("append").format("parquet").bucketBy(buckets, "event_id").sortBy("event_id").saveAsTable(name)

    def build(self, silver: DataFrame, buckets: int | None = None) -> None:
        """Index all of silver; the former index goes. The number of buckets follows the size of the ids."""
        buckets = buckets or max(ID_BUCKETS, math.ceil(input_bytes(silver.select("event_id")) / BYTES_PER_BUCKET))
        delete(self.spark, self.root)
        folder = f"{self.root}/entries"
        self._append(silver.select("event_id", "event_date", F.lit(True).alias("present")), buckets, folder)
        self._mark(buckets, folder)

    def ready(self, silver: DataFrame) -> None:
        """Build the index if it is missing or was left incomplete."""
        if self._state() is None:
            self.build(silver)

    @contextmanager
    def dates_of(self, ids: DataFrame) -> Iterator[DataFrame]:
        """event_id, event_date of those ``ids`` (event_id) that silver holds; to be used up inside the context.

        The history stays in its buckets: only ``ids`` and what they meet are moved.
        """
        buckets, folder = self._state()
        with self._table(buckets, folder) as name:
            # dealt like the buckets, whatever number of shuffle partitions the session has
            dealt = ids.select("event_id").repartition(buckets, "event_id")
            met = self.spark.table(name).join(dealt, "event_id", "left_semi")
            now = met.groupBy("event_id", "event_date").agg(F.max_by("present", "run").alias("present"))
            yield now.where("present").select("event_id", "event_date")

    @contextmanager
    def repeats(self) -> Iterator[DataFrame]:
        """One row: on how many dates beyond the first ids are held. Nothing is moved but one count of each task."""
        buckets, folder = self._state()
        with self._table(buckets, folder) as name:
            now = self.spark.table(name).groupBy("event_id", "event_date").agg(F.max_by("present", "run").alias("present")).where("present")
            dates = now.groupBy("event_id").agg((F.count("*") - 1).alias("more"))
            yield dates.agg(F.coalesce(F.sum("more"), F.lit(0)).alias("repeats"))

    @contextmanager
    def changing(self, before: DataFrame, after: DataFrame) -> Iterator[None]:
        """Around a change of silver: ``before`` and ``after`` are the (event_id, event_date) of all dates it touches.

        Both must stay readable until the end.
        """
        buckets, folder = self._state()
        delete(self.spark, self._marker)
        yield
        sides = before.select("event_id", "event_date", F.lit(-1).alias("side")).unionByName(after.select("event_id", "event_date", F.lit(1).alias("side")))
        changed = sides.groupBy("event_id", "event_date").agg(F.sum("side").alias("side")).where("side <> 0")
        self._append(changed.select("event_id", "event_date", (F.col("side") > 0).alias("present")), buckets, folder)
        self._mark(buckets, folder)
