"""Which dates the events of each bronze directory have: a small table beside bronze, so that a date range reads few directories."""

import re
from collections import defaultdict
from datetime import date
from hashlib import sha256
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import event_time
from tidemark.operators.clean import parse_date
from tidemark.schema import BRONZE_AS_READ, CORRUPT
from tidemark.sources.lake import read_bronze

ZONES = "directory string, names string, first_date date, last_date date, events long, without_time long"
_SCHEME = "^[A-Za-z][A-Za-z0-9+.-]*:/+"


class ZoneMap:
    """The first and last event date of every directory under one bronze root, and its lines without a time.

    A row describes a directory by a digest of its files' names, so it holds as long as no file is added or removed:
    files of bronze are never rewritten. A directory without such a row is read, whatever the range. Rows are
    only appended; one that no longer describes its directory is passed over, and a repeated one is harmless,
    so a run that failed can be done again. The table has a row for each directory, the driver reads all of them.
    """

    def __init__(self, spark: SparkSession, bronze_path: str, path: str | None = None) -> None:
        self.spark, self.bronze_path = spark, bronze_path
        self.path = path or bronze_path.rstrip("/") + "_zones"

    def refresh(self) -> int:
        """Read the directories that no row describes and add their rows; returns how many there were."""
        unknown = {d: files for d, (files, zone) in self._directories().items() if zone is None}
        if unknown:
            lines = read_bronze(self.spark, self.bronze_path, files=_flat(unknown))
            place = F.regexp_replace(F.input_file_name(), _SCHEME, "/")
            time = event_time(F.col("event_timestamp"))
            described = lines.select(
                F.regexp_extract(place, "^(.*)/([^/]*)$", 1).alias("directory"),
                F.regexp_extract(place, "^(.*)/([^/]*)$", 2).alias("name"),
                # a line that does not parse has no place in time, even if a part of it looks like one
                F.when(F.col(CORRUPT).isNull(), F.to_date(time)).alias("day"),
            )
            by_file = described.groupBy("directory", "name").agg(
                F.min("day").alias("first_date"), F.max("day").alias("last_date"), F.count("*").alias("events"), F.count_if(F.col("day").isNull()).alias("without_time")
            )
            zones = by_file.groupBy("directory").agg(
                F.sha2(F.array_join(F.array_sort(F.collect_list("name")), "\n").cast("binary"), 256).alias("names"),
                F.min("first_date").alias("first_date"),
                F.max("last_date").alias("last_date"),
                F.sum("events").alias("events"),
                F.sum("without_time").alias("without_time"),
            )
            zones.coalesce(1).write.mode("append").parquet(self.path)
        return len(unknown)

    def files(self, start_date: date | str | None, end_date: date | str | None, without_time: bool = True) -> list[str]:
        """Files of all directories that may hold events of the range.

        Lines without a time belong to no date, but a report over a range counts those it meets; with
        ``without_time=False``, directories that have only such lines to offer are left out.
        """
        low = parse_date(start_date) if start_date is not None else date.min
        high = parse_date(end_date) if end_date is not None else date.max

        def wanted(zone) -> bool:
            if zone is None or (without_time and zone.without_time):
                return True
            return zone.first_date is not None and zone.first_date <= high and zone.last_date >= low

        return _flat({d: files for d, (files, zone) in self._directories().items() if wanted(zone)})

    def read(self, start_date: date | str | None, end_date: date | str | None, without_time: bool = True) -> DataFrame:
        """Raw events of the directories that may hold some of the range; cleaning filters the rows."""
        return read_bronze(self.spark, self.bronze_path, files=self.files(start_date, end_date, without_time))

    def _directories(self) -> dict:
        """Every directory with files: these files, and the row that describes them or None."""
        found = defaultdict(list)
        for file in self.spark.read.schema(BRONZE_AS_READ).json(self.bronze_path).inputFiles():
            directory = re.sub(_SCHEME, "/", file).rpartition("/")[0]
            if "/outcome=rejected" not in directory:
                found[directory].append(file)
        try:
            rows = self.spark.read.schema(ZONES).parquet(self.path).collect()
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            rows = []
        zones = {(r.directory, r.names): r for r in rows}
        return {d: (files, zones.get((d, _digest(files)))) for d, files in found.items()}


def _digest(files: list[str]) -> str:
    return sha256("\n".join(sorted(f.rpartition("/")[2] for f in files)).encode()).hexdigest()


def _flat(directories: dict[str, list[str]]) -> list[str]:
    return [unquote(file) for files in directories.values() for file in files]
