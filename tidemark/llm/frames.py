"""Shared helpers: texts as byte buffers, work in slices of bounded size, results kept in the shared folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

SLICE_BYTES = 2 << 20
BATCH_ROWS = 1000


def shared_folder(spark: SparkSession) -> str:
    """The cluster's spark.checkpoint.dir; where none is set, a folder of our own if driver and tasks are one process."""
    folder = spark.conf.get("spark.checkpoint.dir", "") or spark.sparkContext.getConf().get("spark.checkpoint.dir", "")
    if not folder:
        if not spark.sparkContext.master.startswith(("local[", "local ")) and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def kept(df: DataFrame, name: str) -> DataFrame:
    """The frame written to the shared folder and read again: lineage ends here and survives lost executors."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Hand tasks at most BATCH_ROWS rows at once in the enclosed actions.

    A batch lies in the memory of the executor, outside its heap, and of the Python worker at the same time.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(int(before), BATCH_ROWS) if int(before) > 0 else BATCH_ROWS))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts, one after the other, and the offsets of the texts; null counts as empty."""
    column = column.cast(pa.large_string()).fill_null("")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of at most `most` bytes of text, or one row where a text is longer."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = text_bytes(batch.column(batch.schema.get_field_index(column)))
        first = 0
        while first < batch.num_rows:
            last = int(np.searchsorted(offsets, offsets[first] + most, side="right")) - 1
            last = min(max(last, first + 1), batch.num_rows)
            yield batch.slice(first, last - first)
            first = last


def gather(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of the ranges [start, start + length), one range after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total)
