"""Spark session settings the jobs rely on, and shuffle sizing by input."""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Used where the cluster has not set them. Advisory size gives partitioned writes files of a
# useful size.
DEFAULTS = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}

BYTES_PER_SHUFFLE_PARTITION = 128 << 20


def pin_utc(spark: SparkSession) -> SparkSession:
    """Dates are derived from timestamps, so the session must run in UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def get_spark(
    app_name: str = "tidemark", master: str | None = None, settings: dict[str, str] | None = None
) -> SparkSession:
    """Session in UTC with runtime re-planning on; resources stay with spark-submit."""
    builder = SparkSession.builder.appName(app_name).config("spark.sql.adaptive.enabled", "true")
    if master:
        builder = builder.master(master)
    for key, value in (settings or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    given = spark.sparkContext.getConf()
    for key, value in DEFAULTS.items():
        if not given.contains(key):
            spark.conf.set(key, value)
    return pin_utc(spark)


def input_bytes(*inputs: DataFrame) -> int:
    """Bytes behind the frames as the optimiser estimates them from file listings.

    An upper bound: columns count by their width, but partitions are pruned only later. A join counts as
    no more than the files it reads. Frames of unknown size, as those made from local rows or read through Spark
    Connect, count as nothing.
    """
    return sum(map(_plan_bytes, inputs))


def _plan_bytes(df: DataFrame) -> int:
    if not hasattr(df, "_jdf"):
        return 0
    unknown = int(df.sparkSession._jsparkSession.sessionState().conf().defaultSizeInBytes())
    plan = df._jdf.queryExecution().optimizedPlan()
    leaves = plan.collectLeaves()
    sizes = [int(leaves.apply(k).stats().sizeInBytes()) for k in range(leaves.size())]
    known = sum(size for size in sizes if size < unknown)
    return min(known, int(plan.stats().sizeInBytes()))


@contextmanager
def shuffles_sized_for(*inputs: DataFrame) -> Iterator[None]:
    """Raise the shuffle partitions of the enclosed actions to fit their inputs.

    Never below the session's own number; adaptive execution merges partitions that turn out
    small, but cannot split ones that were too few.
    """
    spark, key = inputs[0].sparkSession, "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    wanted = math.ceil(input_bytes(*inputs) / BYTES_PER_SHUFFLE_PARTITION)
    spark.conf.set(key, str(max(int(before), wanted)))
    try:
        yield
    finally:
        spark.conf.set(key, before)
