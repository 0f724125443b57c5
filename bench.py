"""Time every registered query at $BENCH_SF_DIR on local[$BENCH_CPUS]; print one JSON line.

Each query runs to completion into the no-op sink. The last entry, on one core, is the daily
metrics table over one million events of about fifty thousand users, the only workload with
a published figure to compare with: the test events repeated ten times, every user split into
enough users to reach that number. They are read from Parquet, scan included; the middle of three runs counts.
"""

from __future__ import annotations

import json
import math
import os
import sys
import tempfile
import time
from collections.abc import Callable
from pathlib import Path
from statistics import median

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tidemark.operators.daily import daily_user_metrics  # noqa: E402
from tidemark.plans.registry import QUERIES  # noqa: E402
from tidemark.session import get_spark  # noqa: E402
from tidemark.sources.testtables import silver_events  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
MILLION_ROWS, MILLION_USERS = 1_000_000, 50_000
MILLION = "gold_daily_user_metrics_1m_rows_50k_users_local1"


def session(cpus: str) -> SparkSession:
    settings = {
        "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": "8g",
    }
    spark = get_spark("bench", f"local[{cpus}]", settings)
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def seconds(build: Callable[[], DataFrame]) -> float:
    """Wall time from building the plan to the last row."""
    start = time.perf_counter()
    build().write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def million_events(spark: SparkSession) -> DataFrame:
    silver = silver_events(spark, SF_DIR)
    sizes = silver.agg(F.count("*").alias("events"), F.count_distinct("user_id").alias("users")).first()
    repeats = max(1, math.ceil(MILLION_ROWS / sizes.events))
    split = max(1, math.ceil(MILLION_USERS / sizes.users))
    part = F.pmod(F.xxhash64("event_id", "copy"), F.lit(split)).cast("string")
    return (
        silver.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(repeats))))
        .withColumn("user_id", F.concat_ws("_", "user_id", part))
        .withColumn("session_id", F.concat_ws("_", "session_id", part))
        .drop("copy")
    )


def main() -> None:
    timings: dict[str, float] = {}
    spark = session(CPUS)
    seconds(lambda: QUERIES["gold_daily_user_metrics"](spark, SF_DIR))  # start-up and first compilation
    for name, query in QUERIES.items():
        timings[name] = seconds(lambda: query(spark, SF_DIR))
    total = round(sum(timings.values()), 3)
    spark.stop()

    spark = session("1")
    with tempfile.TemporaryDirectory(prefix="bench-") as folder:
        million_events(spark).write.parquet(f"{folder}/events")
        times = [seconds(lambda: daily_user_metrics(spark.read.parquet(f"{folder}/events"))) for _ in range(3)]
        timings[MILLION] = median(times)
    spark.stop()

    print(
        json.dumps(
            {
                "metric": f"{len(timings) - 1} queries, total wall time",
                "value": total,
                "unit": "sec",
                "queries": timings,
                "sf": Path(SF_DIR).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
