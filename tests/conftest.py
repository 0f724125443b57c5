import sys
from pathlib import Path

import pytest
from pyspark.sql import Row, SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from samples import SF_DIR, event  # noqa: E402
from tidemark.session import get_spark  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_spark(
        "tests",
        master="local[4]",
        settings={
            "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    if not session.conf.get("spark.checkpoint.dir", ""):
        session.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
    return session


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="session")
def bronze(spark):
    """Rows given as changes to a valid event, as a bronze frame."""
    from tidemark.schema import BRONZE, METADATA
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("metadata", METADATA) if f.name == "metadata" else f for f in BRONZE])

    def build(*rows):
        return spark.createDataFrame([Row(**event(**r)) for r in rows] if rows else [], schema)

    return build


@pytest.fixture(scope="session")
def silver(spark, bronze):
    """Rows given as changes to a valid event, typed like silver but not cleaned."""
    from pyspark.sql import functions as F

    def build(*rows):
        time = F.try_to_timestamp(F.col("event_timestamp"))
        return bronze(*rows).withColumn("event_timestamp", time).withColumn("event_date", F.to_date("event_timestamp"))

    return build
