import sys
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import SparkSession, functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

SMALL = "/root/testdata/sf0.001"


def make_session() -> SparkSession:
    folder = tempfile.mkdtemp(prefix="docweave-")
    builder = (SparkSession.builder.master("local[8]").appName("docweave-tests")
               .config("spark.sql.shuffle.partitions", "8")
               .config("spark.ui.enabled", "false")
               .config("spark.driver.memory", "8g")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.warehouse.dir", f"{folder}/warehouse"))
    spark = builder.getOrCreate()
    if spark.conf.get("spark.checkpoint.dir", None) is None:
        spark.conf.set("spark.checkpoint.dir", f"{folder}/checkpoints")
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@pytest.fixture(scope="session")
def spark():
    session = make_session()
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Build a collection from `(id, document, vector, metadata JSON)` tuples."""
    def build(*given):
        frame = spark.createDataFrame(
            [(i, d, v and list(map(float, v)), m) for i, d, v, m in given],
            "_id string, document string, embedding array<float>, metadata string")
        return frame.withColumn("metadata", F.parse_json("metadata"))

    return build


@pytest.fixture
def vectors(spark):
    """Build queries from vectors; their ids count from 0."""
    def build(*given):
        return spark.createDataFrame([(i, list(map(float, v))) for i, v in enumerate(given)],
                                     "query_id int, embedding array<float>")

    return build


def ids(frame) -> list[str]:
    return sorted(r["_id"] for r in frame.select("_id").collect())


def ranked_ids(frame) -> list[str]:
    return [r["_id"] for r in frame.orderBy("query_id", "rank").collect()]
