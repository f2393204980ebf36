import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TESTDATA = os.environ.get("TESTDATA_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = (SparkSession.builder.master("local[4]").appName("tests")
               .config("spark.sql.shuffle.partitions", "4")
               .config("spark.default.parallelism", "4")
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.driver.memory", "6g").getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return TESTDATA


@pytest.fixture(scope="session")
def squares(spark):
    """Three classes on an 18 x 18 grid of integer points, each point four times."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.sql import functions as F
    rows = spark.range(18 * 18 * 4).select(
        "id", (F.col("id") % 18).cast("double").alias("a"),
        F.floor(F.col("id") / 18 % 18).cast("double").alias("b"))
    rows = rows.withColumn("label", F.when(F.col("a") + F.col("b") < 12, 0.0)
                           .when(F.col("a") * F.col("b") < 120, 1.0).otherwise(2.0))
    out = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(rows.coalesce(1)).cache()
    out.count()
    return out
