import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    s = (SparkSession.builder.master("local[4]").appName("locus-tests")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", "4")
         .config("spark.sql.session.timeZone", "UTC")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    yield s


def points_df(spark, pts, with_id=True):
    """Hand-made points: list of (x, y); ids 1..n in list order."""
    rows = [(i + 1, float(x), float(y)) for i, (x, y) in enumerate(pts)]
    return spark.createDataFrame(rows, "point_id BIGINT, x DOUBLE, y DOUBLE")
