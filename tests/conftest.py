import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[*]")
        .appName("tessel-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir() and not s.conf.get("spark.checkpoint.dir", None):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tessel-test-ckpt-"))
    yield s


def points_df(spark, pts, with_id=True):
    if with_id:
        return spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(pts)], "id long, x double, y double")
    return spark.createDataFrame([(float(x), float(y)) for x, y in pts], "x double, y double")


def rects_df(spark, rects, ids=None):
    ids = ids if ids is not None else list(range(len(rects)))
    return spark.createDataFrame(
        [(i, float(a), float(b), float(c), float(d)) for i, (a, b, c, d) in zip(ids, rects)],
        "id long, x1 double, y1 double, x2 double, y2 double",
    )
