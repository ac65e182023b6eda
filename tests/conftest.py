import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (SparkSession.builder.master("local[4]")
         .config("spark.sql.shuffle.partitions", "4")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    if not s.conf.get("spark.checkpoint.dir", None):
        s.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="cinerank-test-"))
    yield s


RATINGS_DDL = "userId long, movieId long, rating double, ts long"
CATALOG_DDL = "movieId long, title string, genres string"


@pytest.fixture
def frames(spark):
    def make(ratings, catalog=None):
        r = spark.createDataFrame(ratings, RATINGS_DDL)
        c = spark.createDataFrame(catalog, CATALOG_DDL) if catalog is not None else None
        return r, c
    return make
