import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tallycard import session  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    builder = (
        SparkSession.builder.master("local[*]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.checkpoint.dir", f"{scratch}/checkpoint")
        .config("spark.sql.warehouse.dir", f"{scratch}/warehouse")
    )
    spark = session.configure(builder).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    session.ship(spark)
    yield spark
    spark.stop()


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


@pytest.fixture
def rows():
    """Rows of a frame as a set of tuples, or as a dict by first column."""

    def collect(df, *columns):
        return sorted((tuple(row) for row in df.select(*(columns or df.columns)).collect()), key=repr)

    return collect
