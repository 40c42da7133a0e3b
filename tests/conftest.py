import os
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = str(Path(__file__).resolve().parent.parent)
sys.path.insert(0, ROOT)
# Python workers of the test session import the package from here.
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, os.getenv("PYTHONPATH", "")]).rstrip(os.pathsep)

TESTDATA = os.getenv("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("basket_marts.tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return TESTDATA


@pytest.fixture
def conf(spark):
    """Set SQL settings for one test."""
    before = {}

    def change(name, value):
        before.setdefault(name, spark.conf.get(name, None))
        spark.conf.set(name, value)

    yield change
    for name, value in before.items():
        if value is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, value)


def _sort_key(row):
    return tuple((value is not None, str(value)) for value in row)


def as_rows(frame):
    """All rows as tuples, columns by name, in a fixed order."""
    return sorted((tuple(r) for r in frame.select(*sorted(frame.columns)).collect()), key=_sort_key)


def plan_of(frame):
    """The physical plan as it was run."""
    frame.collect()
    text = frame._jdf.queryExecution().executedPlan().toString()
    return text.split("+- == Initial Plan ==")[0]
