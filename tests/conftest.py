import os
import sys

import pytest

os.environ.setdefault("PYSPARK_PYTHON", sys.executable)
os.environ.setdefault("PYSPARK_DRIVER_PYTHON", sys.executable)
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from roost.session import build_session

SMALL = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "roost-tests",
        **{
            "spark.master": "local[8]",
            "spark.driver.memory": "8g",
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def setting(spark):
    """Set session options for one test."""
    kept = {}

    def change(**options):
        for name, value in options.items():
            key = name.replace("__", ".")
            kept.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield change
    for key, value in kept.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def plan_of(df):
    """The physical plan; after an action on ``df``, the one that was run."""
    return df._jdf.queryExecution().executedPlan().toString()
