import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    conf = {"spark.checkpoint.dir": f"file://{tmp_path_factory.mktemp('shared')}", "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.sql.session.timeZone": "UTC", "spark.driver.memory": "4g", "spark.default.parallelism": "4"}
    session = SparkSession.builder.master("local[4]").config(map=conf).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def rows():
    """The rows of a DataFrame as a set of tuples, and a check that none is repeated."""

    def collect(df, *columns):
        found = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
        assert len(found) == len(set(found)), "repeated rows"
        return set(found)

    return collect
