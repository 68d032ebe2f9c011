import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.session import configure  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    builder = configure(SparkSession.builder.master("local[*]").appName("tests"))
    session = (
        builder.config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Collected rows as sorted tuples."""

    def collect(df, *columns):
        chosen = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in chosen.collect()), key=repr)

    return collect


@pytest.fixture
def plan():
    """Text of the physical plan, final when the query has run."""

    def text(df, run=False):
        if run:
            df.collect()
        return df._jdf.queryExecution().executedPlan().toString()

    return text
