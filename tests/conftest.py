import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from scrubwell.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "scrubwell-tests")
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def texts(spark):
    """A function that makes a table of texts with their position as key."""

    def make(*values):
        return spark.createDataFrame(list(enumerate(values)), "doc_id bigint, text string")

    return make


@pytest.fixture(scope="session")
def change(texts):
    """A function that applies a column function to texts and returns the results."""
    from pyspark.sql import functions as F

    def run(function, *values):
        made = texts(*values).select("doc_id", function(F.col("text")).alias("out"))
        return [row.out for row in made.orderBy("doc_id").collect()]

    return run
