import os
import sys
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from loantide.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    os.environ.setdefault("SPARK_LOCAL_IP", "127.0.0.1")
    SparkSession.builder.config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="loantide-warehouse-"))
    session = build_session("tests", "4", 4)
    yield session
    session.stop()


@pytest.fixture
def folder():
    """A new scratch folder for each test that writes."""
    return tempfile.mkdtemp(prefix="loantide-")


def rows(df):
    """Rows as sorted tuples."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
