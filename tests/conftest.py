import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from logweave.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(
        8,
        "logweave-tests",
        **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "8g"},
    )
    yield session
    session.stop()


@pytest.fixture
def one(spark):
    """Value of one expression over one row of values."""

    def evaluate(column, **values):
        row = spark.createDataFrame([tuple(values.values())], list(values)) if values else spark.range(1)
        return row.select(column.alias("x")).first()["x"]

    return evaluate
