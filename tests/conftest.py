import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from marketgrain.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "tests")
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """Rows with a DDL schema; strings are cast, so dates can be written plainly."""

    def make(rows, schema):
        names = [part.strip().split(" ")[0] for part in schema.split(",")]
        types = [part.strip().split(" ")[1] for part in schema.split(",")]
        if not rows:
            return spark.createDataFrame([], schema)
        text = spark.createDataFrame(
            [tuple(None if v is None else str(v) for v in r) for r in rows],
            ", ".join(f"{n} string" for n in names),
        )
        return text.selectExpr(*[f"cast({n} as {t}) as {n}" for n, t in zip(names, types)])

    return make


def rows(df):
    return [tuple(r) for r in df.collect()]
