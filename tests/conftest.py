import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from hazardlake.session import build_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        {
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "6g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def one(spark):
    """Evaluate expressions over one row of named values."""

    def run(values: dict, **expressions):
        names = ", ".join(f"{n} {'double' if v is None or isinstance(v, float) else 'bigint'}" for n, v in values.items())
        df = spark.createDataFrame([tuple(values.values())], names)
        return df.select(*[e.alias(n) for n, e in expressions.items()]).first()

    return run
