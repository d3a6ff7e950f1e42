import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from scriptorium.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": "4",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def one(spark):
    """Value of a column expression over one row."""

    def value(expression):
        return spark.range(1).select(expression.alias("v")).first()["v"]

    return value


@pytest.fixture
def plan():
    """Physical plan of a DataFrame as text."""

    def text(df):
        return df._jdf.queryExecution().executedPlan().toString()

    return text
