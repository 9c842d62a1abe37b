import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from plantflow.session import GROUP_ROWS_CONF, build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        spark__ui__enabled="false",
        spark__sql__shuffle__partitions="4",
        spark__driver__memory="8g",
        spark__default__parallelism="4",
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def small_groups(spark):
    """Treat every group of more than 20 rows as too large for one task."""
    spark.conf.set(GROUP_ROWS_CONF, "20")
    yield 20
    spark.conf.unset(GROUP_ROWS_CONF)


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"
