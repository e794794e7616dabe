import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ludomart.session import get_spark  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_spark(
        "tests",
        master="local[8]",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__shuffle__partitions="8",
        spark__driver__memory="6g",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def settings(spark):
    """Set SQL settings for one test."""
    before = {}

    def change(**conf):
        for key, value in conf.items():
            name = key.replace("__", ".")
            before.setdefault(name, spark.conf.get(name, None))
            spark.conf.set(name, value)

    yield change
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)
