import os
import sys
import tempfile

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(HERE), HERE]

from rowloom import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    root = tempfile.mkdtemp(prefix="run-")
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": 4,
            "spark.driver.memory": "4g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.warehouse.dir": f"{root}/warehouse",
            "spark.checkpoint.dir": f"{root}/scratch",
            "spark.sql.maxMetadataStringLength": 10000,
        },
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def table_name(spark):
    from catalog.writes import new_table

    return new_table(spark, "test")


SF = "/root/testdata/sf0.001"
