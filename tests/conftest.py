import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from meterflow.session import build_session

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    scratch = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tests",
        master="local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.sql.warehouse.dir": str(scratch / "warehouse"),
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF


@pytest.fixture
def interpreted(spark):
    """Many tiny jobs: compiling code for each takes longer than running them."""
    spark.conf.set("spark.sql.codegen.wholeStage", "false")
    spark.conf.set("spark.sql.codegen.factoryMode", "NO_CODEGEN")
    yield
    spark.conf.unset("spark.sql.codegen.wholeStage")
    spark.conf.unset("spark.sql.codegen.factoryMode")
