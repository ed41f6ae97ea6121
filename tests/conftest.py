import os
import sys
import tempfile
import uuid

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from trawl.session import build_session

    folder = tempfile.mkdtemp(prefix="trawl-tests-")
    session = build_session(
        "trawl-tests", "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": folder + "/checkpoints",
            "spark.sql.warehouse.dir": folder + "/warehouse",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def name():
    return "c_" + uuid.uuid4().hex[:8]


SF = "/root/testdata/sf0.001"
