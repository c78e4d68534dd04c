import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from stillroom.session import get_session

    work = tmp_path_factory.mktemp("spark")
    session = get_session(
        "stillroom-tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(work / "shared"),
            "spark.sql.warehouse.dir": str(work / "warehouse"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def path(tmp_path):
    return lambda name: str(tmp_path / name)
