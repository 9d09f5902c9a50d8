from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, *os.environ.get("PYTHONPATH", "").split(os.pathsep)]).rstrip(os.pathsep)


@pytest.fixture(scope="session")
def spark():
    from docloom.session import session

    s = session("tests", "local[4]", **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf() -> str:
    if not os.path.isdir(SF):
        pytest.skip("no test data")
    return SF
