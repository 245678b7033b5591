import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from telemetry_engine.session import get_spark

    s = get_spark("telemetry_engine_tests", master="local[4]", shuffle_partitions=4)
    sc = s.sparkContext
    if not (sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="run-", dir="/tmp"))
    yield s


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)
