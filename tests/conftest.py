from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

TESTDATA = "/root/testdata"
SF0001 = f"{TESTDATA}/sf0.001"
SF001 = f"{TESTDATA}/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from spanpack.session import local_session

    s = local_session(
        cores="*", shuffle_partitions=8, driver_memory="4g",
        extra={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="spanpack-test-wh-")},
    )
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spanpack-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def tmp_out():
    return tempfile.mkdtemp(prefix="spanpack-test-out-")
