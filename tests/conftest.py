import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from devicelife.session import get_session
    ckpt = tempfile.mkdtemp(prefix="devicelife-ckpt-")
    s = get_session(master="local[8]", shuffle_partitions=8,
                    extra={"spark.checkpoint.dir": ckpt, "spark.driver.memory": "8g"})
    yield s
    s.stop()


@pytest.fixture()
def small_chunks(spark):
    """Cut every series into chunks of a handful of rows for the test."""
    spark.conf.set("spark.devicelife.chunkRows", "5")
    yield
    spark.conf.unset("spark.devicelife.chunkRows")

