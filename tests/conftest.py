import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from clickpulse.session import get_spark
    s = get_spark("local[4]", 8, app="clickpulse-tests",
                  extra={"spark.driver.memory": "6g"})
    # tests own their checkpoint folder; a cluster sets spark.checkpoint.dir
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="cp-tests-"))
    yield s


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="clickpulse-test-")


def rows_of(spark, payloads, partition=0):
    """Raw records DataFrame from a list of payload strings."""
    data = [(i, None if p is None else str(p), f"k{i}", partition, i) for i, p in enumerate(payloads)]
    return spark.createDataFrame(data, "src_id long, raw_value string, msg_key string, partition int, offset long")
