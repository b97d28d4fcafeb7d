import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pitlane.session import build_session

    spark = build_session("local[4]", shuffle_partitions=8, app="pitlane-tests")
    # tests run on one machine: a checkpoint folder is set only when none is configured
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="pitlane-test-ckpt-"))
    yield spark
    spark.stop()


@pytest.fixture()
def workdir():
    return tempfile.mkdtemp(prefix="pitlane-test-")
