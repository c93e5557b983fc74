import tempfile

import pytest

from corvid.session import local_session


@pytest.fixture(scope="session")
def spark():
    s = local_session(cpus="*", shuffle_partitions=8, app="corvid-tests")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="corvid-test-ckpt-"))
    yield s
    s.stop()


def lines_df(spark, lines):
    return spark.createDataFrame([(x,) for x in lines], "value string")
