import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_session("tidemark-tests", cores=4, shuffle_partitions=8)
    if not s.conf.get("spark.checkpoint.dir", None):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-tests-"))
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    from tidemark.session import scratch_path

    return scratch_path(spark, "test")


@pytest.fixture()
def layout(scratch):
    from tidemark.streaming.bronze import Layout

    return Layout(landing=f"{scratch}/landing", tables=f"{scratch}/tables", checkpoints=f"{scratch}/_ck", source="bls_pr")
