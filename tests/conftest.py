import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def scratch():
    return tempfile.mkdtemp(prefix="occurra-test-")


@pytest.fixture(scope="session")
def spark(scratch):
    from occurra.session import build_session, checkpoint_dir

    s = build_session(
        "local[4]",
        app_name="occurra-tests",
        shuffle_partitions=8,
        extra_conf={
            "spark.sql.warehouse.dir": os.path.join(scratch, "warehouse"),
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": os.path.join(scratch, "checkpoints"),
        },
    )
    checkpoint_dir(s)
    yield s
    s.stop()
