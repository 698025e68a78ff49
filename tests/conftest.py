import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from kiln.session import local_session
    s = local_session(4, 4, app="kiln-tests", extra={
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true"})
    # tests set their own checkpoint folder; library code only reads it
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="kiln-test-ckpt-"))
    yield s
    s.stop()
