import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from stampbook import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "unit_tests",
        master="local[8]",
        shuffle_partitions=8,
        extra={"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8", "spark.checkpoint.dir": tempfile.mkdtemp(prefix="checkpoint-")},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
