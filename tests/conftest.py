from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from wreckline.session import build_session, ensure_checkpoint_dir  # noqa: E402

SF_SMOKE = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="wreckline-tests-")
    session = build_session(
        "wreckline-tests",
        master="local[4]",
        shuffle_partitions=8,
        extra={
            "spark.sql.warehouse.dir": os.path.join(scratch, "warehouse"),
            "spark.local.dir": scratch,
        },
    )
    ensure_checkpoint_dir(session, os.path.join(scratch, "checkpoints"))
    yield session
    session.stop()
