from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from leaseflow.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    scratch = tmp_path_factory.mktemp("spark")
    session = local_session(8, "leaseflow-tests", **{
        "spark.sql.shuffle.partitions": "4",
        "spark.sql.warehouse.dir": str(scratch / "warehouse"),
        "spark.checkpoint.dir": str(scratch / "checkpoint"),
    })
    yield session
    session.stop()
