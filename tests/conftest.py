from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from stationflow.session import build_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", "local[4]", 4, "4g")
    session.sparkContext.setLogLevel("ERROR")
    if not session.conf.get("spark.checkpoint.dir", None):
        folder = str(tmp_path_factory.mktemp("checkpoints"))
        session.conf.set("spark.checkpoint.dir", folder)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF
