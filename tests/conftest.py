from __future__ import annotations

import os

import pytest

from tidemark.session import build_session, clear_scratch, ensure_checkpoint_dir

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tidemark-tests",
        "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__driver__memory="6g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    clear_scratch(session)
    left = os.listdir(ensure_checkpoint_dir(session).removeprefix("file:"))
    session.stop()
    assert left == [], "intermediate data is left in the shared folder"


@pytest.fixture(scope="session")
def data():
    return DATA
