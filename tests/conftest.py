from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
for folder in (ROOT, ROOT / "tests"):
    if str(folder) not in sys.path:
        sys.path.insert(0, str(folder))

from helpers import SMALL  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tidemill.session import build_session

    session = build_session(
        "tests", "local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="6g",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
        spark__eventLog__enabled="true", spark__eventLog__dir=f"file:{tmp_path_factory.mktemp('events')}", spark__eventLog__compress="false",
        spark__eventLog__rolling__enabled="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def small() -> str:
    return SMALL
