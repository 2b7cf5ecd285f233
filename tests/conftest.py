from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from wickwork.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "wickwork-tests", "local[8]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="4g",
        # Many small jobs: quick compilation counts for more than the fastest code.
        spark__driver__extraJavaOptions="-XX:TieredStopAtLevel=1 -XX:ReservedCodeCacheSize=512m -XX:+UseParallelGC",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("tables")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
