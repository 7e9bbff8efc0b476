from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))


@pytest.fixture(scope="session")
def spark():
    from wearline.session import build_session
    s = build_session("wearline-tests", "local[8]", 4, "8g")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
