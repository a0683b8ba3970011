import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from filament.session import build_session, checkpoint_base  # noqa: E402

DATA = os.path.join(os.path.dirname(os.path.abspath(__file__)), "data")


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", 4, "filament-tests")
    if not checkpoint_base(s):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="filament-test-ckpt-"))
    yield s


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)
