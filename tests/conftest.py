import os
import sys
import uuid

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from storespark.session import build_session, shared_folder  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "storespark-tests",
        master="local[4]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__driver__memory="6g",
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def folder(spark):
    """A new folder per test."""
    return shared_folder(spark, "test")


@pytest.fixture
def drops(tmp_path):
    """A local drop folder and a function that writes a file into it."""
    target = tmp_path / f"drops-{uuid.uuid4().hex}"
    target.mkdir()

    def write(name, text):
        (target / name).write_text(text, encoding="utf-8")
        return str(target)

    write.folder = str(target)
    return write
