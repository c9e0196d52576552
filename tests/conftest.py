import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

from tidemill.session import local_session, shared_folder  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(name="tidemill-tests")
    shared_folder(session)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"
