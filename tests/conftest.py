import pytest

from amperline.session import local_session


@pytest.fixture(scope="session")
def spark():
    return local_session(4, "tests")


@pytest.fixture()
def folder(tmp_path):
    return str(tmp_path)
