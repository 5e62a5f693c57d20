import shutil
import tempfile

import pytest

from tenura.session import local_session


@pytest.fixture(scope="session")
def spark():
    folder = tempfile.mkdtemp(prefix="tenura-tests-")
    session = local_session(4, 4, spark__checkpoint__dir=f"{folder}/checkpoints", spark__sql__warehouse__dir=f"{folder}/warehouse")
    yield session
    session.stop()
    shutil.rmtree(folder, ignore_errors=True)
