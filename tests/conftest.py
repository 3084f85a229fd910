import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from builders import MATCHES  # noqa: E402

from pitchlake import schemas  # noqa: E402
from pitchlake.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    # Tiny data: interpreted plans start faster than compiled ones.
    session = local_session("tests", "2", spark__sql__codegen__wholeStage="false")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def matches(spark):
    return spark.createDataFrame(MATCHES, schemas.MATCHES).cache()
