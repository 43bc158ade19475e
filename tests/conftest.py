import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from featloom.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_session("featloom-tests", "local[8]", 8)
    session.sparkContext.setLogLevel("ERROR")
    session.conf.set("spark.sql.maxMetadataStringLength", "2000")
    yield session
    session.stop()
