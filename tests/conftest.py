import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tallystar.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        "tests", cores=8, **{"spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))}
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def tuples(frame, *columns):
    """Rows as a sorted list of tuples, for comparing without order."""
    picked = frame.select(*columns) if columns else frame
    return sorted((tuple(row) for row in picked.collect()), key=repr)
